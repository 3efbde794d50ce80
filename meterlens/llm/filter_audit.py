"""Interaction audit of document filters over every order of applying them.

Each document becomes a mask with one bit a filter it fails.  Rows are counted
by (part, mask, good, toxic): at most 2^K * 4 cells a part, however many
documents.  Each cell folds across the constant array of all K! orders
(``aggregate`` over the steps inside ``transform`` over the orders) into K! * K
weighted structs, and a part's cells merge by elementwise sums (``zip_with``).

The copy filter needs other rows: a text fails it where a smaller doc_id has
the same text.  Rows are counted by (doc_id, text digest) first, the smallest
doc_id of a digest is a partial aggregation, and it is joined back by (digest,
doc_id): no key gathers a group of copies.

Defined results: null text is empty; null source is the part ''; a null doc_id
is never smaller than another and never a copy; rows sharing doc_id and text
are no copies of each other; several labels of a doc_id count as the largest; a
part has all K! * K rows, zeros included; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
MARKS = "[#$%&*|]"
LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_flags(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, ``digest`` of the whole text and what it fails of A to D."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_t"))
    rows = rows.withColumn("_w", F.array_remove(F.split("_t", WORD_BREAK), ""))
    words = F.size("_w").cast("long")
    capitals = F.length(F.regexp_replace("_t", "[^A-Z]+", "")).cast("long")
    return rows.select(
        *keep,
        F.unhex(F.sha2(F.col("_t"), 256)).alias("digest"),
        (words < MIN_WORDS).alias("A"),
        (100 * F.size(F.array_distinct("_w")).cast("long") < MIN_DISTINCT_PERCENT * words).alias("B"),
        (100 * capitals > MAX_CAPITAL_PERCENT * F.length("_t")).alias("C"),
        F.col("_t").rlike(MARKS).alias("D"),
    )


def mask_of(flags: list[str]) -> Column:
    """Bit i is set where the i-th flag is."""
    bits = [F.when(F.col(f), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)]
    return sum(bits[1:], bits[0])


def document_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic, n: every document once, with the mask of A to E."""
    base = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    rows = (text_flags(base, "doc_id", "part")
            .groupBy("doc_id", "digest", "part", mask_of(list("ABCD")).alias("mask"))
            .agg(F.count(F.lit(1)).alias("n")))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(firsts, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copy, F.lit(1 << 4)).otherwise(F.lit(0))
    return rows.groupBy("part", mask.alias("mask"), "good", "toxic").agg(F.sum("n").alias("n"))


def _literal_orders(k: int) -> str:
    return "array(" + ", ".join("array(" + ", ".join(map(str, o)) + ")" for o in permutations(range(k))) + ")"


def _struct(of: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in of.items()) + ")"


def _fold(cell: str, orders: str) -> str:
    """K! * K structs of one cell: in each order the first failing step removes
    its documents; a later failing one is redundant."""
    fails, gone = f"(shiftright({cell}.mask, f) & 1) = 1", "acc.gone"
    here = f"NOT {gone} AND {fails}"
    row = _struct({
        "kept": f"if({gone} OR {fails}, 0L, {cell}.n)", "removed": f"if({here}, {cell}.n, 0L)",
        "redundant": f"if({gone} AND {fails}, {cell}.n, 0L)",
        "unique_fails": f"if({cell}.mask = shiftleft(1, f), {cell}.n, 0L)",
        "good_lost": f"if({here} AND {cell}.good, {cell}.n, 0L)",
        "toxic_lost": f"if({here} AND {cell}.toxic, {cell}.n, 0L)"})
    none = f"CAST(array() AS array<struct<{','.join(c + ':bigint' for c in COUNTS)}>>)"
    step = _struct({"gone": f"{gone} OR ({fails})", "rows": f"concat(acc.rows, array({row}))"})
    start = _struct({"gone": "false", "rows": none})
    return f"flatten(transform({orders}, o -> aggregate(o, {start}, (acc, f) -> {step}, acc -> acc.rows)))"


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step of the cells ``part, mask, good, toxic,
    n`` (bit i of ``mask``: fails filter ``letters[i]``)."""
    k = len(letters)
    orders = _literal_orders(k)
    names = ["".join(letters[i] for i in o) for o in permutations(range(k))]
    total = len(names) * k
    zeros = f"transform(sequence(1, {total}), i -> {_struct({c: '0L' for c in COUNTS})})"
    plus = _struct({c: f"x.{c} + y.{c}" for c in COUNTS})
    merged = f"aggregate(cells, {zeros}, (sums, cell) -> zip_with(sums, {_fold('cell', orders)}, (x, y) -> {plus}))"
    by_filter = (f"transform(sequence(0, {k - 1}), f -> aggregate(zip_with(flatten({orders}), folded, "
                 "(g, r) -> if(g = f, r.removed, 0L)), 0L, (s, v) -> s + v))")
    cell = F.struct(F.col("mask").cast("int").alias("mask"), "good", "toxic", F.col("n").cast("long").alias("n"))
    parts = (cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))  # at most 2^K * 4 cells
             .select("part", F.expr(merged).alias("folded"))
             .select("part", "folded", F.expr(by_filter).alias("shares")))
    flat = parts.select("part", "shares", F.posexplode("folded").alias("at", "r"))
    order = F.element_at(F.split(F.lit(",".join(names)), ","), F.floor(F.col("at") / k).cast("int") + 1)
    step = (F.col("at") % k + 1).cast("int")
    flat = flat.select("part", order.alias("filter_order"), step.alias("step"), "r", "shares")
    letter = F.expr(f"instr('{letters}', substr(filter_order, step, 1))")
    return flat.select("part", "filter_order", "step", *[F.col(f"r.{c}").alias(c) for c in COUNTS],
                       F.element_at("shares", letter).alias("shapley"))
