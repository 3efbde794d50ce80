"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a run of text between line ends and sentence ends; a text's set
is the 64-bit digests of its distinct paragraphs.  A sketch has three rows of
``WIDTH`` cells; a digest goes into one cell of each row, and a cell holds how
many it has, their exclusive or, and that of their check values.  The sketch of
a whole text is its fingerprint, the same size for every text.

Two versions are compared by subtracting cells (counts subtract, the others by
exclusive or): what both hold cancels.  Peeling then takes the cells with one
digest left, removes that digest from its other cells, and so on until nothing
is left; the digests taken are the paragraphs in which the versions differ.
Where the fingerprints are too small for that, larger sketches are made: the
digests are split by their top bits into groups of about ``GROUP`` of both
versions, each with a sketch of its own, and a group that still fails doubles
its width up to ``RETRIES`` times.  (Two digests share all cells of the last
width with odds of 2^-30; a group that fails there has its digests compared as they
are.)  Splitting goes in two steps, so that a text of n paragraphs costs about
n * sqrt(n) and no more.

All of it is column functions on one row.  Only one exchange moves texts:
``with_next`` deals rows to blocks of consecutive doc_id, and the first row of
each block goes to the block before it as well, as the successor of its last.

Defined results: null text is empty; equal texts have equal fingerprints; texts
without paragraphs are alike (1); repeated paragraphs count once; rows sharing a
doc_id follow each other in any order (a doc_id of many rows spreads over
blocks); null doc_ids come first; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = 3
WIDTH = 8
GROUP = 20
GROUP_WIDTH = 16
RETRIES = 6
ROUNDS = 12
BLOCK_ROWS = 1024
MAX_BLOCKS = 65536
PARAGRAPH_END = r"[.!?\r\n]+\s*"


def digests(text: Column) -> Column:
    """The digests of a text's distinct paragraphs."""
    pieces = F.array_remove(F.split(text, PARAGRAPH_END), "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(x: str) -> str:
    return f"(xxhash64({x}, 77) & 4294967295L)"


def _place(x: str, row: int, w: int) -> str:
    """Cell of digest ``x`` in a row of ``w`` (a power of two): ten bits of x a row."""
    return f"(shiftrightunsigned({x}, {10 * row}) & {w - 1}L)"


def sketch_sql(keys: str, w: int) -> str:
    """Rows of cells (n, k, c) of an array of digests."""
    rows = []
    for row in range(ROWS):
        cell = (f"aggregate(filter({keys}, x -> {_place('x', row, w)} = i), named_struct('n', 0L, 'k', 0L, 'c', 0L), "
                f"(s, x) -> named_struct('n', s.n + 1L, 'k', s.k ^ x, 'c', s.c ^ {_check('x')}))")
        rows.append(f"transform(sequence(0L, {w - 1}L), i -> {cell})")
    return f"array({', '.join(rows)})"


def subtract_sql(a: str, b: str) -> str:
    less = "(p, q) -> named_struct('n', p.n - q.n, 'k', p.k ^ q.k, 'c', p.c ^ q.c)"
    return f"zip_with({a}, {b}, (g, h) -> zip_with(g, h, {less}))"


def peel_sql(cells: str, w: int) -> str:
    """array of (k, n): the differing digests, n = 1 in the first version only,
    -1 in the second only; null where peeling stops short."""
    # the cells with one digest left hold (n, k, c) of that digest
    pure = f"array_distinct(flatten(transform(s.rows, g -> filter(g, c -> abs(c.n) = 1 AND c.c = {_check('c.k')}))))"
    rows = []
    for row in range(ROWS):
        placed = f"transform(found, f -> named_struct('at', {_place('f.k', row, w)}, 'f', f))"
        less = ("transform(s.rows[{0}], (c, i) -> if(c.n = 0 AND c.k = 0, c, aggregate(filter(placed, p -> p.at = i), c, "
                "(e, p) -> named_struct('n', e.n - p.f.n, 'k', e.k ^ p.f.k, 'c', e.c ^ p.f.c))))").format(row)
        rows.append(f"transform(array({placed}), placed -> {less})[0]")
    step = (f"if(s.stop, s, aggregate(array({pure}), s, (s, found) -> named_struct('rows', if(size(found) = 0, s.rows, array({', '.join(rows)})), "
            "'keys', concat(s.keys, found), 'stop', size(found) = 0)))")
    start = f"named_struct('rows', {cells}, 'keys', CAST(array() AS array<struct<n:bigint,k:bigint,c:bigint>>), 'stop', false)"
    done = ("if(forall(s.rows, g -> forall(g, c -> c.n = 0 AND c.k = 0 AND c.c = 0)), "
            "transform(s.keys, f -> named_struct('k', f.k, 'n', f.n)), NULL)")
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {step}, s -> {done})"


def _plain_sql(a: str, b: str) -> str:
    side = "transform(array_except({0}, {1}), x -> named_struct('k', x, 'n', {2}))"
    return f"concat({side.format(a, b, '1L')}, {side.format(b, a, '-1L')})"


def _grouped_sql(a: str, b: str, groups: str) -> str:
    """The differing digests by sketches of groups; ``groups`` is a power of two, as 2^(g1 + g2)."""
    tries = [peel_sql(subtract_sql(sketch_sql("g.a", w), sketch_sql("g.b", w)), w) for w in (GROUP_WIDTH << r for r in range(RETRIES + 1))]
    peeled = f"coalesce({', '.join(tries)}, {_plain_sql('g.a', 'g.b')})"
    coarse, fine = f"CAST({groups} div 2 AS int)", f"CAST({groups} - {groups} div 2 AS int)"
    top = f"shiftrightunsigned(x, 64 - greatest({coarse}, 1)) * if({coarse} = 0, 0, 1)"
    low = f"shiftrightunsigned(shiftleft(x, {coarse}), 64 - greatest({fine}, 1)) * if({fine} = 0, 0, 1)"

    def part(name: str, bits: str, which: str) -> str:
        return f"filter({name}, x -> {bits} = {which})"
    first = (f"transform(sequence(0L, shiftleft(1L, {coarse}) - 1), t -> named_struct("
             f"'a', {part(a, top, 't')}, 'b', {part(b, top, 't')}))")
    second = (f"flatten(transform({first}, h -> transform(sequence(0L, shiftleft(1L, {fine}) - 1), u -> named_struct("
              f"'a', {part('h.a', low, 'u')}, 'b', {part('h.b', low, 'u')}))))")
    return f"flatten(transform({second}, g -> {peeled}))"


def difference(df: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, out: str) -> DataFrame:
    """``df`` with ``out``: array of (k, n), the digests in which the sets ``a``
    and ``b`` differ, by their fingerprints or, where those fail, larger sketches."""
    first = df.withColumn("_first", F.expr(peel_sql(subtract_sql(sketch_a, sketch_b), WIDTH)))
    groups = F.greatest(F.lit(0), F.ceil(F.log2((F.size(a) + F.size(b)) / GROUP))).cast("int")
    first = first.withColumn("_groups", F.when(F.size(a) + F.size(b) > 0, groups).otherwise(0))
    return first.withColumn(out, F.expr(f"coalesce(_first, {_grouped_sql(a, b, '_groups')})")).drop("_first", "_groups")


def likeness(a: str, b: str, differing: str) -> Column:
    """Twice the common digests over both sizes: 1 for equal sets, 0 for disjoint ones."""
    both = (F.size(a) + F.size(b)).cast("double")
    return F.when(both == 0, F.lit(1.0)).otherwise(1.0 - F.size(differing) / both)


def serialise(cells: str) -> Column:
    """A sketch as text: per cell 8 digits of the count, 16 of the digests, 8 of the checks."""
    digits = "lpad(hex(c.n), 8, '0') || lpad(hex(c.k), 16, '0') || lpad(hex(c.c), 8, '0')"
    return F.lower(F.expr(f"array_join(transform(flatten({cells}), c -> {digits}), '')"))


def _blocks(docs: DataFrame) -> tuple[Column, Column]:
    """(cuts, block): columns with the block of each row.  Blocks follow ``_at``,
    cut at quantiles.  The cuts are an array of arrays of about equal size,
    searched in two steps; a value that spans several blocks is dealt among them."""
    n = max(1, min(MAX_BLOCKS, -(-docs.count() // BLOCK_ROWS)))
    cuts = [int(c) for c in docs.approxQuantile("_at", [i / n for i in range(1, n)], 1 / (4 * n))] if n > 1 else []
    if not cuts:
        return F.lit(None), F.lit(0)
    side = max(1, int(len(cuts) ** 0.5))
    table = F.from_json(F.lit(json.dumps([cuts[i:i + side] for i in range(0, len(cuts), side)])), "array<array<bigint>>")

    def cuts_(test: str) -> str:
        rows = f"size(filter(_cuts, r -> r[0] {test} _at))"
        return f"if({rows} = 0, 0, ({rows} - 1) * {side} + size(filter(_cuts[{rows} - 1], x -> x {test} _at)))"
    low, high = cuts_("<"), cuts_("<=")
    deal = f"({low}) + pmod(xxhash64(_row), greatest(({high}) - ({low}), 0) + 1)"
    return table, F.expr(f"CAST(if(({high}) > ({low}) + 1, {deal}, {high}) AS int)")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, keys, cells of every row, and ``next``: text, keys and cells
    of the row that follows in doc_id order (after the last: the first).  ``docs``
    is read several times and has to come in the same order (stored tables do)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("_at", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("_row", F.monotonically_increasing_id())
    cuts, block = _blocks(base)
    base = base.withColumn("_cuts", cuts).withColumn("block", block).drop("_cuts", "_row").withColumn("_h", F.xxhash64("text"))
    firsts = base.groupBy("block").agg(F.min(F.struct("_at", "_h")).alias("f")).select("block", "f.*").orderBy("block").collect()  # one a block
    guests = [(firsts[i - 1][0], *f) for i, f in enumerate(firsts)]
    guests = docs.sparkSession.createDataFrame(guests, "to int, block int, _at long, _h long")
    guest = base.join(F.broadcast(guests), ["block", "_at", "_h"])
    rows = base.withColumn("_guest", F.lit(0)).unionByName(guest.withColumn("_guest", F.lit(1)).withColumn("block", F.col("to")).drop("to"))
    rows = rows.withColumn("keys", digests(F.col("text"))).withColumn("cells", F.expr(sketch_sql("keys", WIDTH)))
    follow = Window.partitionBy("block").orderBy("_guest", "_at", "_h")
    rows = rows.withColumn("next", F.lead(F.struct("text", "keys", "cells")).over(follow))
    return rows.filter(F.col("_guest") == 0).select("doc_id", "text", "keys", "cells", "next")


def versions(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, both fingerprints, and how the text's differs from its
    edited text's and from the next document's: near_* and the recovered digests."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.expr("left(text, CAST(n_chars - n_chars div 2 AS int)) || left(next.text, CAST(n_chars div 2 AS int))")
    rows = rows.select("doc_id", "n_chars", "keys", "cells", F.col("next.keys").alias("next_keys"),
                       F.col("next.cells").alias("next_cells"), edited.alias("edited"))
    rows = rows.select("*", F.sha2(F.col("edited"), 256).alias("edited_sha256"), digests(F.col("edited")).alias("edited_keys")).drop("edited")
    rows = rows.withColumn("edited_cells", F.expr(sketch_sql("edited_keys", WIDTH)))
    rows = difference(rows, "keys", "edited_keys", "cells", "edited_cells", "edited_diff")
    rows = difference(rows, "keys", "next_keys", "cells", "next_cells", "next_diff")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", serialise("cells").alias("fingerprint"),
        serialise("edited_cells").alias("edited_fingerprint"), likeness("keys", "edited_keys", "edited_diff").alias("near_edited"),
        likeness("keys", "next_keys", "next_diff").alias("near_next"), "edited_diff", "next_diff")
