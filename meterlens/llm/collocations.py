"""Phrase collocations counted over a prefix-free parse.

Parsing: a document is a sequence of words and breaks (one break token stands
for any run of piece separators).  A chunk begins wherever the hash of a window
of ``max_words - 1`` tokens is a multiple of ``EVERY``, after ``MAX_TOKENS``
tokens without such a trigger, and at a document's start; it ends with the window
that begins the next one (with breaks at a document's end), so neighbours
overlap by that window and equal passages fall into equal chunks wherever they
stand.  The dictionary holds each distinct chunk of a language once, with its
frequency in the parse.

Counting: an n-gram belongs to the chunk in which it starts before the closing
window, so every occurrence has exactly one owner; n-grams of a distinct chunk
count by the chunk's frequency.  Sizes are counted one after the other: a
phrase with ``min_count`` occurrences has parts with as many, so size k looks
only where both (k-1)-grams may be frequent.  The frequent ones travel as a bit
field of fixed size (``FIELD_BITS``); a false positive costs a count that the
final threshold drops, never a result.  Arithmetic is exact (decimals of 38
digits).  A chunk, a phrase and a language are combined before each shuffle, so
no frequent passage or word meets one task; the ranking keeps the first rows of
``BUCKETS`` buckets of a language before ranking them together.

Defined results: null text is empty, null language ``und``; texts of any length
are cut into chunks of bounded size; repeated documents count as often as they
occur; ties rank by a, then phrase; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import gather, mix, runs, ship, slices, span_hashes, store, utf8

EVERY = 24
MAX_TOKENS = 512
SLICE_BYTES = 4 << 20
FIELD_BITS = 1 << 26
BUCKETS = 64

# What separates pieces, and what separates words besides.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(BREAKS)] = True
_IS_WORD = ~_IS_BREAK
_IS_WORD[list(BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE, _DOT = 32, 46


def _parse(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, chunk starts, chunk ends, row of each chunk): tokens joined by a
    space, a break written as a dot, which no word holds."""
    data, offsets = _LOWER[data[offsets[0]:offsets[-1]]], offsets - offsets[0]
    starts, ends = runs(_IS_WORD[data], offsets)
    if not len(starts):
        return data, starts, ends, starts
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_IS_BREAK[data], out=breaks[1:])
    row = np.searchsorted(offsets, starts, side="right") - 1
    last = np.r_[row[1:] != row[:-1], True]
    broken = np.r_[breaks[starts[1:]] > breaks[ends[:-1]], True]
    after = np.where(last, window, broken.astype(np.int64))  # break tokens after each word
    word_at = np.arange(len(starts)) + np.r_[0, np.cumsum(after)[:-1]]
    n = int(word_at[-1] + 1 + after[-1])
    is_word = np.zeros(n, bool)
    is_word[word_at] = True
    size = np.ones(n, np.int64)
    size[word_at] = ends - starts
    token_end = np.cumsum(size + 1) - 1
    token_at = token_end - size
    out = np.full(int(token_end[-1]) + 1, _SPACE, np.uint8)
    out[token_at[~is_word]] = _DOT
    lengths = ends - starts
    put = np.repeat(token_at[word_at] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum()))
    out[put] = data[_IS_WORD[data]]

    hashes = np.zeros(n + window, np.uint64)
    hashes[:n][word_at] = span_hashes(data, starts, ends)
    seen = np.zeros(n, np.uint64)
    for j in range(window):
        seen = mix(seen + hashes[j:j + n])
    first = np.zeros(n, bool)  # a document's first token
    first[word_at[np.r_[True, last[:-1]]]] = True
    begins = np.flatnonzero(first)
    stops = np.r_[begins[1:], n] - window  # the closing breaks begin here
    token = np.arange(n)
    doc = np.cumsum(first) - 1
    inside = token < stops[doc]
    cut = (first | (seen % np.uint64(EVERY) == 0)) & inside
    before = np.maximum.accumulate(np.where(cut, token, 0))
    cut |= inside & ((token - before) % MAX_TOKENS == 0)
    at = np.flatnonzero(cut)
    nxt = np.minimum(np.r_[at[1:], n], stops[doc[at]])
    return out, token_at[at], token_end[nxt + window - 1], row[np.searchsorted(word_at, begins)][doc[at]]


def _chunk_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        data, offsets = utf8(batch.column("text"))
        out, starts, ends, row = _parse(data, offsets, window)
        if len(starts):
            table = pa.table({"lang": batch.column("lang").take(pa.array(row)), "chunk": gather(out, starts, ends),
                              "n": pa.array(np.ones(len(starts), np.int64))})
            yield from _sums(table, ["lang", "chunk"])


def _sums(table: pa.Table, keys: list[str]) -> list[pa.RecordBatch]:
    got = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    got = got.select([*keys, "n_sum"]).rename_columns([*keys, "n"])
    return got.cast(pa.schema([*[pa.field(k, pa.string()) for k in keys], pa.field("n", pa.int64())])).to_batches(max_chunksize=200_000)


def chunk_dictionary(docs: DataFrame, max_words: int = 3) -> DataFrame:
    """lang, chunk, n: the distinct chunks of each language's documents and how
    often the parse holds them."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    window = max(max_words - 1, 1)
    parse = rows.mapInArrow(lambda b: _chunk_batches(b, window), "lang string, chunk string, n long")
    return parse.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _lang_codes(column: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    d = column.dictionary_encode()
    data, offsets = utf8(d.dictionary)
    return mix(span_hashes(data, offsets[:-1], offsets[1:]))[np.asarray(d.indices)]


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    field = np.uint64(FIELD_BITS - 1)
    return hashes & field, (hashes >> np.uint64(32)) & field


def _held(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _bits(hashes)
    six, low = np.uint64(6), np.uint64(63)
    return ((field[a >> six] >> (a & low)) & (field[b >> six] >> (b & low)) & np.uint64(1)).astype(bool)


def _gram_batches(batches: Iterator[pa.RecordBatch], size: int, window: int, field) -> Iterator[pa.RecordBatch]:
    """lang, phrase, n of the n-grams that the chunks own; for single words also
    each language's sum under the empty phrase."""
    bits = None if field is None else np.frombuffer(field.value, np.uint64)
    for batch in slices(batches, "chunk", SLICE_BYTES):
        data, offsets = utf8(batch.column("chunk"))
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        starts, ends = runs(data != _SPACE, offsets)
        n = len(starts)
        word = (data[starts] != _DOT) | (ends - starts > 1)
        row = np.searchsorted(offsets, starts, side="right") - 1
        behind = np.searchsorted(row, np.arange(batch.num_rows), side="right")  # end of each chunk's tokens
        good = word & (np.arange(n) < behind[row] - window)  # owned by its chunk
        for j in range(1, size):
            good[:n - j] &= word[j:]
            good[max(n - j, 0):] = False
        if bits is not None:
            maybe = np.zeros(n + 1, bool)
            whole = word.copy()
            for j in range(1, size - 1):
                whole[:n - j] &= word[j:]
                whole[max(n - j, 0):] = False
            whole &= np.arange(n) + size - 2 < behind[row]
            at = np.flatnonzero(whole)
            maybe[at] = _held(bits, mix(span_hashes(data, starts[at], ends[at + size - 2]) ^ _lang_codes(batch.column("lang"))[row[at]]))
            good &= maybe[:n] & maybe[1:]
        at = np.flatnonzero(good)
        if not len(at):
            continue
        weight = np.asarray(batch.column("n"))[row[at]]
        table = pa.table({"lang": batch.column("lang").take(pa.array(row[at])),
                          "phrase": gather(data, starts[at], ends[at + size - 1]), "n": pa.array(weight)})
        yield from _sums(table, ["lang", "phrase"])
        if size == 1:
            table = table.set_column(1, "phrase", pa.array([""] * len(at), pa.large_string()))
            yield from _sums(table, ["lang", "phrase"])


def _field_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "phrase", SLICE_BYTES):
        data, offsets = utf8(batch.column("phrase"))
        h = mix(span_hashes(data, offsets[:-1], offsets[1:]) ^ _lang_codes(batch.column("lang")))
        bits = np.unique(np.concatenate(_bits(h)))
        bit = np.left_shift(np.uint64(1), bits & np.uint64(63))
        yield pa.record_batch({"word": pa.array((bits >> np.uint64(6)).astype(np.int64)), "bit": pa.array(bit.view(np.int64))})


def _bit_field(spark: SparkSession, frequent: DataFrame):
    """A broadcast of FIELD_BITS bits with the places of the frequent phrases
    set; what reaches the driver has that size at most."""
    words = frequent.mapInArrow(_field_batches, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    field = np.zeros(FIELD_BITS >> 6, np.uint64)
    field[words.column("word").to_numpy()] = words.column("bit").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(field.tobytes())


def phrase_counts(dictionary: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """lang, phrase, size, f: all phrases of up to ``max_words`` words with at
    least ``min_count`` occurrences, and each language's number of words under
    the empty phrase with size 0."""
    spark, window, field, levels = dictionary.sparkSession, max(max_words - 1, 1), None, []
    for size in range(1, max_words + 1):
        grams = dictionary.mapInArrow(lambda b, size=size, field=field: _gram_batches(b, size, window, field),
                                      "lang string, phrase string, n long")
        counts = grams.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        counts = store(counts.filter((F.col("f") >= min_count) | (F.col("phrase") == "")), f"phrases-{size}")
        levels.append(counts.withColumn("size", F.when(F.col("phrase") == "", 0).otherwise(F.lit(size))))
        if size < max_words:
            field = _bit_field(spark, counts)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def _exact(c: str, digits: int) -> Column:
    return F.col(c).cast(f"decimal({digits},0)")


def score(counts: DataFrame, max_words: int, absorb_percent: int = 50) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one absorbs."""
    cand = counts.filter(F.col("size") >= 2).select("lang", "phrase", "size", F.col("f").alias("a"),
                                                    F.split("phrase", " ").alias("w"))
    joined = "array_join(slice(w, {0}, {1}), ' ')"
    cuts = F.expr(f"transform(sequence(1, size - 1), k -> struct(k AS k, {joined.format('1', 'k')} AS left, "
                  f"{joined.format('k + 1', 'size - k')} AS right))")
    cut = cand.select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    known = counts.filter((F.col("size") >= 1) & (F.col("size") < max_words))
    for side, f in (("left", "l"), ("right", "r")):
        cut = cut.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    value = F.expr("CAST((1000000 * CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0))) "
                   "div (CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0))) AS long)")
    best = (cut.withColumn("score", value).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "b.score", "b.l", "b.r"))
    subs = F.expr(f"flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), p -> {joined.format('p', 's')})))")
    longer = (cand.filter(F.col("size") > 2).select("lang", F.explode(subs).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longest")))
    totals = counts.filter(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longest").isNull() | (100 * _exact("longest", 20) < absorb_percent * _exact("a", 20)))
    return kept.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, absorb_percent: int = 50,
                 top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``max_words`` words."""
    dictionary = store(chunk_dictionary(docs, max_words), "phrase-dictionary")
    found = score(phrase_counts(dictionary, max_words, min_count), max_words, absorb_percent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    found = found.withColumn("_b", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    for keys in (["lang", "_b"], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
