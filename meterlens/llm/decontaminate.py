"""Benchmark decontamination with suffix arrays over the training documents.

Words: A-Z lower-cased runs of digits, letters and non-ASCII characters, known
by 64-bit hashes.  Documents are cut into shards of about ``SHARD_BYTES`` (whole
documents, a longer one is a shard by itself).  Each shard's suffix array holds
every word position whose word occurs in the test set (no other position can
begin a match), sorted by the following words; words are numbered within the
test set and several are packed into one 64-bit key, so sorting and searching
compare a few words at a time.  Test suffixes are binary-searched in every
shard:

* ``judge``: the ranges of all windows (``WINDOW`` consecutive item words; an
  item of fewer words is one window) give the hit words and occurring items of
  every document; contaminated if hits reach 1/``SHARE`` of its words.
* ``longest_matches``: for every test suffix, the longest verbatim match over
  all shards (of at least ``WINDOW`` words or the whole rest of a shorter item)
  and where it lies.
* ``decontaminate``: ``docs`` without the contaminated rows.

The test set is broadcast in blocks of ``BLOCK_BYTES`` (items dealt by hash; its
size is measured first); a task takes the blocks one by one and joins their
hits, so a test set of any size works.

Cases: a null or wordless text has no words, is never contaminated and stays;
null or wordless items have no window; items of null item_id still mark hits but
name no item; items repeating an item_id count as one item; repeated documents
are judged alike; extra columns pass through ``decontaminate`` and are ignored
elsewhere; empty tables give empty results, an empty benchmark no hits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import gather, runs, ship, slices, span_hashes, text_rows, utf8

WINDOW, SHARE = 13, 20
SHARD_BYTES, BLOCK_BYTES = 3 << 20, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _WORD[_a:_b] = True


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends) and, per row, where its words begin (n + 1 places)."""
    data, offsets = utf8(column)
    base = int(offsets[0])
    data, offsets = _LOWER[data[base:int(offsets[-1])]], offsets - base
    starts, ends = runs(_WORD[data], offsets)
    return data, starts, ends, np.searchsorted(starts, offsets)


class TestSet:
    """One block of the benchmark: numbered words and packed test suffixes."""

    def __init__(self, item_ids: list, texts: list[str | None], window: int = WINDOW) -> None:
        data, starts, ends, first = split_words(pa.array(texts, pa.string()))
        h = span_hashes(data, starts, ends)
        coded = gather(data, starts, ends).dictionary_encode()
        codes = np.asarray(coded.indices)
        where = np.unique(codes, return_index=True)[1]
        order = np.argsort(h[where], kind="stable")
        self.vocabulary, self.hashes = coded.dictionary.take(pa.array(order)), h[where][order]  # words by hash; equal hashes may differ
        ids = np.argsort(order)[codes]
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per_key = max(1, 63 // self.bits)
        self.window = window
        self.names = item_ids
        sizes = np.diff(first)
        self.longest = int(sizes.max(initial=0))
        self.item = np.repeat(np.arange(len(sizes)), sizes)  # of every test word
        self.offset = np.arange(len(ids)) - np.repeat(first[:-1], sizes)
        self.left = np.repeat(first[1:], sizes) - np.arange(len(ids))  # words from here to the item's end
        self.words = np.zeros(len(ids) + len(sizes), np.int64)  # a zero after each item
        self.at = np.arange(len(ids)) + self.item
        self.words[self.at] = ids + 1
        need = np.where(self.left >= window, window, 0)
        need[(self.offset == 0) & (self.left < window)] = self.left[(self.offset == 0) & (self.left < window)]
        begin = np.flatnonzero(need)
        depth = -(-window // self.per_key)
        keys = np.stack([self._pack(self.words)[np.minimum(self.at[begin] + j * self.per_key, len(self.words))]
                         for j in range(depth)], axis=1) if len(begin) else np.zeros((0, depth), np.int64)
        low, high = self._cut(keys, need[begin], 0), self._cut(keys, need[begin], -1)
        rows = np.concatenate([low, need[begin, None]], axis=1)
        _, where, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        self.low, self.high, self.length = low[where], high[where], need[begin][where]
        pairs = np.unique(np.stack([same.ravel(), self.item[begin]], axis=1), axis=0)  # (window, item)
        self.window_item = pairs[:, 1]
        self.window_first = np.searchsorted(pairs[:, 0], np.arange(len(where) + 1))

    def ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word from 1, 0 for words that the test set lacks: the
        hash finds what may be one of its words, the bytes decide."""
        ids = np.zeros(len(starts), np.int64)
        if len(starts) and len(self.hashes):
            h = span_hashes(data, starts, ends)
            near = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            maybe = np.flatnonzero(self.hashes[near] == h)
            found = pc.index_in(gather(data, starts[maybe], ends[maybe]), value_set=self.vocabulary)
            ids[maybe] = np.asarray(pc.fill_null(found, -1)) + 1
        return ids

    def _pack(self, words: np.ndarray) -> np.ndarray:
        """Key of the ``per_key`` words at every place (zero past the end)."""
        padded = np.r_[words, np.zeros(self.per_key + 1, np.int64)]
        out = np.zeros(len(words) + 1, np.int64)
        for k in range(self.per_key):
            out = (out << self.bits) | padded[k:k + len(words) + 1]
        return out

    def _cut(self, keys: np.ndarray, length: np.ndarray, fill: int) -> np.ndarray:
        """Keys with all words after the first ``length`` set to zeros or ones."""
        out = keys.copy()
        for j in range(keys.shape[1]):
            kept = np.clip(length - j * self.per_key, 0, self.per_key)
            tail = (np.int64(1) << ((self.per_key - kept) * self.bits)) - 1
            out[:, j] = (out[:, j] & ~tail) if fill == 0 else (out[:, j] | tail)
        return out


class SuffixArray:
    """Sorted word positions of a shard, for one test set."""

    def __init__(self, test: TestSet, ids: np.ndarray, first: np.ndarray, depth_words: int) -> None:
        n, rows = len(ids), len(first) - 1
        self.row = np.repeat(np.arange(rows), np.diff(first))
        self.place = np.arange(n) + self.row  # a zero after each document
        self.words = np.zeros(n + rows, np.int64)
        self.words[self.place] = ids
        self.keys = test._pack(self.words)
        self.per_key, self.top = test.per_key, len(self.words)
        self.depth = max(1, -(-depth_words // test.per_key))
        at = np.flatnonzero(self.words)
        order = np.argsort(self.keys[at], kind="stable")
        at = at[order]
        group = np.cumsum(np.r_[False, self.keys[at[1:]] != self.keys[at[:-1]]]) if len(at) else np.zeros(0, np.int64)
        tied = np.arange(len(at))
        for level in range(1, self.depth):  # refine only suffixes that are still equal and not at an end
            size = np.bincount(group[tied])[group[tied]] if len(tied) else np.zeros(0, int)
            tied = tied[size > 1]
            if not len(tied):
                break
            key = self._key(at[tied], level)
            order = np.lexsort((key, group[tied]))
            at[tied], key = at[tied][order], key[order]
            g = group[tied]
            group[tied] = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (g[1:] != g[:-1])]) + (group[-1] + 1) * level
            _, dense = np.unique(group[tied], return_inverse=True)
            group = np.full(len(at), -1, np.int64)
            group[tied] = dense
        self.at = at

    def _key(self, at: np.ndarray, level: int) -> np.ndarray:
        return self.keys[np.minimum(at + level * self.per_key, self.top)]

    def bound(self, wanted: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of packed suffixes (rows of ``wanted``): the number of
        array entries before them (``after``: or equal to them)."""
        lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(self.at), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = self.at[np.minimum(mid, len(self.at) - 1)]
            order = np.zeros(len(wanted), np.int64)
            for level in range(wanted.shape[1]):
                key = self._key(at, level)
                order = np.where(order == 0, np.sign(key - wanted[:, level]), order)
            below = (order < 0) | ((order == 0) & after)
            lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo


def shard_hits(test: TestSet, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A flag for each word of the shard, and (row, item) pairs that occur."""
    array = SuffixArray(test, ids, first, test.window)
    hit = np.zeros(len(array.words) + test.window + 1, np.int64)
    if not len(array.at) or not len(test.low):
        return np.zeros(len(ids), bool), np.zeros((0, 2), np.int64)
    lo, hi = array.bound(test.low, False), array.bound(test.high, True)
    size = hi - lo
    found = np.repeat(np.arange(len(size)), size)
    at = array.at[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + lo[found]]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + test.length[found], -1)
    row = array.row[np.searchsorted(array.place, at)]
    seen = np.unique(np.stack([row, found], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    each = np.diff(test.window_first)[seen[:, 1]]
    k = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(test.window_first[seen[:, 1]], each)
    pairs = np.unique(np.stack([np.repeat(seen[:, 0], each), test.window_item[k]], axis=1), axis=0)
    return (np.cumsum(hit) > 0)[array.place], pairs


def shard_longest(test: TestSet, ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(item, item_start, n_words, row, row_start) of the longest match of each
    test suffix in the shard; ties take the first place in the shard."""
    array = SuffixArray(test, ids, first, max(1, test.longest))
    if not len(array.at) or not len(test.at):
        return []
    keys = np.stack([test._pack(test.words)[np.minimum(test.at + j * test.per_key, len(test.words))] for j in range(array.depth)], axis=1)
    here = array.bound(test._cut(keys, test.left, 0), False)
    best, where = np.zeros(len(test.at), np.int64), np.full(len(test.at), -1, np.int64)
    for side in (here - 1, here):
        ok = (side >= 0) & (side < len(array.at))
        at = array.at[np.clip(side, 0, len(array.at) - 1)]
        length, alive = np.zeros(len(at), np.int64), ok.copy()
        for k in range(test.longest):
            a, b = np.minimum(at + k, array.top - 1), np.minimum(test.at + k, len(test.words) - 1)
            alive = alive & (k < test.left) & (array.words[a] == test.words[b]) & (at + k < array.top)
            if not alive.any():
                break
            length += alive
        better = length > best
        best, where = np.where(better, length, best), np.where(better, at, where)
    need = np.minimum(test.window, test.left + test.offset)  # a window, or the whole item if it is shorter
    out = []
    for t in np.flatnonzero(best >= need):
        row = int(array.row[np.searchsorted(array.place, where[t])])
        out.append((int(test.item[t]), int(test.offset[t]), int(best[t]), row, int(where[t] - array.place[first[row]])))
    return out


def test_blocks(benchmark: DataFrame, window: int = WINDOW) -> list:
    """The benchmark as broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    out = []
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        rows.sort(key=lambda r: (r[0] is None, r[0] or "", r[1] or ""))
        out.append(spark.sparkContext.broadcast(TestSet([r[0] for r in rows], [r[1] for r in rows], window)))
    return out


def _judged(part: pa.RecordBatch, blocks: list) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Words, hit words and occurring item ids of each row."""
    *words, first = split_words(part.column("text"))
    hit = np.zeros(int(first[-1]), bool)
    items: list[set] = [set() for _ in range(part.num_rows)]
    for block in blocks:
        more, pairs = shard_hits(block.value, block.value.ids_of(*words), first)
        hit |= more
        for row, item in pairs.tolist():
            if block.value.names[item] is not None:
                items[row].add(block.value.names[item])
    return np.diff(first), np.diff(np.r_[0, np.cumsum(hit)][first]), [sorted(s) for s in items]


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted item ids as strings), contaminated."""
    ship(docs.sparkSession)
    blocks = test_blocks(benchmark, window)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text", SHARD_BYTES):
            words, hits, items = _judged(part, blocks)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words, pa.int64()), pa.array(hits, pa.int64()),
                 pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "items"])

    out = text_rows(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, items array<string>")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) without the contaminated rows: judged and dropped
    where they are read, without a join."""
    ship(docs.sparkSession)
    blocks = test_blocks(benchmark, window)

    def run(batches):
        for part in slices(batches, "text", SHARD_BYTES):
            words, hits, _ = _judged(part, blocks)
            yield part.filter(pa.array(~((hits > 0) & (SHARE * hits >= words))))

    return docs.mapInArrow(run, docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, item_start, n_words, doc_id, doc_start: the longest verbatim
    match of every test suffix (word positions from 0); ties take the smallest
    (doc_id, doc_start)."""
    ship(docs.sparkSession)
    blocks = test_blocks(benchmark, window)
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("doc_start", T.LongType())])

    def run(batches):
        for part in slices(batches, "text", SHARD_BYTES):
            *words, first = split_words(part.column("text"))
            for block in blocks:
                found = shard_longest(block.value, block.value.ids_of(*words), first)
                rows = pa.array([f[3] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.value.names[f[0]] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.int64()), part.column("doc_id").take(rows),
                     pa.array([f[4] for f in found], pa.int64())], schema.names)

    best = F.min(F.struct((-F.col("n_words")).alias("n"), F.col("doc_id").alias("doc_id"), F.col("doc_start").alias("doc_start")))
    return (text_rows(docs, "doc_id").mapInArrow(run, schema).groupBy("item_id", "item_start").agg(best.alias("b"))
            .select("item_id", "item_start", (-F.col("b.n")).alias("n_words"), "b.doc_id", "b.doc_start"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
