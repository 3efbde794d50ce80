"""SimHash near-duplicate groups with Golay-code fuzzy hashing.

Fingerprint: words are runs of bytes other than ASCII white space, A-Z
lower-cased; shingles of three words (all words, if fewer) are hashed with
XXH64 (seed 42); a bit is set when more than half of the hashes have it.
A text without words (null, empty, blank) has fingerprint zero.

Linking at ``MAX_BITS`` = 3 differing bits is exact:

* The 64 bits are cut into segments A (23), B (23) and C (18).  A 23-bit word
  gets as keys the indices of all codewords of the perfect [23, 12, 7] Golay
  code within distance 4: one index if it lies within 2 of its codeword, else
  six.  Two words at distance 2 or less always share an index.
* Pigeonhole: with 3 errors in all, either A and B both have at most 2 (the
  pair of indices is shared), or A has all 3 (B and C are equal), or B has all
  3 (A and C are equal).  That is 1 to 36 keys for the pair and two more.
* Distinct fingerprints meet by key; every link is verified by its bit count.
  Inside a key the linked sets are found by breadth-first growth over the rest
  of the key's fingerprints, which emits one edge per fingerprint reached, not
  all pairs: a tight group of copies is consumed in about one sweep.
* A key of more than ``GROUP_ROWS`` fingerprints is cut into blocks by a second
  hash, and each pair of blocks meets by a key of its own, so a task holds and
  compares at most about that many at once however common a key is.

Exact copies collapse before that (one row per fingerprint), so a group of
copies of any size is one node.  Components come from large-star/small-star
rounds on Spark; nothing per document reaches the driver.

Cases: null doc_id rows take part, and a component's id is its smallest
non-null doc_id (null if it has none); repeated rows are linked like any
others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_rows, checkpoint, ship, slices, store, text_rows

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
SLICE_BYTES = 2 << 20
ROW, RANK = "__meterlens_row", "__meterlens_rank"  # hash of doc_id and text, and the order of its rows
PIECE = 1 << 16  # shingles whose hashes are held at once
SMALL_GROUP = 64  # groups up to this size are compared in one vectorised pass
GROUP_ROWS = 1 << 16  # fingerprints of one key that meet in one place; more are dealt over block pairs

# The binary Golay code's generator polynomial and its parameters.
GOLAY_POLY, GOLAY_BITS, GOLAY_PARITY, GOLAY_REACH = 0xAE3, 23, 11, 4


def fingerprint(text: bytes) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(SHINGLE_WORDS, len(words))
    begin, stop = starts[:len(words) - k + 1], ends[k - 1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for at in range(0, len(begin), PIECE):
        b, e = begin[at:at + PIECE].tolist(), stop[at:at + PIECE].tolist()
        h = np.array([digest(joined[i:j], seed) for i, j in zip(b, e)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches):
    for part in slices(batches, "text", SLICE_BYTES):
        f = np.array([fingerprint(t) for t in byte_rows(part.column("text"))], np.uint64)
        rest = [part.column(n) for n in part.schema.names if n != "text"]
        names = [n for n in part.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(f.view(np.int64))], [*names, "fp"])


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, ``keep`` and ``fp``, the fingerprint's 64 bits as a signed long."""
    ship(docs.sparkSession)
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep)]
    return text_rows(docs, "doc_id", *keep).mapInArrow(_fingerprint_batches, ", ".join([*kinds, "fp long"]))


class Golay:
    """Codeword indices within ``GOLAY_REACH`` of each 23-bit word."""

    def __init__(self) -> None:
        low = np.arange(1 << 12, dtype=np.int64)
        self.low, self.high = self._remainder(low), self._remainder(low << 11)
        bits = 1 << np.arange(GOLAY_BITS, dtype=np.int64)
        sums, patterns, level = self.syndrome(bits), [np.zeros(1, np.int64)], np.zeros(1, np.int64)
        for _ in range(GOLAY_REACH):  # patterns of one more bit, above the highest so far
            level = np.concatenate([(level[level < b] | b) for b in bits.tolist()])
            patterns.append(level)
        del sums
        p = np.concatenate(patterns)
        s = self.syndrome(p)
        order = np.lexsort((np.arange(len(p)), s))
        p, s = p[order], s[order]
        first = np.searchsorted(s, np.arange(1 << GOLAY_PARITY))
        self.count = np.diff(np.r_[first, len(s)])
        self.table = p[np.minimum(first[:, None] + np.arange(self.count.max()), len(p) - 1)]

    @staticmethod
    def _remainder(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for bit in range(GOLAY_BITS - 1, GOLAY_PARITY - 1, -1):
            x ^= ((x >> bit) & 1) * (GOLAY_POLY << (bit - GOLAY_PARITY))
        return x

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self.low[x & 0x7FF] ^ self.high[x >> 11]

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, 6) codeword indices and how many of each row count (1 or 6)."""
        s = self.syndrome(x)
        return (x[:, None] ^ self.table[s]) >> GOLAY_PARITY, self.count[s]


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def block_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs for an array of unsigned fingerprints."""
    g = golay()
    x = fp.astype(np.uint64)
    mask = np.uint64((1 << 23) - 1)
    a, b = (x & mask).astype(np.int64), ((x >> np.uint64(23)) & mask).astype(np.int64)
    c = (x >> np.uint64(46)).astype(np.int64)
    ka, na = g.keys(a)
    kb, nb = g.keys(b)
    i, j = np.meshgrid(np.arange(ka.shape[1]), np.arange(kb.shape[1]), indexing="ij")
    both = (ka[:, i.ravel()] << 12) | kb[:, j.ravel()]
    used = (i.ravel() < na[:, None]) & (j.ravel() < nb[:, None])
    row = np.broadcast_to(np.arange(len(x))[:, None], both.shape)[used]
    n = np.arange(len(x))
    tag = np.int64(1) << np.int64(60)
    return (np.concatenate([row, n, n]),
            np.concatenate([both[used], tag | (b << 18) | c, (tag << np.int64(1)) | (a << 18) | c]))


def _key_batches(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fp), 16384):
            row, key = block_keys(fp[at:at + 16384])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(fp[at:at + 16384][row].view(np.int64))], ["key", "fp"])


def linked_sets(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) that join the linked sets of distinct fingerprints:
    breadth-first growth, one edge per fingerprint reached."""
    left = fp
    out_a, out_b = [], []
    while len(left):
        seed, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            step = max(1, (1 << 20) // max(1, len(left)))
            for at in range(0, len(front), step):
                open_ = np.flatnonzero(~hit)
                near = np.bitwise_count(front[at:at + step, None] ^ left[None, open_]) <= max_bits
                hit[open_[near.any(axis=0)]] = True
            front, left = left[hit], left[~hit]
            out_a.append(np.full(len(front), seed))
            out_b.append(front)
    none = np.zeros(0, np.uint64)
    return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])


def _edges_of(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Verified edges inside each run of equal keys (``key`` sorted)."""
    cut = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.r_[0, cut], np.r_[cut, len(key)]
    sizes = ends - starts
    size_of = np.repeat(sizes, sizes)
    small = (size_of > 1) & (size_of <= SMALL_GROUP)
    k, f = key[small], fp[small]
    a, b = [], []
    for step in range(1, SMALL_GROUP):
        same = np.flatnonzero(k[step:] == k[:-step]) if len(k) > step else np.zeros(0, np.int64)
        if not len(same):
            break
        near = same[np.bitwise_count(f[same] ^ f[same + step]) <= MAX_BITS]
        a.append(f[near])
        b.append(f[near + step])
    for s, e in zip(starts[sizes > SMALL_GROUP], ends[sizes > SMALL_GROUP]):
        x, y = linked_sets(fp[s:e])
        a.append(x)
        b.append(y)
    none = np.zeros(0, np.uint64)
    x, y = np.concatenate(a or [none]), np.concatenate(b or [none])
    pairs = np.unique(np.stack([x, y], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)],
                                      ["u", "v"])


def _edge_batches(batches):
    """Batches sorted by key; a key's rows may span batches, so the last run is
    carried over until its key ends."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        k = batch.column("key").to_numpy(zero_copy_only=False)
        f = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
        if len(key) and key[0] != key[-1]:
            last = int(np.searchsorted(key, key[-1]))
            yield _edges_of(key[:last], fp[:last])
            key, fp = key[last:], fp[last:]
    if len(key):
        yield _edges_of(key, fp)


def spread(keyed: DataFrame) -> DataFrame:
    """(key, fp) with every key of more than ``GROUP_ROWS`` rows replaced by one
    key for each pair of its blocks; two fingerprints of a key still meet.
    Pairs whose new keys collide only meet more rows, and links are verified."""
    size = F.count(F.lit(1))
    common = keyed.groupBy("key").agg(size.alias("n")).filter(F.col("n") > GROUP_ROWS)
    blocks = store(common.select("key", F.ceil(2 * F.col("n") / GROUP_ROWS).cast("int").alias("_blocks")), "simhash-common")
    mine = F.pmod(F.xxhash64("fp"), F.col("_blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: b != mine)
    pairs = F.transform(others, lambda b: F.xxhash64("key", F.least(b, mine), F.greatest(b, mine)))
    keys = F.when(F.col("_blocks").isNull(), F.array("key")).otherwise(pairs)
    return keyed.join(blocks, "key", "left").select(F.explode(keys).alias("key"), "fp")


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints of column ``fp`` that join
    exactly the sets linked by steps of at most ``MAX_BITS`` bits."""
    keyed = spread(fps.select("fp").mapInArrow(_key_batches, "key long, fp long"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = keyed.repartition(n, "key").sortWithinPartitions("key")
    return met.mapInArrow(_edge_batches, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of
    the component.  Alternating large-star and small-star rounds, each
    checkpointed in the shared folder, until the edges stop changing."""
    def star(e: DataFrame, both: bool) -> DataFrame:
        half = e.filter("u != v")
        if both:
            half = half.unionByName(half.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            half = half.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = half.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if both:
            out = half.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = (half.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))))
        return out.filter("u != v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = checkpoint(edges)
    before = None
    while (state := mark(now)) != before:
        before = state
        now = checkpoint(star(star(now, True), False))
    pairs = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = now.select(F.col("v").alias("node")).distinct().join(pairs, "node", "left_anti")
    return pairs.unionByName(roots.select("node", F.col("node").alias("root")))


def _members(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, ``keep``, fp, component_id and root (the component's smallest
    fingerprint) of every row."""
    prints = store(fingerprints(docs, *keep), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(distinct))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    named = store(named, "simhash-roots")
    ids = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = named.join(ids, "root").select("fp", "component_id", "root")
    return prints.join(by_print, "fp").select("doc_id", *keep, "fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    return _members(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row (all columns) of each component: that of the smallest doc_id
    (null last), then of the smallest hash of doc_id and text.  Of rows equal in
    both one stays, chosen by a hash of all columns.  Components that share a
    doc_id keep a row each."""
    name = F.col("doc_id").cast("string")
    row = F.sha2(F.concat(F.coalesce(F.length(name).cast("string"), F.lit("")), F.lit(":"), F.coalesce(name, F.lit("")),
                          F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    rows = docs.withColumn(ROW, row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(ROW).alias("row")))
    kept = _members(rows, ROW).groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias(ROW))
    chosen = rows.join(kept, ROW, "left_semi")
    whole = F.xxhash64(*[F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()])
    same = F.row_number().over(Window.partitionBy(ROW).orderBy(whole))
    return chosen.withColumn(RANK, same).filter(F.col(RANK) == 1).select(*docs.columns)
