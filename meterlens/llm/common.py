"""Helpers shared by the corpus operators: shipping the package to Python
workers, bounded slices of Arrow batches, flat UTF-8 views of text columns,
written-and-reread cuts in the shared checkpoint folder."""

from __future__ import annotations

import ctypes
import gc
import os
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_folder, cut_lineage

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run (``addPyFile``
    of a zip of the sources, once per session)."""
    sc = spark.sparkContext
    if getattr(sc, "_meterlens_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="meterlens-src-"), "meterlens_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._meterlens_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    return checkpoint_folder(spark).rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts
    lineage, survives lost executors, and later readers see the same rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


checkpoint = cut_lineage  # reliable, in the shared folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id) -> "F.Column":
    """True for rows of the held-out third: crc32 of doc_id as text, mod 3 = 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def smallest_hashes(ids: DataFrame, group: str, per_group: int) -> DataFrame:
    """doc_id and ``group`` of the ``per_group`` distinct doc_ids of smallest hash
    in each group.  The groups' sizes come first (a few classes or languages),
    counted in distinct doc_ids like the bound on the hash, which leaves about
    three times as many as wanted, so the ranking never sees a large group and
    no group comes out empty however often its rows repeat."""
    ids = ids.select("doc_id", group).filter(F.col(group).isNotNull()).distinct()
    share = {r[0]: min(1.0, (3.0 * per_group + 50) / r[1]) for r in ids.groupBy(group).count().collect()}
    if not share:
        return ids.limit(0)
    bound = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col(group))
    hashed = ids.select("doc_id", group, (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)).alias("_h"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_h", "doc_id"))
    return hashed.filter(F.col("_h") < bound).withColumn("_k", rank).filter(F.col("_k") <= per_group).select("doc_id", group)


def one_text_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per ``keys``: that of the smallest text hash.  A sample of ids thus
    has as many rows, however often an id repeats."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("text"), "text"))
    return rows.withColumn("_first", first).filter(F.col("_first") == 1).drop("_first")


def fit_in_task(rows: DataFrame, fit: Callable[[pd.DataFrame], Any]) -> Any:
    """``fit`` of ``rows`` (a sample of bounded size) in one task: what comes to
    the driver is the fitted model alone.  A task that runs again fits the same."""
    ship(rows.sparkSession)
    names = rows.columns

    def run(batches):
        got = list(batches)
        frames = [pa.Table.from_batches(got).to_pandas() if got else pd.DataFrame(columns=names)]
        del got
        release()
        model = pickle.dumps(fit(frames.pop()))
        release()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else fit(pd.DataFrame(columns=names))


def text_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``text`` with null as the empty string."""
    return docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next
    task keeps no more than it holds."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches with at most ``max_bytes`` of ``column`` each;
    a longer single row comes alone and whole."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), n)
            yield batch.slice(at, to - at)
            at = to
        del batch
    release()


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, without copying; row i is
    ``bytes[offsets[i]:offsets[i + 1]]``.  Nulls are read as empty."""
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d, o.astype(np.int64)


def byte_rows(col: pa.Array) -> list[bytes]:
    """The rows as UTF-8 ``bytes``."""
    d, o = utf8(col)
    raw = d.tobytes() if len(d) < 1 << 16 else memoryview(d)
    return [bytes(raw[a:b]) for a, b in zip(o[:-1].tolist(), o[1:].tolist())]


_POWERS: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("fwd")
    if have is None or len(have) < n:
        n = max(n, 1 << 20)
        fwd, inv = np.empty(n, np.uint64), np.empty(n, np.uint64)
        fwd[0] = inv[0] = 1
        np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)], out=fwd)
        np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _BASE_INV, np.uint64)], out=inv)
        _POWERS["fwd"], _POWERS["inv"] = fwd, inv
    return _POWERS["fwd"], _POWERS["inv"]


_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]``, whole arrays at once: equal
    spans have equal hashes wherever they lie (a polynomial hash read off
    prefix sums, then mixed with the length)."""
    fwd, inv = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[data] * fwd[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inv[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of ``data`` as a string column (spans may overlap)."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.arange(offsets[-1], dtype=np.int64) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ``a`` and ``b`` hold the same bytes in each pair of spans."""
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    other = np.zeros(len(at) + 1, np.int64)
    np.cumsum(a[at + np.repeat(a_starts, sizes)] != b[at + np.repeat(b_starts, sizes)], out=other[1:])
    return other[ends] == other[ends - sizes]


def runs(mask: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``mask``; a run also ends at each
    position in ``cuts`` (row boundaries)."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    inner = cuts[(cuts > 0) & (cuts < n)]
    begin[inner] |= mask[inner]
    stop = mask.copy()
    stop[:-1] &= ~mask[1:]
    stop[inner - 1] |= mask[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1
