"""Per-key sequential operators that stay balanced when one key is huge.

A ``Window.partitionBy(key)`` over all rows puts every row of a key into one
task.  Meter data can be dominated by a single meter (a feeder head, a test
rig), so row-order operators never do that here:

* ``index_within``   -- 1-based position per key in time order: a row number
  inside (key, time bucket) plus the key's row count in earlier buckets
  (one row per key and bucket, summed by a small per-key window).  It is a
  deterministic function of the data -- no sampling, same result on every
  recomputation -- and no task holds more than one key-bucket.
* ``cut_buckets``    -- parts buckets of more rows than a bound into runs of
  consecutive rows by range partitioning, so the order inside a hot bucket is
  never one task's work; summaries of the runs are then combined in order.
* ``rolling_avgs``   -- trailing N-row means.  Each key is cut into chunks of
  ``chunk_rows`` consecutive rows; the last N-1 rows of a chunk are copied
  into the next one (a halo), so every chunk window is exact and no task
  holds more than ``chunk_rows + N - 1`` rows.

The same path runs at every size, and NULL is a key like any other: joins on
keys use ``null_safe_join``.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import trunc_ntz
from ..session import cut_lineage

DEFAULT_CHUNK_ROWS = 100_000
DEFAULT_BUCKET = "day"


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; keeps the left keys."""
    other = right.select(*[F.col(k).alias(f"_j_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_j_{k}" for k in keys])


def index_within(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], idx: str = "_idx",
                 bucket: str = DEFAULT_BUCKET, bucket_col: str | None = None) -> DataFrame:
    """1-based row position per key, ordered by (``ts``, ``tiebreak``).

    ``bucket_col``: an existing column equal to ``trunc_ntz(bucket, ts)``;
    reusing it lets earlier windows on (keys, bucket) share the exchange.
    """
    x = df.withColumnRenamed(bucket_col, "_bk") if bucket_col else \
        df.withColumn("_bk", trunc_ntz(bucket, ts))
    # bucket sizes: a partial aggregation over the key and bucket columns only
    sizes = x.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys, "_bk").orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    x = x.withColumn("_rn", F.row_number().over(w))
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_bk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (null_safe_join(x, offsets, keys + ["_bk"])
            .withColumn(idx, (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_bk", "_rn", "_off"))


def cut_buckets(df: DataFrame, keys: list[str], bucket_col: str, order: list[str],
                max_rows: int = DEFAULT_CHUNK_ROWS, part: str = "_part") -> DataFrame:
    """Adds ``part``: 0 for rows of a (keys, bucket) of at most ``max_rows`` rows,
    else the number of a run of consecutive rows by ``order`` with no more than
    that.  (keys, bucket, part) ascending is the order of the rows' runs.

    One count per (keys, bucket) finds the large ones.  Only their rows are range
    partitioned, into twice the partitions needed since the ranges come from a
    sample, and stored once, so that later stages and repeated tasks see the same
    cut.  Rows equal in keys and ``order`` stay together.
    """
    sizes = df.groupBy(*keys, bucket_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    total = sizes.agg(F.sum("_n")).first()[0]
    if not total:
        return df.withColumn(part, F.lit(0))
    at = [*keys, bucket_col]
    large = cut_lineage(sizes.select(*at))  # at most one row in max_rows
    runs = null_safe_join(df, large, at, "left_semi").repartitionByRange(ceil(2 * total / max_rows), *at, *order)
    runs = cut_lineage(runs).withColumn(part, F.spark_partition_id())
    return null_safe_join(df, large, at, "left_anti").withColumn(part, F.lit(0)).unionByName(runs)


def rolling_avgs(indexed: DataFrame, keys: list[str], idx: str, specs: dict[str, tuple[str, int]],
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``specs``: output name -> (value column, window rows N); mean of the
    current and N-1 preceding rows of the same key (NULLs ignored)."""
    halo = max(n for _, n in specs.values()) - 1
    if chunk_rows <= halo:
        raise ValueError("chunk_rows must exceed the longest window")
    pos = F.col(idx) - 1
    chunk = F.floor(pos / chunk_rows).cast("long")
    in_halo_zone = (pos % chunk_rows) >= (chunk_rows - halo)
    chunks = F.when(in_halo_zone, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    x = indexed.select("*", chunk.alias("_own_chunk"), F.explode(chunks).alias("_chunk"))
    w = Window.partitionBy(*keys, "_chunk").orderBy(idx)
    out = x.select("*", *[F.avg(c).over(w.rowsBetween(-(n - 1), 0)).alias(name)
                          for name, (c, n) in specs.items()])
    return out.filter(F.col("_chunk") == F.col("_own_chunk")).drop("_chunk", "_own_chunk")
