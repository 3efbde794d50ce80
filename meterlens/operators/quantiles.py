"""Exact percentiles that never hold a whole group in one task.

Spark's ``percentile`` keeps, per group, a map of every distinct value and
merges it in one task.  Here the rows are first combined to (group, value,
count).  A monotone code cuts the number line into narrow ranges (64 to a
doubling), and counting rows by (group, range) -- a few thousand rows a group
at most -- tells in which range each wanted order statistic lies and at which
position inside it.  Only the values of those ranges are then ordered.  The
result is the same linear interpolation as ``percentile``, at every size, with
NULL as a group like any other and NULL values ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import null_safe_join

_ZERO_OFFSET = 100_000  # beyond the largest |64 * log2(x)| of a double


def _range_code(v: Column) -> Column:
    """An integer that never falls when ``v`` rises; NaN ranks last, NULL has none."""
    size = F.floor(F.least(F.log2(F.abs(v)) * 64, F.lit(_ZERO_OFFSET - 1.0))) + _ZERO_OFFSET
    return (F.when(F.isnan(v), F.lit(10 * _ZERO_OFFSET)).when(v == 0, F.lit(0))
            .when(v > 0, size).when(v < 0, -size).cast("long"))


def _counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def _ranges(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by (group, range); NULL values have no range."""
    return counts.groupBy(*keys, _range_code(F.col("_v")).alias("_b")).agg(F.sum("_c").alias("_rows"))


def _picked(counts: DataFrame, ranges: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    known = counts.filter(F.col("_v").isNotNull()).withColumn("_b", _range_code(F.col("_v")))
    ranges = ranges.filter(F.col("_b").isNotNull()).select(*keys, "_b", "_rows")
    w = Window.partitionBy(*keys)
    up_to = w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("*", F.coalesce(F.sum("_rows").over(up_to), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(w).alias("_n"))
    wanted = []
    for name, p in probs.items():
        pos = (F.col("_n") - 1) * F.lit(float(p))
        wanted += [F.struct(F.lit(f"{name}/lo").alias("slot"), F.floor(pos).alias("at")),
                   F.struct(F.lit(f"{name}/hi").alias("slot"), F.ceil(pos).alias("at"))]
    targets = ranges.select(*keys, "_b", "_n", "_before", "_rows", F.explode(F.array(*wanted)).alias("_w"))
    at = F.col("_w.at") - F.col("_before")
    targets = targets.filter((at >= 0) & (at < F.col("_rows"))).select(
        *keys, "_b", "_n", F.col("_w.slot").alias("_slot"), at.alias("_at"))
    near = null_safe_join(known, targets, [*keys, "_b"])
    within = Window.partitionBy(*keys, "_b", "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_c").over(within), F.lit(0))
    hit = near.withColumn("_start", start).filter(
        (F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_start") + F.col("_c")))
    sides = [F.max(F.when(F.col("_slot") == f"{name}/{side}", F.col("_v"))).alias(f"_{name}_{side}")
             for name in probs for side in ("lo", "hi")]
    got = hit.groupBy(*keys).agg(F.first("_n").alias("_n"), *sides)
    cols = []
    for name, p in probs.items():
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        lo_v, hi_v = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        interp = (hi_i - pos) * lo_v + (pos - lo_i) * hi_v
        cols.append(F.when((lo_i == hi_i) | (lo_v == hi_v), lo_v).otherwise(interp).alias(name))
    return got.select(*keys, *cols)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group that has a value: ``keys`` + one column per name in ``probs``."""
    counts = _counted(df, keys, value)
    return _picked(counts, _ranges(counts, keys), keys, probs)


def grouped_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                        stats: dict[str, str]) -> DataFrame:
    """Percentiles and simple statistics of ``value`` by ``keys``.  ``stats``: name
    -> ``avg``, ``max``, ``std`` (sample), ``count`` (of values) or ``rows``; these
    are Spark's own (centred) aggregates, one buffer a group and task."""
    v = F.col(value).cast("double")
    forms = {"avg": F.avg(v), "max": F.max(v), "std": F.stddev_samp(v), "count": F.count(v), "rows": F.count(F.lit(1))}
    base = df.groupBy(*keys).agg(*[forms[kind].alias(name) for name, kind in stats.items()])
    counts = _counted(df, keys, value)
    out = null_safe_join(base, _picked(counts, _ranges(counts, keys), keys, probs), keys, "left")
    return out.select(*keys, *stats, *probs)
