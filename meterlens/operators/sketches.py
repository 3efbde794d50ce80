"""Daily sketches that roll up to any period without the readings.

A day's distinct meters are an HLL sketch by (date, type), its load distribution
a KLL sketch by (date, type, hour); both are Spark's own aggregates, merge on the
map side and are of fixed size, so months and years come from the daily table.

Errors: a distinct count is off by about ``hll_error`` (one standard deviation,
as a share); the rank of a KLL quantile by at most ``kll_error`` in 99 of 100
cases.  The exact answers stay ``meter_registry`` and ``quantiles``.
NULL meters and NULL loads are not counted; a group with none has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .meters import KWH, METER, TYPE
from .quantiles import exact_percentiles
from .sequence import null_safe_join

LOG_BUCKETS = 12
KLL_K = 400


def hll_error(log_buckets: int = LOG_BUCKETS) -> float:
    return 1.04 / 2 ** (log_buckets / 2)


def kll_error(k: int = KLL_K) -> float:
    """The published fit of the sketch's rank error at 99 %."""
    return 2.296 / k ** 0.9723


def daily_meters(clean: DataFrame, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """date, type, ``meters``: a sketch of the day's distinct meters."""
    known = clean.filter(F.col(METER).isNotNull())
    return known.groupBy("date", TYPE).agg(F.hll_sketch_agg(F.col(METER).cast("string"), F.lit(log_buckets)).alias("meters"))


def distinct_meters(daily: DataFrame, keys: list[str | Column]) -> DataFrame:
    """``keys``, ``meters`` (merged) and the estimate ``n_meters`` of each period."""
    merged = daily.groupBy(*keys).agg(F.hll_union_agg("meters").alias("meters"))
    return merged.withColumn("n_meters", F.hll_sketch_estimate("meters"))


def daily_loads(clean: DataFrame, k: int = KLL_K) -> DataFrame:
    """date, type, hour, ``loads``: a sketch of the hour's loads."""
    known = clean.filter(F.col(KWH).isNotNull())
    return known.groupBy("date", TYPE, "hour").agg(F.kll_sketch_agg_double(F.col(KWH).cast("double"), F.lit(k)).alias("loads"))


def load_quantiles(daily: DataFrame, keys: list[str | Column], probs: dict[str, float], k: int = KLL_K) -> DataFrame:
    """``keys``, ``readings`` and one estimated quantile per name of ``probs``."""
    merged = daily.groupBy(*keys).agg(F.kll_merge_agg_double("loads", F.lit(k)).alias("loads"))
    return merged.select("*", F.kll_sketch_get_n_double("loads").alias("readings"),
                         *[F.kll_sketch_get_quantile_double("loads", F.lit(float(p))).alias(name) for name, p in probs.items()]).drop("loads")


def month_keys() -> list[Column]:
    return [F.year("date").alias("year"), F.month("date").alias("month"), F.col(TYPE)]


def distinct_meters_checked(clean: DataFrame) -> DataFrame:
    """Monthly distinct meters, exact, and whether the rolled-up estimate lies
    within four standard deviations of it."""
    by = ["year", "month", TYPE]
    exact = clean.groupBy(*month_keys()).agg(F.count_distinct(METER).alias("meter_count"))
    near = null_safe_join(exact, distinct_meters(daily_meters(clean), month_keys()).drop("meters"), by, "left")
    off = F.abs(F.coalesce("n_meters", F.lit(0)) - F.col("meter_count"))
    return near.select(*by, "meter_count", (off <= F.greatest(F.lit(1.0), 4 * hll_error() * F.col("meter_count"))).alias("estimate_close"))


def load_quantiles_checked(clean: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Monthly load quantiles, exact, and whether the rank of the rolled-up estimate
    lies within twice the sketch's error; the rank is counted over all readings
    (the estimates joined to them are one row a month and type)."""
    by = ["year", "month", TYPE]
    rows = clean.select(*month_keys(), F.col(KWH).cast("double").alias("_x")).filter("_x IS NOT NULL")
    guess = load_quantiles(daily_loads(clean), month_keys(), {f"_{n}": p for n, p in probs.items()})
    ranked = null_safe_join(rows, guess, by)
    ranked = ranked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("readings"), F.first("readings").alias("_seen"),
        *[F.avg((F.col("_x") < F.col(f"_{n}")).cast("double")).alias(f"_{n}_from") for n in probs],
        *[F.avg((F.col("_x") <= F.col(f"_{n}")).cast("double")).alias(f"_{n}_to") for n in probs])
    out = null_safe_join(ranked, exact_percentiles(rows, by, "_x", probs), by)
    bound = 2 * kll_error()
    close = [((F.col("_seen") == F.col("readings")) & (F.col(f"_{n}_from") - bound <= p) & (F.col(f"_{n}_to") + bound >= p)).alias(f"{n}_close")
             for n, p in probs.items()]
    return out.select(*by, "readings", *probs, *close)
