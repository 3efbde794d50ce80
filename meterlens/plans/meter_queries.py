"""Driver queries over ``events`` read as hourly meter readings."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import snap
from ..operators import meters as M
from ..operators import moments, sketches
from ..sources.tables import EVENT_TYPE_BOUNDS, meter_readings, read_table

RANGE_START, RANGE_END = "2024-01-05", "2024-01-20"


@lru_cache(maxsize=64)
def raw_meters(spark: SparkSession, sf: str) -> DataFrame:
    return meter_readings(read_table(spark, sf, "events"))


@lru_cache(maxsize=64)
def clean(spark: SparkSession, sf: str) -> DataFrame:
    return M.clean_meters(raw_meters(spark, sf), bounds=EVENT_TYPE_BOUNDS)


def ranged(spark, sf, start=RANGE_START, end=RANGE_END):
    """Inclusive range on the hourly timestamp.  The stand-in's ``timestamp``
    is the hour of the stored event time ``read_at``, so the same range is also
    stated on ``read_at`` (start <= read_at < end + 1 hour for hour-aligned
    bounds): an equivalent predicate that reaches the Parquet scan."""
    df = raw_meters(spark, sf)
    t = lambda s: F.to_timestamp_ntz(F.lit(s))
    df = df.filter((F.col("read_at") >= t(start))
                   & (F.col("read_at") < F.timestamp_add("HOUR", F.lit(1), t(end))))
    return M.readings_in_range(df, start, end)


def q_meter_readings_range(spark, sf):
    return ranged(spark, sf)


def q_meter_extract_stats(spark, sf):
    return M.extraction_stats(ranged(spark, sf))


def q_meter_registry(spark, sf):
    return M.meter_registry(raw_meters(spark, sf))


def q_meter_clean(spark, sf):
    return clean(spark, sf)


def q_meter_outlier_counts(spark, sf):
    return M.outlier_counts(raw_meters(spark, sf), EVENT_TYPE_BOUNDS)


def q_meter_features(spark, sf):
    return M.engineer_features(clean(spark, sf))


def q_hourly_system_load(spark, sf):
    return M.hourly_system_load(clean(spark, sf))


def q_hourly_load_profile(spark, sf):
    return M.hourly_load_profile(clean(spark, sf))


def q_load_profile_sql(spark, sf):
    return M.load_profile_sql(clean(spark, sf))


def q_daily_load_curve(spark, sf):
    return M.daily_load_curve(clean(spark, sf))


def q_peak_calendar(spark, sf):
    return M.peak_calendar(clean(spark, sf))


def q_load_factor_daily(spark, sf):
    return M.load_factor_daily(clean(spark, sf))


def q_mean_load_factor(spark, sf):
    return M.mean_load_factor(M.load_factor_daily(clean(spark, sf)))


def q_peak_offpeak_ratio(spark, sf):
    return M.peak_offpeak_ratio(clean(spark, sf))


def q_low_value_meters(spark, sf):
    return M.low_power_factor_meters(clean(spark, sf))


def q_outage_islands(spark, sf):
    return M.outage_islands(raw_meters(spark, sf))


def q_outage_suspects(spark, sf):
    return M.outage_suspects(clean(spark, sf))


def q_demand_peaks_topn(spark, sf):
    return M.demand_peaks(raw_meters(spark, sf), top_n=100)


def q_system_peak_days(spark, sf):
    return M.system_peak_days(clean(spark, sf), top_n=20)


def q_peak_hours_top20(spark, sf):
    return M.peak_hours(clean(spark, sf), top_n=20)


def q_load_duration_curve(spark, sf):
    return M.load_duration_curve(clean(spark, sf))


def q_distinct_meters_rollup(spark, sf):
    return sketches.distinct_meters_checked(clean(spark, sf))


def q_load_quantiles_rollup(spark, sf):
    out = sketches.load_quantiles_checked(clean(spark, sf), {"p50_kwh": 0.5, "p90_kwh": 0.9})
    return out.withColumns({c: snap(c, 4) for c in ("p50_kwh", "p90_kwh")})


def q_load_moments_rollup(spark, sf):
    """Days' moments of load and voltage, merged into months."""
    cols = [M.KWH, M.VOLT]
    days = moments.co_moments(clean(spark, sf), ["date", M.TYPE], cols)
    days = days.select("*", F.year("date").alias("year"), F.month("date").alias("month"))
    months = moments.merge_moments(days, ["year", "month", M.TYPE], cols)
    return months.select("year", "month", M.TYPE, F.col("n").alias("readings"), snap(moments.mean_col(M.KWH), 4).alias("avg_kwh"),
                         snap(moments.std_of(M.KWH), 4).alias("std_kwh"),
                         snap(moments.correlation_of(*cols), 4).alias("r_kwh_voltage"))


QUERIES = {
    "distinct_meters_rollup": q_distinct_meters_rollup,
    "load_quantiles_rollup": q_load_quantiles_rollup,
    "load_moments_rollup": q_load_moments_rollup,
    "meter_readings_range": q_meter_readings_range,
    "meter_extract_stats": q_meter_extract_stats,
    "meter_registry": q_meter_registry,
    "meter_clean": q_meter_clean,
    "meter_outlier_counts": q_meter_outlier_counts,
    "meter_features": q_meter_features,
    "hourly_system_load": q_hourly_system_load,
    "hourly_load_profile": q_hourly_load_profile,
    "load_profile_sql": q_load_profile_sql,
    "daily_load_curve": q_daily_load_curve,
    "peak_calendar": q_peak_calendar,
    "load_factor_daily": q_load_factor_daily,
    "mean_load_factor": q_mean_load_factor,
    "peak_offpeak_ratio": q_peak_offpeak_ratio,
    "low_value_meters": q_low_value_meters,
    "outage_islands": q_outage_islands,
    "outage_suspects": q_outage_suspects,
    "demand_peaks_topn": q_demand_peaks_topn,
    "system_peak_days": q_system_peak_days,
    "peak_hours_top20": q_peak_hours_top20,
    "load_duration_curve": q_load_duration_curve,
}
