"""Date dimension (C12) and joins against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.exprs import exact


def date_dimension(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per calendar day between ``start`` and ``end`` of each input row.

    ``bounds`` is normally a one-row aggregate (min/max date of a fact
    table); the generated row count is the number of days, independent of
    the fact volume.  Local-calendar (BS) and holiday columns stay NULL (declared
    but never computed by the reference).
    """
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("full_date")).distinct()
    d = F.col("full_date")
    m = F.month(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d,
        F.year(d).alias("year"), m.alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        cal.weekday0(d).alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        cal.weekday0(d).isin(5, 6).alias("is_weekend"),
        F.lit(False).alias("is_public_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        cal.fiscal_year(d).alias("fiscal_year"),
        cal.fiscal_quarter(d).alias("fiscal_quarter"),
        (((m - 7 + 12) % 12) + 1).alias("fiscal_month"),
        F.lit(None).cast("int").alias("bs_year"),
        F.lit(None).cast("int").alias("bs_month"),
        F.lit(None).cast("int").alias("bs_day"),
        F.lit(None).cast("string").alias("bs_month_name"),
        cal.season_of_month(m).alias("season"),
        cal.is_monsoon(m).alias("is_monsoon"),
    )


def date_bounds(df: DataFrame, col: str | Column) -> DataFrame:
    c = F.to_date(col if isinstance(col, Column) else F.col(col))
    return df.agg(F.min(c).alias("start_date"), F.max(c).alias("end_date"))


def daily_system_load_view(meters: DataFrame, dim: DataFrame) -> DataFrame:
    """Meter facts JOIN date dimension on date_id, grouped by day,
    fiscal year, season, monsoon, weekend and consumer type."""
    facts = meters.select("meter_id", "consumer_type", "consumption_kwh", "voltage_v", "power_factor",
                          F.date_format("timestamp", "yyyyMMdd").cast("int").alias("date_id"))
    d = dim.select("date_id", "full_date", "fiscal_year", "season", "is_monsoon", "is_weekend")
    j = facts.join(d, "date_id")
    return j.groupBy("full_date", "fiscal_year", "season", "is_monsoon", "is_weekend",
                     "consumer_type").agg(
        exact(F.sum("consumption_kwh")).alias("total_kwh"),
        exact(F.avg("voltage_v")).alias("avg_voltage"),
        exact(F.avg("power_factor")).alias("avg_power_factor"),
        F.max("consumption_kwh").alias("peak_kwh"),
        F.count_distinct("meter_id").alias("active_meters"))


def monthly_series_panel(monthly: DataFrame, dim: DataFrame) -> DataFrame:
    """Monthly facts JOIN date dimension, month-truncated time axis."""
    m = monthly.withColumn("date_id", F.date_format("date", "yyyyMMdd").cast("int"))
    j = m.join(dim.select("date_id", "full_date"), "date_id")
    return j.select(cal.trunc_ntz("month", "full_date").alias("time"),
                    F.col("total_gwh").alias("value"), F.lit("Total").alias("metric"))
