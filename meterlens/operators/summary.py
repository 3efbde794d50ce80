"""Report numbers and dashboard feeds: daily summary, monthly/yearly report
totals, dashboard export, pipeline-run listing.

Report outputs are long (section, metric, value) tables: each one-row aggregate
is computed once and exploded into its rows -- no joins between scalars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import exact, snap

# Average tariff (NPR/kWh), note of a day without readings.
AVG_TARIFF = 9.0
NO_DATA = "No smart meter data found for "


def _long(df: DataFrame, rows: list[tuple[str, str, str, bool]]) -> DataFrame:
    """One-row frame -> rows (report, section, metric, value_num, value_text).
    ``rows``: report, section, column, whether it is a number."""
    cells = [F.struct(F.lit(report).alias("report"), F.lit(section).alias("section"), F.lit(c).alias("metric"),
                      (F.col(c).cast("double") if number else F.lit(None).cast("double")).alias("value_num"),
                      (F.lit(None).cast("string") if number else F.col(c).cast("string")).alias("value_text"))
             for report, section, c, number in rows]
    return df.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


# ---------------------------------------------------------------- A20
def daily_summary(peak_calendar: DataFrame, report_date: str) -> DataFrame:
    """Totals for one day from the peak calendar; a note when the day has no rows."""
    day = peak_calendar.filter(F.col("date") == F.to_date(F.lit(report_date)))
    a = day.agg(F.count(F.lit(1)).alias("_n"),
                exact(F.sum("daily_total_kwh")).alias("total_kwh"),
                F.max("peak_hour_kwh").alias("peak_kwh"),
                exact(F.avg("avg_kwh")).alias("avg_kwh"),
                snap(F.avg("avg_pf"), 3).alias("avg_pf"))
    return a.select(F.lit(report_date).cast("date").alias("report_date"),
                    "total_kwh", "peak_kwh", "avg_kwh", "avg_pf",
                    F.when(F.col("_n") == 0, F.concat(F.lit(NO_DATA),
                                                      F.lit(report_date))).alias("note"))


def monthly_fallback(monthly: DataFrame) -> DataFrame:
    """Latest month's estimate when no meter data exists."""
    a = monthly.agg(F.max_by(F.struct("avg_daily_mwh", "peak_demand_mw"),
                             F.struct("year", "month")).alias("_l"))
    return a.select(snap("_l.avg_daily_mwh", 1).alias("est_daily_mwh"),
                    snap("_l.peak_demand_mw", 1).alias("est_peak_mw"))


# ---------------------------------------------------------------- A21 / A22
def loss_totals(losses: DataFrame) -> DataFrame:
    """Total loss, revenue impact at 9 NPR/kWh, recoverable GWh, highest and
    lowest loss province (ties: first by name)."""
    loss = F.col("system_loss_pct")
    return losses.agg(
        exact(F.sum("estimated_loss_gwh")).alias("total_loss_gwh"),
        exact(F.sum(F.col("estimated_loss_gwh") * AVG_TARIFF)).alias("revenue_impact_npr_mn"),
        exact(F.sum("potential_saving_gwh")).alias("total_recoverable_gwh"),
        F.min_by("province_name", F.when(loss.isNotNull(), F.struct(-loss, F.col("province_name"))))
        .alias("highest_loss_province"),
        F.max(loss).alias("highest_loss_pct"),
        F.min_by("province_name", F.when(loss.isNotNull(), F.struct(loss, F.col("province_name"))))
        .alias("lowest_loss_province"),
        F.min(loss).alias("lowest_loss_pct"))


MONTH_NUMBERS = ["total_gwh", "peak_demand_mw", "load_factor_pct", "growth_rate_pct", "seasonal_index",
                 "total_gwh_3m_avg"]
MONTH_TEXTS = ["month_name", "season", "fiscal_year"]
YEAR_NUMBERS = ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh",
                "system_loss_pct", "total_energy_gwh_yoy_pct", "self_sufficiency_ratio", "load_factor_pct"]
LOSS_NUMBERS = ["total_loss_gwh", "revenue_impact_npr_mn", "total_recoverable_gwh"]
LOSS_RANGE = ["highest_loss_pct", "lowest_loss_pct"]
LOSS_TEXTS = ["highest_loss_province", "lowest_loss_province"]


def _cells(report: str, section: str, numbers: list[str], texts: list[str]) -> list[tuple[str, str, str, bool]]:
    return [(report, section, c, True) for c in numbers] + [(report, section, c, False) for c in texts]


def period_reports(monthly_trends: DataFrame, annual_summary: DataFrame, losses: DataFrame,
                   year: int, month: int, fiscal_year: str) -> DataFrame:
    """The monthly and the yearly report; the loss totals are computed once."""
    m, y = f"monthly {year}-{month:02d}", f"yearly {fiscal_year}"
    in_month = monthly_trends.filter((F.col("year") == year) & (F.col("month") == month))
    in_year = annual_summary.filter(F.col("fiscal_year") == fiscal_year)
    return (_long(in_month, _cells(m, "current_month", MONTH_NUMBERS, MONTH_TEXTS))
            .unionByName(_long(in_year, _cells(y, "fiscal_year", YEAR_NUMBERS, ["fiscal_year"])))
            .unionByName(_long(loss_totals(losses), _cells(m, "system_losses", LOSS_NUMBERS + LOSS_RANGE, LOSS_TEXTS)
                               + _cells(y, "system_losses", LOSS_NUMBERS, LOSS_TEXTS))))


# ---------------------------------------------------------------- S22
def dashboard_export(annual_summary: DataFrame, exported_at=None) -> DataFrame:
    return annual_summary.select(
        F.lit("Annual").alias("metric_type"), F.col("fiscal_year").alias("period"),
        F.col("total_energy_gwh").alias("total_gwh"), F.col("peak_demand_mw").alias("peak_mw"),
        F.col("total_consumers").alias("consumers"), "per_capita_kwh", "system_loss_pct",
        F.col("self_sufficiency_ratio").alias("self_sufficiency"))


# ---------------------------------------------------------------- K5 / S20
def pipeline_runs_from_events(events: DataFrame) -> DataFrame:
    """Audit rows standing in for the run log: one run per (event type, day)."""
    d = F.to_date("ts")
    g = events.groupBy(F.col("event_type").alias("pipeline_name"), d.alias("_d")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("records_loaded"),
        F.count_if(F.col("value") < 1).alias("records_failed"))
    return g.select(
        F.concat_ws("-", "pipeline_name", F.date_format("_d", "yyyyMMdd")).alias("run_id"),
        "pipeline_name", "start_time", "end_time",
        F.when(F.col("records_failed") > 0, "partial").otherwise("success").alias("status"),
        "records_loaded", "records_failed",
        F.when(F.col("records_failed") > 0,
               F.concat(F.col("records_failed").cast("string"), F.lit(" readings below 1 kWh")))
        .alias("error_message"))


def recent_runs(runs: DataFrame, limit: int = 20, zone: str = "Asia/Kathmandu") -> DataFrame:
    """Latest runs with local start/end and duration in minutes."""
    return runs.select(
        "run_id", "pipeline_name",
        F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("start_time")).alias("start_npt"),
        F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("end_time")).alias("end_npt"),
        (F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / 60e6)
        .alias("duration_minutes"),
        "status", "records_loaded", "error_message",
    ).orderBy(F.col("start_npt").desc(), F.col("run_id")).limit(limit)


def log_pipeline_run(spark, name: str, start, end, status: str, loaded: int,
                     error: str | None = None) -> DataFrame:
    """The one audit row to append to the run log."""
    import uuid
    return spark.createDataFrame(
        [(str(uuid.uuid4()), name, start, end, status, int(loaded), error)],
        "run_id string, pipeline_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "status string, records_loaded long, error_message string")
