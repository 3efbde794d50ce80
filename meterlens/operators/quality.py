"""Data quality: profiles, constraint audit, validation checks, metrics and alerts.

Fixed values that must equal the reference:
  * validation: at least 70 % of year-on-year differences positive (fails the
    run); voltage-flag rate below 5 % (warning); every province loss within
    10..35 % (warning); every monthly total above 0 (fails the run).
  * data quality = valid / total * 100 (0 when empty), alert below 95 %.
  * alert thresholds: pipeline duration 120 min, system loss 25 %,
    peak demand 2500 MW; a breach is strictly greater than the threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import exact, snap

THRESHOLDS = {"pipeline_max_duration_minutes": 120.0, "data_quality_min_pct": 95.0,
              "peak_demand_alert_mw": 2500.0, "system_loss_alert_pct": 25.0}
ALERT_RULES = [("pipeline_duration_minutes", 120.0, "WARNING"),
               ("system_loss_pct", 25.0, "WARNING"),
               ("peak_demand_mw", 2500.0, "CRITICAL")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------------------- F7
def profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and total NULLs in one aggregation pass."""
    nulls = reduce(lambda a, b: a + b,
                   [F.sum(F.col(c).isNull().cast("long")) for c in df.columns])
    return df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).alias("columns"),
                  F.coalesce(nulls, F.lit(0)).cast("long").alias("total_nulls"))


# ---------------------------------------------------------------- S21
def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once (PRIMARY KEY / UNIQUE)."""
    d = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return d.agg(F.lit(table).alias("table_name"),
                 F.lit(f"unique({', '.join(keys)})").alias("check_name"),
                 F.count(F.lit(1)).alias("violations"))


def table_audit(df: DataFrame, table: str, references: dict[str, tuple[DataFrame, str]] | None = None,
                rules: dict[str, Column] | None = None) -> DataFrame:
    """Foreign keys and CHECK / NOT NULL rules of one table, all counted in one
    pass: the child is joined with each parent's distinct keys, then one
    aggregate counts the rows that fail each test.  ``references``: foreign key
    -> (parent, its key); a NULL foreign key refers to nothing and passes."""
    x, tests = df, {}
    for fk, (parent, pk) in (references or {}).items():
        keys = parent.select(F.col(pk).alias(f"_p_{fk}")).filter(F.col(f"_p_{fk}").isNotNull()).distinct()
        x = x.join(keys, F.col(fk) == F.col(f"_p_{fk}"), "left")
        tests[f"foreign_key({fk})"] = F.col(fk).isNull() | F.col(f"_p_{fk}").isNotNull()
    tests.update(rules or {})
    return rule_violations(x, table, tests)


def rule_violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """CHECK / NOT NULL rules: one row per rule, counted in one pass."""
    a = df.agg(*[F.count_if(~F.coalesce(pred, F.lit(False))).alias(name)
                 for name, pred in rules.items()])
    long = a.unpivot([], list(rules), "check_name", "violations")
    return long.select(F.lit(table).alias("table_name"), "check_name",
                       F.col("violations").cast("long").alias("violations"))


def constraint_audit(checks: list[DataFrame]) -> DataFrame:
    return _union(checks)


# ---------------------------------------------------------------- Q1
def validation_checks(annual: DataFrame, meters: DataFrame | None, provinces: DataFrame | None,
                      monthly: DataFrame | None) -> DataFrame:
    """One row per check: (check, severity, passed, value)."""
    frames = []
    w = Window.orderBy("fiscal_year")  # annual series: one row per fiscal year
    diff = F.col("total_energy_gwh") - F.lag("total_energy_gwh").over(w)
    g = annual.select(diff.alias("_d")).agg(
        F.avg(F.when(F.col("_d").isNotNull(), (F.col("_d") > 0).cast("double"))).alias("_v"),
        F.count(F.lit(1)).alias("_n"))
    frames.append(g.select(
        F.lit("annual_growth").alias("check_name"), F.lit("FAIL").alias("severity"),
        F.when(F.col("_n") <= 1, F.lit(True)).otherwise(F.coalesce(F.col("_v") >= 0.7, F.lit(False)))
        .alias("passed"), exact("_v").alias("value")))
    if meters is not None:
        m = meters.agg(F.avg(F.col("voltage_flag").cast("double")).alias("_v"))
        frames.append(m.select(F.lit("voltage_flag_rate").alias("check_name"),
                               F.lit("WARN").alias("severity"),
                               F.coalesce(F.col("_v") < 0.05, F.lit(False)).alias("passed"),
                               exact("_v").alias("value")))
    if provinces is not None:
        p = provinces.agg(F.bool_and(F.coalesce(F.col("system_loss_pct").between(10, 35), F.lit(False)))
                          .alias("_ok"), F.count_if(~F.coalesce(
                              F.col("system_loss_pct").between(10, 35), F.lit(False))).alias("_bad"))
        frames.append(p.select(F.lit("province_loss_range").alias("check_name"),
                               F.lit("WARN").alias("severity"),
                               F.coalesce(F.col("_ok"), F.lit(True)).alias("passed"),
                               F.col("_bad").cast("double").alias("value")))
    if monthly is not None:
        q = monthly.agg(F.count_if(~F.coalesce(F.col("total_gwh") > 0, F.lit(False))).alias("_bad"))
        frames.append(q.select(F.lit("monthly_totals_positive").alias("check_name"),
                               F.lit("FAIL").alias("severity"), (F.col("_bad") == 0).alias("passed"),
                               F.col("_bad").cast("double").alias("value")))
    return _union(frames)


def run_passes(checks: DataFrame) -> DataFrame:
    """Overall verdict: only FAIL-severity checks can fail the run."""
    return checks.agg(F.bool_and(F.when(F.col("severity") == "FAIL", F.col("passed"))
                                 .otherwise(F.lit(True))).alias("run_passed"))


# ---------------------------------------------------------------- Q2 / Q3 / Q5 / Q6
def data_quality(dataset: str, df: DataFrame, valid: Column, ts: Column | None = None) -> DataFrame:
    """Q2 as a metric row: data_quality_pct = valid / total * 100 (0 when empty)."""
    a = df.agg(F.count(F.lit(1)).alias("_t"), F.count_if(F.coalesce(valid, F.lit(False))).alias("_v"))
    return a.select(F.lit("data_quality_pct").alias("name"),
                    F.when(F.col("_t") > 0, snap(F.col("_v") * 100.0 / F.col("_t"), 6))
                    .otherwise(F.lit(0.0)).alias("value"),
                    F.create_map(F.lit("dataset"), F.lit(dataset)).alias("labels"),
                    F.lit(None).cast("timestamp_ntz").alias("ts"))


def metric_rows(df: DataFrame, name: str, value: Column, labels: dict[str, Column] | None = None,
                ts: Column | None = None) -> DataFrame:
    """Turn rows into metric records (name, value, labels, ts)."""
    lab = F.create_map(*[x for k, v in (labels or {}).items() for x in (F.lit(k), v)]) \
        if labels else F.create_map().cast("map<string,string>")
    return df.select(F.lit(name).alias("name"), value.cast("double").alias("value"),
                     lab.alias("labels"),
                     (ts if ts is not None else F.lit(None)).cast("timestamp_ntz").alias("ts"))


def latest_metrics(events: DataFrame, tie: str = "value") -> DataFrame:
    """Q5 ``set`` semantics: last value per (name, labels) by timestamp (by
    ``tie`` among equal ones).  Labels are compared as a sorted key string (maps are not groupable)."""
    key = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels"))))
    return (events.withColumn("_k", key).groupBy("name", "_k")
            .agg(F.max_by("value", F.struct("ts", tie)).alias("value"),
                 F.first("labels").alias("labels"), F.max("ts").alias("ts"))
            .drop("_k"))


def increment_totals(events: DataFrame) -> DataFrame:
    """Q5 ``increment`` semantics: running add per metric name."""
    return events.groupBy("name").agg(F.sum("value").alias("value"))


def check_alerts(metrics: DataFrame, rules: list[tuple[str, float, str]] | None = None,
                 min_quality: float | None = None) -> DataFrame:
    """Q3: metric rows JOIN rule table; a breach is strictly greater, or, for
    ``min_quality``, a data quality strictly below it.  The rule table is a
    literal of a few rows, so broadcasting it is bounded."""
    spark = metrics.sparkSession
    rows = [(*r, True) for r in (rules or ALERT_RULES)]
    if min_quality is not None:
        rows.append(("data_quality_pct", min_quality, "WARNING", False))
    r = spark.createDataFrame(rows, "name string, threshold double, severity string, above boolean")
    j = metrics.join(F.broadcast(r), "name")
    return j.filter(F.when(F.col("above"), F.col("value") > F.col("threshold")).otherwise(
        F.col("value") < F.col("threshold"))).select(
        "severity", F.col("name").alias("metric"), "value", "threshold", "labels")


# Colour bands of the dashboard's panels (start of band, colour).
PANELS = {
    "pipeline_status": [(0.0, "red"), (1000.0, "yellow"), (10000.0, "green")],
    "peak_demand_mw": [(0.0, "green"), (2000.0, "yellow"), (2500.0, "red")],
    "system_loss_pct": [(0.0, "green"), (18.0, "yellow"), (22.0, "red")],
    "data_quality_pct": [(0.0, "red"), (90.0, "yellow"), (95.0, "green")],
    "pipeline_duration_minutes": [(0.0, "green"), (60.0, "yellow"), (120.0, "red")],
}


def panel_colours(metrics: DataFrame) -> DataFrame:
    """Q6: the panel colour of every metric that has a panel."""
    colour = F.lit(None).cast("string")
    for name, bands in PANELS.items():
        colour = F.when(F.col("name") == name, panel_band(F.col("value"), bands, bands[0][1])).otherwise(colour)
    return metrics.filter(F.col("name").isin(list(PANELS))).withColumn("colour", colour)


def panel_band(value: Column, bands: list[tuple[float, str]], base: str = "green") -> Column:
    """Q6: colour band = colour of the highest band start <= value."""
    out = F.lit(base)
    for start, colour in sorted(bands):
        out = F.when(value >= start, colour).otherwise(out)
    return out
