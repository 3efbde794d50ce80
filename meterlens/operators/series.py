"""National consumption series: cleaning, growth, trends, revenue, forecasts.

Series tables are aggregates (one row per fiscal year or per month), so their
size is bounded by the calendar, not by the raw data.  Windows over them
order by period; when several series are analysed at once they are
partitioned by the ``series`` key, so millions of series run in parallel.

Fixed values that must equal the reference:
  * tariffs (NPR/kWh): domestic 8.5, industrial 8.0, commercial 11.5,
    irrigation 4.5, other/institutional 10.5.
  * SQL revenue view rates: domestic 8.5, industrial 8.0, commercial 11.5,
    irrigation 4.5 (no "other").
  * annual loss clip 0-40 %; monthly load factor clip 0-100 %.
  * load factor = GWh * 1000 / (peak MW * 8760) * 100.
  * forecast: log-linear trend, default horizon 5 fiscal years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.exprs import clip, exact, pct_change, row_sum, safe_div, snap

SECTOR_COLS = ["domestic_gwh", "industrial_gwh", "commercial_gwh", "irrigation_gwh", "other_gwh"]
TARIFF = {"domestic_gwh": 8.5, "industrial_gwh": 8.0, "commercial_gwh": 11.5,
          "irrigation_gwh": 4.5, "other_gwh": 10.5}
SQL_RATES = {"domestic_gwh": 8.5, "industrial_gwh": 8.0, "commercial_gwh": 11.5,
             "irrigation_gwh": 4.5}
ANNUAL_GWH_COLS = ["total_energy_gwh", "domestic_gwh", "industrial_gwh", "commercial_gwh",
                   "irrigation_gwh", "other_gwh", "energy_imported_gwh", "energy_exported_gwh"]


def _ffilled_pct_change(c: str, w: Window) -> Column:
    """pandas ``pct_change`` (forward-fills missing values first) * 100."""
    filled = F.last(F.col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return pct_change(filled, F.lag(filled).over(w))


# ---------------------------------------------------------------- F1
def clean_annual(df: DataFrame) -> DataFrame:
    repl = {c: clip(c, 0.0, None) for c in ANNUAL_GWH_COLS if c in df.columns}
    repl["fiscal_year"] = F.trim("fiscal_year")
    repl["system_loss_pct"] = clip("system_loss_pct", 0.0, 40.0)
    df = df.withColumns(repl)
    net = F.col("total_energy_gwh") + F.col("energy_imported_gwh") - F.col("energy_exported_gwh")
    df = df.withColumn("net_energy_gwh", snap(net, 2))
    return df.withColumns({
        "self_sufficiency_ratio": snap(safe_div(F.col("total_energy_gwh"), F.col("net_energy_gwh")), 4),
        "load_factor_pct": snap(safe_div(F.col("total_energy_gwh") * 1000,
                                         F.col("peak_demand_mw") * 8760) * 100, 2),
    })


# ---------------------------------------------------------------- A9 / W2
# Output columns of the annual summary, in order.
ANNUAL_SUMMARY_COLS = [
    "fiscal_year", "total_energy_gwh", "domestic_gwh", "industrial_gwh", "commercial_gwh",
    "irrigation_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh", "system_loss_pct",
    "installed_capacity_mw", "energy_imported_gwh", "energy_exported_gwh", "net_energy_gwh",
    "self_sufficiency_ratio", "load_factor_pct"]
YOY_COLS = ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh"]


def annual_summary(clean: DataFrame, series: str | None = None) -> DataFrame:
    w = Window.orderBy("fiscal_year") if series is None else \
        Window.partitionBy(series).orderBy("fiscal_year")
    keep = ([series] if series else []) + [c for c in ANNUAL_SUMMARY_COLS if c in clean.columns]
    out = clean.select(*keep)
    out = out.select("*", *[exact(_ffilled_pct_change(c, w)).alias(f"{c}_yoy_pct") for c in YOY_COLS])
    return out.withColumn("trade_balance_gwh",
                          exact(F.col("energy_exported_gwh") - F.col("energy_imported_gwh")))


def annual_yoy_sql(annual: DataFrame) -> DataFrame:
    """The SQL form (LAG over fiscal year, half-up rounding)."""
    w = Window.orderBy("fiscal_year")
    def yoy(c):
        prev = F.lag(c).over(w)
        return snap(safe_div(F.col(c) - prev, prev) * 100, 2, "half_up")
    return annual.select("fiscal_year", "total_energy_gwh", "peak_demand_mw", "per_capita_kwh",
                         "system_loss_pct", "total_consumers",
                         yoy("total_energy_gwh").alias("yoy_growth_pct"),
                         yoy("peak_demand_mw").alias("peak_yoy_pct"))


# ---------------------------------------------------------------- F2 / W1 / C3
def clean_monthly(df: DataFrame) -> DataFrame:
    comp = row_sum(SECTOR_COLS)
    df = df.withColumns({
        "total_gwh": F.coalesce(F.col("total_gwh"), comp),
        "load_factor_pct": clip("load_factor_pct", 0.0, 100.0),
        "season": cal.season_of_month("month"),
        "month_name": F.initcap(F.trim("month_name")),
    })
    w = Window.orderBy("year", "month")
    first_month = F.min("month").over(Window.partitionBy("year"))
    growth = _ffilled_pct_change("total_gwh", w)
    return df.withColumn("growth_rate_pct",
                         F.when(F.col("month") == first_month, F.lit(None))
                         .otherwise(exact(growth)))


# ---------------------------------------------------------------- C1
def calculate_revenue(monthly: DataFrame, tariff: dict | None = None) -> DataFrame:
    tariff = TARIFF if tariff is None else tariff
    rev = {c.replace("_gwh", "_revenue_npr"): F.col(c) * 1e6 * F.lit(r) for c, r in tariff.items()}
    # NPR amounts are large (1e8-1e10): normalise to 2 decimals, not 10
    df = monthly.withColumns({k: snap(v, 2) for k, v in rev.items()})
    total = row_sum(list(rev))
    return df.withColumns({"total_revenue_npr": snap(total, 2),
                           "total_revenue_nrs_mn": snap(total / 1e6, 2)})


# ---------------------------------------------------------------- W6
def monthly_trends(clean: DataFrame) -> DataFrame:
    annual_avg = F.avg("total_gwh").over(Window.partitionBy("year"))
    w = Window.orderBy("year", "month").rowsBetween(-2, 0)
    return clean.withColumns({
        "seasonal_index": snap(F.col("total_gwh") / annual_avg, 4),
        "total_gwh_3m_avg": snap(F.avg("total_gwh").over(w), 2),
        "fiscal_year": cal.fiscal_year("date"),
        "fiscal_quarter": cal.fiscal_quarter("date"),
    })


# ---------------------------------------------------------------- K7
def monthly_revenue_view(trends_with_revenue: DataFrame) -> DataFrame:
    """Monthly listing / revenue view ordered by (year, month)."""
    return trends_with_revenue.select(
        "year", "month", "month_name", "fiscal_year", "season", "total_gwh", "peak_demand_mw",
        F.col("total_revenue_nrs_mn").alias("revenue_npr_mn"), "growth_rate_pct", "seasonal_index",
    ).orderBy("year", "month")


# ---------------------------------------------------------------- A11
def revenue_by_sector(monthly_rev: DataFrame) -> DataFrame:
    rev_cols = [c for c in ["domestic_revenue_npr", "industrial_revenue_npr",
                            "commercial_revenue_npr", "irrigation_revenue_npr",
                            "other_revenue_npr"] if c in monthly_rev.columns]
    g = monthly_rev.groupBy("year").agg(*[F.sum(c).alias(c) for c in rev_cols])
    total = row_sum(rev_cols)
    g = g.select("year", *[snap(c, 2).alias(c) for c in rev_cols], total.alias("_t"))
    return g.select("year", *rev_cols, snap("_t", 2).alias("total_revenue_npr"),
                    *[snap(F.col(c) / F.col("_t") * 100, 2).alias(f"{c}_pct") for c in rev_cols],
                    snap(F.col("_t") / 1e9, 3).alias("total_revenue_nrs_bn"))


# ---------------------------------------------------------------- F14 / F12 / F16
def sector_breakdown(annual: DataFrame, sectors: list[str] | None = None) -> DataFrame:
    """Python form: share of the sum of the present sector columns (half-even)."""
    sectors = [c for c in (sectors or SECTOR_COLS) if c in annual.columns]
    tot = row_sum(sectors)
    return annual.select("fiscal_year", *sectors,
                         *[snap(F.col(c) / tot * 100, 2).alias(c.replace("_gwh", "_share_pct"))
                           for c in sectors])


def sector_share_sql(annual: DataFrame) -> DataFrame:
    """SQL form: share of the recorded total, plus the revenue-rate view."""
    tot = F.col("total_energy_gwh")
    cols = [snap(safe_div(F.col(c), tot) * 100, 2, "half_up").alias(c.replace("_gwh", "_pct"))
            for c in SECTOR_COLS]
    rev = [snap(F.col(c) * r, 2, "half_up").alias(c.replace("_gwh", "_gwh_x_rate"))
           for c, r in SQL_RATES.items()]
    total_rev = snap(row_sum([F.col(c) * r for c, r in SQL_RATES.items()]), 2, "half_up")
    return annual.select("fiscal_year", *cols, *rev,
                         total_rev.alias("total_est_revenue_gwh_x_rate"))


# ---------------------------------------------------------------- F13 / F15
def trade_balance(annual: DataFrame) -> DataFrame:
    imp = F.coalesce(F.col("energy_imported_gwh"), F.lit(0.0)) \
        if "energy_imported_gwh" in annual.columns else F.lit(0.0)
    exp = F.coalesce(F.col("energy_exported_gwh"), F.lit(0.0)) \
        if "energy_exported_gwh" in annual.columns else F.lit(0.0)
    bal = exp - imp
    return annual.select(
        "fiscal_year", "energy_imported_gwh", "energy_exported_gwh",
        exact(bal).alias("trade_balance_gwh"),
        F.when(bal > 0, "Net Exporter").otherwise("Net Importer").alias("trade_status"),
        snap(safe_div(imp, F.col("total_energy_gwh")) * 100, 2).alias("import_dependency_pct"))


def trade_balance_sql(annual: DataFrame) -> DataFrame:
    """the SQL form -- no NULL filling, half-up rounding."""
    imp, exp = F.col("energy_imported_gwh"), F.col("energy_exported_gwh")
    return annual.select(
        "fiscal_year", "energy_imported_gwh", "energy_exported_gwh",
        exact(exp - imp).alias("trade_balance_gwh"),
        F.when(exp > imp, "Net Exporter").otherwise("Net Importer").alias("trade_status"),
        snap(safe_div(imp, F.col("total_energy_gwh")) * 100, 2, "half_up").alias("import_dependency_pct"))


# ---------------------------------------------------------------- A13 / A14 / K4
def _cagr(end: Column, start: Column, years: Column) -> Column:
    ratio = safe_div(end, start)
    return (F.pow(ratio, safe_div(F.lit(1.0), years)) - 1) * 100


def national_growth(annual: DataFrame, series: str | None = None) -> DataFrame:
    """One row per series: CAGR, latest values, YoY, loss reduction, 9-year summary."""
    part = [series] if series else []
    w = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy("fiscal_year")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = ["total_energy_gwh", "per_capita_kwh", "system_loss_pct", "peak_demand_mw",
            "total_consumers", "installed_capacity_mw"]
    x = annual.select(
        *part, "fiscal_year", *cols,
        *[F.first(c).over(full).alias(f"first_{c}") for c in cols],
        F.first("fiscal_year").over(full).alias("first_fiscal_year"),
        F.lag("total_energy_gwh").over(w).alias("prev_total"),
        F.count(F.lit(1)).over(full).alias("n_years"),
        F.row_number().over(w.orderBy(F.col("fiscal_year").desc())).alias("_rn_desc"),
    ).filter(F.col("_rn_desc") == 1)
    yrs = F.col("n_years") - 1
    tot0, tot1 = F.col("first_total_energy_gwh"), F.col("total_energy_gwh")
    pc0, pc1 = F.col("first_per_capita_kwh"), F.col("per_capita_kwh")
    guarded = lambda e, s: F.when(s > 0, snap(_cagr(e, s, yrs), 2)).otherwise(F.lit(0.0))
    return x.select(
        *part,
        F.concat_ws(" – ", "first_fiscal_year", "fiscal_year").alias("period"),
        snap(_cagr(tot1, tot0, yrs), 2).alias("consumption_cagr_pct"),
        snap(_cagr(pc1, pc0, yrs), 2).alias("per_capita_cagr_pct"),
        guarded(tot1, tot0).alias("consumption_cagr_guarded_pct"),
        guarded(pc1, pc0).alias("per_capita_cagr_guarded_pct"),
        F.col("first_system_loss_pct").alias("system_loss_start_pct"),
        F.col("fiscal_year").alias("latest_fiscal_year"),
        F.col("total_energy_gwh").alias("latest_total_gwh"),
        snap((safe_div(tot1, F.col("prev_total")) - 1) * 100, 2).alias("yoy_growth_pct"),
        F.col("per_capita_kwh").alias("latest_per_capita_kwh"),
        F.col("peak_demand_mw").alias("latest_peak_mw"),
        F.col("total_consumers").alias("latest_consumers"),
        F.col("system_loss_pct").alias("latest_system_loss_pct"),
        snap(F.col("first_system_loss_pct") - F.col("system_loss_pct"), 2)
        .alias("total_loss_reduction_pp"),
        F.col("first_total_energy_gwh").alias("total_gwh_start"),
        F.col("first_per_capita_kwh").alias("per_capita_start_kwh"),
        F.col("first_peak_demand_mw").alias("peak_demand_start_mw"),
        F.col("first_total_consumers").alias("consumers_start"),
        F.col("first_installed_capacity_mw").alias("capacity_start_mw"),
        F.col("installed_capacity_mw").alias("capacity_end_mw"),
        snap(F.col("installed_capacity_mw") - F.col("first_installed_capacity_mw"), 1)
        .alias("capacity_added_mw"),
        "n_years",
    )


def latest_kpi(annual: DataFrame) -> DataFrame:
    """K4: latest fiscal year's row (ORDER BY fiscal_year DESC LIMIT 1)."""
    return annual.orderBy(F.col("fiscal_year").desc()).limit(1)


# ---------------------------------------------------------------- G1
def forecast_demand(series_df: DataFrame, value: str = "total_energy_gwh",
                    series: str = "series", horizon: int = 5) -> DataFrame:
    """Log-linear trend per series: ln y = a + b t, t = 0..n-1 by fiscal year.

    Grouped regression (``regr_slope``/``regr_intercept``), then ``horizon``
    rows per series via ``explode(sequence)``; no driver loop.
    """
    w = Window.partitionBy(series).orderBy("fiscal_year")
    t = series_df.select(series, "fiscal_year", F.ln(value).alias("_ly"),
                         (F.row_number().over(w) - 1).cast("double").alias("_t"))
    fit = t.groupBy(series).agg(
        F.regr_slope("_ly", "_t").alias("_b"), F.regr_intercept("_ly", "_t").alias("_a"),
        F.max("_t").alias("_tlast"), F.max("fiscal_year").alias("_fy"))
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_i"))
    year = F.substring("_fy", 1, 4).cast("int") + F.col("_i")
    return steps.select(
        series,
        F.concat(year.cast("string"), F.lit("/"),
                 F.lpad(((year + 1) % 100).cast("string"), 2, "0")).alias("fiscal_year"),
        snap(F.exp(F.col("_a") + F.col("_b") * (F.col("_tlast") + F.col("_i"))), 1)
        .alias("forecast_gwh"),
        snap((F.exp("_b") - 1) * 100, 2).alias("growth_assumption_pct"),
        F.lit("Log-linear trend").alias("method"))


# ---------------------------------------------------------------- A12 / A23 / A24
def seasonality(monthly: DataFrame) -> DataFrame:
    """Month means -> peak/trough month, ratio, monsoon share, in two aggregations."""
    by_month = monthly.groupBy("month").agg(F.avg("total_gwh").alias("_avg"),
                                            F.sum("total_gwh").alias("_sum"))
    a = by_month.agg(
        F.min_by("month", F.struct(-F.col("_avg"), F.col("month"))).alias("_pk"),
        F.min_by("month", F.struct(F.col("_avg"), F.col("month"))).alias("_tr"),
        F.max("_avg").alias("_mx"), F.min("_avg").alias("_mn"),
        (F.sum(F.when(F.col("month").between(6, 9), F.col("_sum")).otherwise(0.0))
         / F.sum("_sum") * 100).alias("_share"))
    mname = lambda m: F.date_format(F.make_date(F.lit(2000), m, F.lit(1)), "MMM")
    return a.select(
        mname(F.col("_pk")).alias("peak_month"), snap("_mx", 2).alias("peak_avg_gwh"),
        mname(F.col("_tr")).alias("trough_month"), snap("_mn", 2).alias("trough_avg_gwh"),
        snap(F.col("_mx") / F.col("_mn"), 3).alias("seasonal_ratio"),
        snap("_share", 2).alias("monsoon_share_pct"))


def monthly_profile_sql(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("month").agg(
        F.max("month_name").alias("month_name"),
        snap(F.avg("total_gwh"), 3, "half_up").alias("avg_gwh"),
        snap(F.max("total_gwh"), 3, "half_up").alias("max_gwh"),
        snap(F.min("total_gwh"), 3, "half_up").alias("min_gwh"),
        snap(F.avg("peak_demand_mw"), 2, "half_up").alias("avg_peak_mw"),
        snap(F.avg("load_factor_pct"), 2, "half_up").alias("avg_load_factor_pct"))


def monsoon_vs_dry_sql(monthly: DataFrame) -> DataFrame:
    period = F.when(F.col("month").between(6, 9), "Monsoon (Jun-Sep)").otherwise("Dry Season")
    return monthly.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("months_count"),
        snap(F.avg("total_gwh"), 3, "half_up").alias("avg_monthly_gwh"),
        snap(F.sum("total_gwh"), 3, "half_up").alias("total_gwh"),
        snap(F.avg("peak_demand_mw"), 2, "half_up").alias("avg_peak_mw"))


# ---------------------------------------------------------------- A16
def seasonal_profile(monthly: DataFrame) -> DataFrame:
    """By season in fixed order; seasons without rows stay as NULL rows."""
    spark = monthly.sparkSession
    dim = spark.createDataFrame([(i, s) for i, s in enumerate(cal.SEASONS)],
                                "season_order int, season string")
    m = monthly if "season" in monthly.columns else \
        monthly.withColumn("season", cal.season_of_month("month"))
    g = m.groupBy("season").agg(
        snap(F.avg("total_gwh"), 3).alias("avg_gwh"), snap(F.max("total_gwh"), 3).alias("max_gwh"),
        snap(F.min("total_gwh"), 3).alias("min_gwh"),
        F.count("total_gwh").alias("months_count"))
    # the season dimension is a 4-row literal: broadcasting it is bounded
    return F.broadcast(dim).join(g, "season", "left").select(
        "season_order", "season", "avg_gwh", "max_gwh", "min_gwh", "months_count")
