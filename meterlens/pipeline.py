"""The batch pipeline as one lazy graph of named DataFrames.

``build`` declares every stage output of the reference's ETL run
(extract -> clean -> transform -> aggregate -> dashboard export -> checks)
over the driver's tables; nothing runs until ``run`` writes the outputs.
The cleaned meter table feeds five outputs, so it is persisted
(MEMORY_AND_DISK, recomputed from lineage if an executor is lost); so are
the annual, monthly and province aggregates, whose size is bounded by the
calendar and by geography.  Everything else stays lazy.  Independent outputs are submitted as
concurrent Spark jobs.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import calendar as cal
from .operators import meters as M
from .operators import quality as Q
from .operators import regions as R
from .operators import series as S
from .operators import summary as U
from .operators import weather as W
from .sources.tables import (EVENT_TYPE_BOUNDS, meter_readings, national_annual, national_monthly,
                             population_facts, province_facts, read_table, weather_observations)

STATION = "ST-N"


def build(spark: SparkSession, sf_dir: str) -> tuple[dict, list[DataFrame]]:
    """Named outputs (DataFrames, or functions that build them) and the persisted
    intermediates."""
    t = lambda n: read_table(spark, sf_dir, n)
    raw = meter_readings(t("events"))
    clean = M.clean_meters(raw, bounds=EVENT_TYPE_BOUNDS).persist(StorageLevel.MEMORY_AND_DISK)
    keep = StorageLevel.MEMORY_AND_DISK
    annual = S.clean_annual(national_annual(t("orders"))).persist(keep)
    monthly = S.clean_monthly(national_monthly(t("orders"))).persist(keep)
    weather = W.enrich_weather(weather_observations(t("lineitem")))
    prov = R.clean_provinces(province_facts(t("nation"), t("customer"), t("supplier"),
                                            t("lineitem"))).persist(keep)
    monthly_rev = S.calculate_revenue(monthly).withColumns(
        {"fiscal_year": cal.fiscal_year("date"), "fiscal_quarter": cal.fiscal_quarter("date")})
    summary = S.annual_summary(annual)
    losses = R.system_losses_by_province(prov)
    out = {
        # extract
        "meter_registry": M.meter_registry(raw),
        # the larger plans are built inside the worker pool
        "outage_events": lambda: M.outage_islands(raw),
        "demand_peaks": M.demand_peaks(raw, 100),
        # clean
        "annual_cleaned": annual,
        "monthly_cleaned": monthly,
        "smart_meter_cleaned": clean,
        "weather_cleaned": weather,
        "province_cleaned": prov,
        # transform
        "annual_transformed": annual.withColumn("date", cal.fiscal_year_start_date("fiscal_year")),
        "monthly_revenue_transformed": monthly_rev,
        "smart_meter_features": lambda: M.engineer_features(clean),
        "weather_consumption_transformed": W.consumption_weather(monthly, weather, STATION),
        "province_enriched_transformed": R.province_enriched(prov, population_facts(t("customer"))),
        "hourly_system_load": M.hourly_system_load(clean),
        # aggregate
        "annual_kpi_summary": summary,
        "monthly_trends": S.monthly_trends(monthly),
        "province_ranking": R.province_ranking(prov),
        "hourly_load_profile": lambda: M.hourly_load_profile(clean),
        "peak_demand_calendar": M.peak_calendar(clean),
        "system_losses_by_province": losses,
        "revenue_by_sector": S.revenue_by_sector(monthly_rev),
        "dashboard_data": U.dashboard_export(summary),
        # validate
        "validation": Q.validation_checks(annual, clean, prov, monthly),
    }
    return out, [clean, annual, monthly, prov]


def run(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
        parallelism: int = 4) -> dict[str, float]:
    """Execute every output once; Parquet under ``out_dir`` or the noop sink."""
    outputs, persisted = build(spark, sf_dir)
    timings: dict[str, float] = {}

    def one(item):
        name, df = item
        t0 = time.perf_counter()
        df = df() if callable(df) else df
        w = df.write.mode("overwrite")
        if out_dir:
            w.parquet(f"{out_dir.rstrip('/')}/{name}")
        else:
            w.format("noop").save()
        return name, time.perf_counter() - t0

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for name, sec in pool.map(one, outputs.items()):
                timings[name] = round(sec, 3)
    finally:
        for df in persisted:
            df.unpersist()
    return timings


def analysis_bundles(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """The four analysis bundles as named lazy DataFrames
    (consumption, peak demand, weather, province)."""
    t = lambda n: read_table(spark, sf_dir, n)
    annual = S.clean_annual(national_annual(t("orders")))
    monthly = S.clean_monthly(national_monthly(t("orders")))
    clean = M.clean_meters(meter_readings(t("events")), bounds=EVENT_TYPE_BOUNDS)
    joined = W.consumption_weather(monthly, W.enrich_weather(weather_observations(t("lineitem"))),
                                   STATION)
    prov = R.clean_provinces(province_facts(t("nation"), t("customer"), t("supplier"), t("lineitem")))
    series = annual.select(F.lit("National").alias("series"), "fiscal_year", "total_energy_gwh")
    return {
        "consumption": {"national_growth": S.national_growth(annual),
                        "sector_breakdown": S.sector_breakdown(annual),
                        "trade_balance": S.trade_balance(annual),
                        "forecast": S.forecast_demand(series),
                        "seasonality": S.seasonality(monthly)},
        "peak_demand": {"daily_load_curve": M.daily_load_curve(clean),
                        "load_factor": M.load_factor_daily(clean),
                        "system_peak_days": M.system_peak_days(clean),
                        "peak_offpeak_ratio": M.peak_offpeak_ratio(clean),
                        "load_duration_curve": M.load_duration_curve(clean)},
        "weather": {"correlations": W.correlations(joined),
                    "monsoon_impact": W.monsoon_impact(joined),
                    "seasonal_profile": S.seasonal_profile(monthly)},
        "province": {"electrification_gap": R.electrification_gap(prov),
                     "inequality": R.gini(prov, "per_capita_kwh_2023", label="province_name"),
                     "system_losses": R.system_losses_analysis(prov),
                     "ranking": R.composite_rank(prov)},
    }
