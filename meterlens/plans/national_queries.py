"""Driver queries over ``orders`` (national series), ``lineitem`` (weather)
and nation/customer/supplier (provinces)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.exprs import snap
from ..operators import regions as R
from ..operators import series as S
from ..operators import weather as W
from ..sources.tables import (national_annual, national_monthly, population_facts,
                              province_facts, read_table, weather_observations)

STATION = "ST-N"


@lru_cache(maxsize=64)
def monthly(spark, sf):
    return S.clean_monthly(national_monthly(read_table(spark, sf, "orders")))


@lru_cache(maxsize=64)
def annual(spark, sf):
    return S.clean_annual(national_annual(read_table(spark, sf, "orders")))


@lru_cache(maxsize=64)
def weather(spark, sf):
    return W.enrich_weather(weather_observations(read_table(spark, sf, "lineitem")))


@lru_cache(maxsize=64)
def provinces(spark, sf):
    t = lambda n: read_table(spark, sf, n)
    return R.clean_provinces(province_facts(t("nation"), t("customer"), t("supplier"), t("lineitem")))


@lru_cache(maxsize=64)
def joined(spark, sf):
    return W.consumption_weather(monthly(spark, sf), weather(spark, sf), STATION)


def q_monthly_revenue(spark, sf):
    return S.calculate_revenue(monthly(spark, sf))


def q_monthly_sector_pivot(spark, sf):
    return S.revenue_by_sector(S.calculate_revenue(monthly(spark, sf)))


def q_sector_share(spark, sf):
    return S.sector_share_sql(annual(spark, sf))


def q_sector_breakdown(spark, sf):
    return S.sector_breakdown(annual(spark, sf))


def q_monthly_trends(spark, sf):
    return S.monthly_trends(monthly(spark, sf))


def q_monthly_revenue_view(spark, sf):
    return S.monthly_revenue_view(S.monthly_trends(S.calculate_revenue(monthly(spark, sf))))


def q_annual_kpis(spark, sf):
    return S.annual_summary(annual(spark, sf)).withColumn(
        "fiscal_year_start", cal.fiscal_year_start_date("fiscal_year"))


def q_annual_yoy_sql(spark, sf):
    return S.annual_yoy_sql(annual(spark, sf))


def q_national_growth(spark, sf):
    return S.national_growth(annual(spark, sf))


def q_latest_kpi(spark, sf):
    return S.latest_kpi(annual(spark, sf))


def q_demand_forecast(spark, sf):
    orders = read_table(spark, sf, "orders")
    national = annual(spark, sf).select(F.lit("National").alias("series"), "fiscal_year",
                                        "total_energy_gwh")
    per_prio = (orders.groupBy(F.col("o_orderpriority").alias("series"),
                               cal.fiscal_year("o_orderdate").alias("fiscal_year"))
                .agg((F.sum("o_totalprice") / 1e6).alias("total_energy_gwh")))
    return S.forecast_demand(national.unionByName(per_prio), horizon=5)


def q_seasonality(spark, sf):
    return S.seasonality(monthly(spark, sf))


def q_monthly_profile(spark, sf):
    return S.monthly_profile_sql(monthly(spark, sf))


def q_monsoon_vs_dry(spark, sf):
    return S.monsoon_vs_dry_sql(monthly(spark, sf))


def q_seasonal_profile(spark, sf):
    return S.seasonal_profile(monthly(spark, sf))


def q_consumption_weather(spark, sf):
    return joined(spark, sf)


def q_consumption_weather_sql(spark, sf):
    return W.consumption_weather_sql(monthly(spark, sf), weather(spark, sf), STATION)


def q_degree_days(spark, sf):
    return weather(spark, sf)


def q_correlations(spark, sf):
    return W.correlations(joined(spark, sf))


def q_ols_regression(spark, sf):
    return W.ols_regression(joined(spark, sf))


def q_monsoon_impact(spark, sf):
    return W.monsoon_impact(joined(spark, sf))


def q_trade_balance(spark, sf):
    return S.trade_balance(annual(spark, sf))


def q_trade_balance_sql(spark, sf):
    return S.trade_balance_sql(annual(spark, sf))


def q_province_clean(spark, sf):
    return provinces(spark, sf)


def q_province_enriched(spark, sf):
    return R.province_enriched(provinces(spark, sf), population_facts(read_table(spark, sf, "customer")))


def q_province_ranking(spark, sf):
    return R.province_ranking(provinces(spark, sf))


def province_years(spark, sf):
    """The province facts for two report years; the earlier one with a tenth
    less consumption."""
    now = provinces(spark, sf)
    before = now.withColumns({"report_year": F.lit(2022),
                              "annual_consumption_gwh_2023": snap(F.col("annual_consumption_gwh_2023") * 0.9, 6)})
    return now.unionByName(before)


def province_dimension(spark, sf):
    region = read_table(spark, sf, "region")
    nation = read_table(spark, sf, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name_en"),
        F.col("r_name").alias("headquarter"))


def q_province_performance(spark, sf):
    return R.province_performance_sql(province_years(spark, sf), province_dimension(spark, sf), 2023)


def q_province_performance_view(spark, sf):
    return R.province_performance_view(province_years(spark, sf), province_dimension(spark, sf))


def q_composite_rank(spark, sf):
    return R.composite_rank(provinces(spark, sf))


def q_electrification_gap(spark, sf):
    return R.electrification_gap(provinces(spark, sf))


def q_electrification_gap_sql(spark, sf):
    return R.electrification_gap_sql(province_years(spark, sf), province_dimension(spark, sf))


def q_system_losses(spark, sf):
    return R.system_losses_by_province(provinces(spark, sf))


def q_system_losses_analysis(spark, sf):
    return R.system_losses_analysis(provinces(spark, sf))


def q_loss_opportunity(spark, sf):
    return R.loss_opportunity_sql(province_years(spark, sf), province_dimension(spark, sf))


def q_inequality_gini(spark, sf):
    cust = read_table(spark, sf, "customer")
    per_nation = R.gini(cust.withColumn("nation", F.col("c_nationkey").cast("string")),
                        "c_acctbal", group="nation", label="c_name")
    overall = R.gini(cust, "c_acctbal", label="c_name")
    return per_nation.unionByName(overall)


QUERIES = {
    "monthly_revenue": q_monthly_revenue,
    "monthly_sector_pivot": q_monthly_sector_pivot,
    "sector_share": q_sector_share,
    "sector_breakdown": q_sector_breakdown,
    "monthly_trends": q_monthly_trends,
    "monthly_revenue_view": q_monthly_revenue_view,
    "annual_kpis": q_annual_kpis,
    "annual_yoy_sql": q_annual_yoy_sql,
    "national_growth": q_national_growth,
    "latest_kpi": q_latest_kpi,
    "demand_forecast": q_demand_forecast,
    "seasonality": q_seasonality,
    "monthly_profile": q_monthly_profile,
    "monsoon_vs_dry": q_monsoon_vs_dry,
    "seasonal_profile": q_seasonal_profile,
    "consumption_weather": q_consumption_weather,
    "consumption_weather_sql": q_consumption_weather_sql,
    "degree_days": q_degree_days,
    "correlations": q_correlations,
    "ols_regression": q_ols_regression,
    "monsoon_impact": q_monsoon_impact,
    "trade_balance": q_trade_balance,
    "trade_balance_sql": q_trade_balance_sql,
    "province_clean": q_province_clean,
    "province_enriched": q_province_enriched,
    "province_ranking": q_province_ranking,
    "province_performance": q_province_performance,
    "province_performance_view": q_province_performance_view,
    "composite_rank": q_composite_rank,
    "electrification_gap": q_electrification_gap,
    "electrification_gap_sql": q_electrification_gap_sql,
    "system_losses": q_system_losses,
    "system_losses_analysis": q_system_losses_analysis,
    "loss_opportunity": q_loss_opportunity,
    "inequality_gini": q_inequality_gini,
}
