"""Parquet table access and the stand-in views over the driver's test tables.

The engine's operators work on the metering data model (meter readings,
national monthly/annual series, weather observations, provinces).  The driver
tables are generic, so each view below is a plain DataFrame derivation whose
work grows with its input table:

* ``meter_readings(events)``   -- hourly meter readings (one row per event).
* ``national_monthly(orders)``  -- monthly national consumption (orders by month,
  priorities as the five sectors, a pivot).
* ``national_annual(orders)``   -- fiscal-year national KPIs.
* ``weather_observations(lineitem)`` -- one weather observation per line item.
* ``province_facts(...)``       -- nation-level facts from customer, supplier and
  lineitem aggregates.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import fiscal_year, trunc_ntz
from ..functions.exprs import exact, safe_div, snap

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixed mapping of order priorities to the five consumption sectors.
SECTOR_OF_PRIORITY = {
    "1-URGENT": "domestic",
    "2-HIGH": "industrial",
    "3-MEDIUM": "commercial",
    "4-NOT SPECIFIED": "irrigation",
    "5-LOW": "other",
}
SECTORS = ["domestic", "industrial", "commercial", "irrigation", "other"]

# Meter stand-in constants: readings under DEAD_BAND kWh register as 0 (a dead
# meter), voltage = VOLTAGE_BASE + k, power factor = PF_BASE + (k mod 26) / 100.
DEAD_BAND = 5.0
VOLTAGE_BASE = 170.0
PF_BASE = 0.75

# Consumption caps per consumer type used with the event-type stand-in.
EVENT_TYPE_BOUNDS = {"click": (0.0, 15.0), "view": (0.0, 100.0), "purchase": (0.0, 800.0)}


@lru_cache(maxsize=256)
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table.  DataFrames are immutable plans, so
    the analysed scan is reused per (session, folder, table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def meter_readings(events: DataFrame) -> DataFrame:
    """Events as hourly smart-meter readings (timestamp truncated to the hour)."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        trunc_ntz("hour", "ts").alias("timestamp"),
        F.col("user_id").alias("meter_id"),
        F.col("event_type").alias("consumer_type"),
        F.when(F.col("value") < DEAD_BAND, F.lit(0.0)).otherwise(F.col("value"))
        .alias("consumption_kwh"),
        (F.lit(VOLTAGE_BASE) + k).cast("double").alias("voltage_v"),
        (F.lit(PF_BASE) + (k % 26) / F.lit(100.0)).alias("power_factor"),
        F.col("ts").alias("read_at"),
        F.col("event_id").alias("reading_id"),
    )


def _sector_sums(prefix_price: str = "o_totalprice") -> list:
    out = []
    for prio, sector in SECTOR_OF_PRIORITY.items():
        out.append(snap(F.sum(F.when(F.col("o_orderpriority") == prio, F.col(prefix_price))
                              .otherwise(0.0)) / 1e6, 6).alias(f"{sector}_gwh"))
    return out


def national_monthly(orders: DataFrame) -> DataFrame:
    """Monthly national series: one row per (year, month) of ``o_orderdate``."""
    d = F.col("o_orderdate")
    g = (orders.groupBy(F.year(d).alias("year"), F.month(d).alias("month"))
         .agg(*_sector_sums(),
              snap(F.sum("o_totalprice") / 1e6, 6).alias("total_gwh"),
              snap(F.max("o_totalprice") / 1e3, 6).alias("peak_demand_mw"),
              snap(F.avg("o_totalprice") / F.max("o_totalprice") * 100, 6).alias("load_factor_pct")))
    date = F.make_date("year", "month", F.lit(1))
    return g.select(
        "year", "month",
        F.date_format(date, "MMMM").alias("month_name"),
        date.alias("date"),
        *[f"{s}_gwh" for s in SECTORS], "total_gwh", "peak_demand_mw",
        snap(F.col("total_gwh") * 1000 / F.dayofmonth(F.last_day(date)), 6).alias("avg_daily_mwh"),
        "load_factor_pct",
    )


def national_annual(orders: DataFrame) -> DataFrame:
    """Fiscal-year national KPIs from orders (fiscal year of ``o_orderdate``)."""
    price = F.col("o_totalprice")
    status = F.col("o_orderstatus")
    g = (orders.groupBy(fiscal_year("o_orderdate").alias("fiscal_year"))
         .agg(snap(F.sum(price) / 1e6, 6).alias("total_energy_gwh"),
              *_sector_sums(),
              snap(F.max(price) / 1e3, 6).alias("peak_demand_mw"),
              F.count_distinct("o_custkey").cast("int").alias("total_consumers"),
              snap(F.sum(F.when(status == "P", price).otherwise(0.0)) * 100
                   / F.sum(price), 6).alias("system_loss_pct"),
              snap(F.sum(F.when(status == "O", price).otherwise(0.0)) / 1e7, 6)
              .alias("energy_imported_gwh"),
              snap(F.sum(F.when(status == "F", price).otherwise(0.0)) / 1e7, 6)
              .alias("energy_exported_gwh"),
              snap(F.max(price) / 1e3 * 1.5, 6).alias("installed_capacity_mw")))
    return g.select(
        "fiscal_year", "total_energy_gwh", *[f"{s}_gwh" for s in SECTORS],
        "peak_demand_mw", "total_consumers",
        snap(F.col("total_energy_gwh") * 1e6 / F.col("total_consumers"), 6).alias("per_capita_kwh"),
        "system_loss_pct", "energy_imported_gwh", "energy_exported_gwh", "installed_capacity_mw",
    )


def weather_observations(lineitem: DataFrame) -> DataFrame:
    """One observation per line item; station = return flag."""
    t = F.col("l_quantity") - F.lit(12.0)
    return lineitem.select(
        F.to_date("l_shipdate").alias("date"),
        F.concat(F.lit("ST-"), F.col("l_returnflag")).alias("station_id"),
        exact(t + F.col("l_tax") * 100).alias("max_temp_c"),
        exact(t - F.col("l_discount") * 100).alias("min_temp_c"),
        t.alias("avg_temp_c"),
        exact(F.col("l_discount") * 1000).alias("humidity_pct"),
        F.when(F.col("l_linestatus") == "O", exact(F.col("l_extendedprice") / 1000))
        .alias("rainfall_mm"),
    )


def province_facts(nation: DataFrame, customer: DataFrame, supplier: DataFrame,
                   lineitem: DataFrame) -> DataFrame:
    """Nation-level facts standing in for province electricity data."""
    cust = (customer.groupBy(F.col("c_nationkey").alias("province_id"))
            .agg(F.count("*").alias("n_cust"),
                 F.count_if(F.col("c_acctbal") > 0).alias("n_pos")))
    supp = (supplier.groupBy(F.col("s_nationkey").alias("province_id"))
            .agg(F.count("*").alias("n_supp"), F.avg("s_acctbal").alias("avg_bal")))
    # per-supplier sums first (partial aggregation on the big table), then nation
    per_supp = (lineitem.groupBy("l_suppkey")
                .agg(F.sum("l_extendedprice").alias("rev"), F.max("l_extendedprice").alias("mx")))
    cons = (per_supp.join(supplier.select("s_suppkey", "s_nationkey"),
                          per_supp.l_suppkey == supplier.s_suppkey)
            .groupBy(F.col("s_nationkey").alias("province_id"))
            .agg(snap(F.sum("rev") / 1e6, 6).alias("annual_consumption_gwh_2023"),
                 snap(F.max("mx") / 1e3, 6).alias("peak_demand_mw_2023")))
    n = nation.select(F.col("n_nationkey").alias("province_id"),
                      F.col("n_name").alias("province_name"),
                      F.col("n_regionkey").alias("region_id"))
    j = n.join(cust, "province_id", "left").join(supp, "province_id", "left") \
         .join(cons, "province_id", "left")
    return j.select(
        "province_id", "province_name", "region_id",
        (F.lit(1000.0) + F.col("province_id") * 500.0).alias("area_sq_km"),
        (F.coalesce("n_cust", F.lit(0)) * 1000).cast("int").alias("population_2021"),
        (F.coalesce("n_cust", F.lit(0)) * 200).cast("int").alias("households_2021"),
        snap(safe_div(F.col("n_pos") * 100.0, F.col("n_cust")), 6).alias("electrification_pct_2021"),
        (F.coalesce("n_pos", F.lit(0)) * 150).cast("int").alias("electricity_consumers_2023"),
        "annual_consumption_gwh_2023",
        snap(safe_div(F.col("annual_consumption_gwh_2023") * 1e6,
                      F.col("n_cust") * 1000), 6).alias("per_capita_kwh_2023"),
        "peak_demand_mw_2023",
        (F.coalesce("n_supp", F.lit(0)) * 100.0).alias("transmission_lines_km"),
        (F.coalesce("n_cust", F.lit(0)) * 10.0).alias("distribution_lines_km"),
        snap(F.lit(10.0) + F.col("avg_bal") / 400.0, 6).alias("system_loss_pct"),
        F.lit(2023).alias("report_year"),
        (F.coalesce("n_supp", F.lit(0)) * 50.0).alias("installed_capacity_mw_2023"),
    )


def population_facts(customer: DataFrame) -> DataFrame:
    """Per-province population extras (the J2 right side) from customers."""
    return (customer.groupBy(F.col("c_nationkey").alias("province_id"))
            .agg(snap(F.avg("c_acctbal"), 6).alias("per_capita_income_usd"),
                 snap(F.count_if(F.col("c_mktsegment") == "BUILDING") * 100.0 / F.count("*"), 6)
                 .alias("urban_pct"),
                 snap(F.count_if(F.col("c_acctbal") > 1000) * 100.0 / F.count("*"), 6)
                 .alias("literacy_rate_pct")))
