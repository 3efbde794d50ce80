"""Raw file sources of the metering data model.

Every CSV is read with a declared schema (no inference) in PERMISSIVE mode; a
row that does not fit keeps its text in ``_corrupt_record``.  Paths are asked
for through Spark, so any file system that Spark reads will do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANNUAL_SCHEMA = (
    "fiscal_year string, fiscal_year_bs string, total_energy_gwh double, domestic_gwh double, "
    "industrial_gwh double, commercial_gwh double, irrigation_gwh double, other_gwh double, "
    "peak_demand_mw double, total_consumers int, per_capita_kwh double, system_loss_pct double, "
    "energy_imported_gwh double, energy_exported_gwh double, installed_capacity_mw double")
MONTHLY_SCHEMA = (
    "year int, month int, month_name string, domestic_gwh double, industrial_gwh double, "
    "commercial_gwh double, irrigation_gwh double, other_gwh double, total_gwh double, "
    "peak_demand_mw double, avg_daily_mwh double, load_factor_pct double")
TARIFF_SCHEMA = (
    "consumer_category string, tariff_code string, description string, "
    "energy_charge_nrs_per_unit double, demand_charge_nrs_per_kva double, fixed_charge_nrs double, "
    "rebate_pct double, surcharge_pct double, notes string")
PROVINCE_SCHEMA = (
    "province_id int, province_name string, province_name_np string, headquarter string, "
    "area_sq_km double, population_2021 int, households_2021 int, electrification_pct_2021 double, "
    "electricity_consumers_2023 int, annual_consumption_gwh_2023 double, per_capita_kwh_2023 double, "
    "peak_demand_mw_2023 double, installed_capacity_mw_2023 double, transmission_lines_km double, "
    "distribution_lines_km double, system_loss_pct double, major_projects string")
DISTRICT_SCHEMA = (
    "district_id int, district_name string, province_id int, area_sq_km double, population_2021 int, "
    "households int, electrification_pct double, annual_consumption_mwh double, consumers int, "
    "per_capita_kwh double, urban_pct double")
POPULATION_SCHEMA = (
    "province_id int, province_name string, population_2021 int, area_sq_km double, "
    "population_density double, households int, avg_household_size double, urban_pct double, "
    "literacy_rate_pct double, per_capita_income_usd double, gdp_contribution_pct double, "
    "electrification_pct double, major_industries string")
WEATHER_SCHEMA = (
    "date date, station_id string, station_name string, province_id int, latitude double, "
    "longitude double, altitude_m double, max_temp_c double, min_temp_c double, avg_temp_c double, "
    "humidity_pct double, rainfall_mm double, sunshine_hours double, wind_speed_kmh double, "
    "cloud_cover_pct double, feels_like_c double")
METER_SCHEMA = (
    "timestamp timestamp_ntz, meter_id string, consumer_type string, consumption_kwh double, "
    "voltage_v double, power_factor double, apparent_power_kva double")

CORRUPT = "_corrupt_record"

# dataset name -> (declared schema, source label)
DATASETS = {
    "annual": (ANNUAL_SCHEMA, "annual report"),
    "monthly": (MONTHLY_SCHEMA, "monthly operational report"),
    "tariff": (TARIFF_SCHEMA, "tariff schedule"),
    "province_electricity": (PROVINCE_SCHEMA, "open data portal"),
    "district_electricity": (DISTRICT_SCHEMA, "open data portal"),
    "population": (POPULATION_SCHEMA, "census"),
    "weather": (WEATHER_SCHEMA, "weather backup"),
}


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("encoding", "UTF-8").schema(f"{schema}, {CORRUPT} string").csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything at ``path``, in whatever file system."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def extract(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One named dataset from a header CSV at ``path`` with
    ``extracted_at`` and ``source`` columns."""
    schema, source = DATASETS[name]
    df = read_csv(spark, path, schema)
    if name == "monthly":
        df = df.withColumn("date", F.make_date("year", "month", F.lit(1)))
    return df.withColumns({"extracted_at": F.current_timestamp(), "source": F.lit(source)})


def load_weather(spark: SparkSession, path: str, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Weather backup with an inclusive date range."""
    df = extract(spark, path, "weather")
    if start:
        df = df.filter(F.col("date") >= F.to_date(F.lit(start)))
    if end:
        df = df.filter(F.col("date") <= F.to_date(F.lit(end)))
    return df


def meter_file(spark: SparkSession, path: str, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """S8 on a raw meter CSV folder (the reference's hourly file layout)."""
    df = read_csv(spark, path, METER_SCHEMA)
    if start:
        df = df.filter(F.col("timestamp") >= F.to_timestamp_ntz(F.lit(start)))
    if end:
        df = df.filter(F.col("timestamp") <= F.to_timestamp_ntz(F.lit(end)))
    return df


def extract_bundle(spark: SparkSession, paths: dict[str, str],
                   optional: set[str] = frozenset()) -> dict[str, DataFrame]:
    """The named raw datasets as lazy DataFrames.  A dataset whose path is
    missing is an error, unless it is ``optional``: then it is left out."""
    unknown = sorted(set(paths) - set(DATASETS))
    if unknown:
        raise KeyError(f"unknown datasets: {unknown}")
    there = {name: path_exists(spark, path) for name, path in paths.items()}
    missing = sorted(n for n, found in there.items() if not found and n not in optional)
    if missing:
        raise FileNotFoundError(f"no data at {', '.join(f'{n}: {paths[n]}' for n in missing)}")
    return {name: extract(spark, path, name) for name, path in paths.items() if there[name]}


def stored_or(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """Use a stored Parquet table when it exists, else the recomputed plan."""
    return spark.read.parquet(path) if path_exists(spark, path) else fallback
