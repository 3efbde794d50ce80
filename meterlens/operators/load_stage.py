"""The load stage: upserts, duplicate-skipping append, plain appends, run log.

Tables are folders under one base folder: upserted tables hold versions
(``sources.sinks.write_version``), appended ones Parquet parts.  Every table's
row count is taken while it is written.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.raw import path_exists
from ..sources.sinks import load_dataframe, prepare_for_load, read_current, write_version
from .loads import append_new_only, upsert
from .quality import metric_rows
from .summary import log_pipeline_run

# Keys and updated columns of the upserted tables.
UPSERTS = {
    "annual": (["fiscal_year"], ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh", "system_loss_pct"]),
    "monthly": (["year", "month"], ["total_gwh", "peak_demand_mw", "seasonal_index"]),
}
METER_KEYS = ["meter_id", "timestamp"]
APPENDS = ("province", "weather", "district", "hydro_projects")
BY_PERIOD = ("annual", "monthly", "province", "district")  # bounded by the calendar or by geography
PIPELINE_NAME = "main_etl"


def load_upserted(spark: SparkSession, batch: DataFrame, table_dir: str, keys: list[str], update: list[str],
                  version: int | None = None) -> int:
    """Merge a batch into a versioned table; the number of batch rows."""
    n = batch.count()
    if not n:
        return 0
    rows = prepare_for_load(batch)
    if path_exists(spark, f"{table_dir}/_pointers"):
        stored = read_current(spark, table_dir)
        rows = upsert(stored, rows, keys, [c for c in update if c in rows.columns], [F.col(k) for k in keys]).drop("merge_action")
    else:
        rows = rows.withColumn("loaded_at", F.current_timestamp())
    write_version(rows, table_dir, version)
    return n


def load_meters(spark: SparkSession, batch: DataFrame, table_dir: str) -> int:
    """Append the readings whose (meter, timestamp) is not stored yet; the
    number appended.  Only stored days that occur in the batch are read, and a
    day's new readings are dealt to few files, a large day to several."""
    rows = prepare_for_load(batch).withColumn("day", F.to_date("timestamp"))
    if path_exists(spark, table_dir):
        days = [r.day for r in rows.select("day").distinct().collect()]  # bounded by the calendar
        at = F.col("day").isin([d for d in days if d is not None])
        stored = spark.read.schema(rows.schema).parquet(table_dir).filter(at | F.col("day").isNull() if None in days else at)
    else:
        stored = spark.createDataFrame([], rows.schema)
    seen = Observation("meters")
    new = append_new_only(stored, rows, METER_KEYS, [F.col("reading_id")]).hint("rebalance", "day")
    new.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy("day").parquet(table_dir)
    return int(seen.get["rows"])


def run_load(spark: SparkSession, frames: dict[str, DataFrame], base_dir: str) -> dict[str, int]:
    """Load the given datasets (``annual``, ``monthly``, ``smart_meter`` and those
    of ``APPENDS``); rows per table.  The run is logged as success, or as failed
    with the rows loaded so far, and the error goes on.  Frames of ``BY_PERIOD``
    are counted and written from one computation."""
    frames = {name: df.persist(StorageLevel.MEMORY_AND_DISK) if name in BY_PERIOD else df for name, df in frames.items()}
    try:
        return _logged_load(spark, frames, base_dir)
    finally:
        for name in set(BY_PERIOD) & set(frames):
            frames[name].unpersist()


def _logged_load(spark: SparkSession, frames: dict[str, DataFrame], base_dir: str) -> dict[str, int]:
    start, counts = dt.datetime.now(dt.UTC).replace(tzinfo=None), {}

    def log(status: str, error: str | None = None) -> None:
        end = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        log_pipeline_run(spark, PIPELINE_NAME, start, end, status, sum(counts.values()), error) \
            .write.mode("append").parquet(f"{base_dir}/pipeline_runs")

    try:
        for name, (keys, update) in UPSERTS.items():
            if name in frames:
                counts[name] = load_upserted(spark, frames[name], f"{base_dir}/{name}", keys, update, time.time_ns())
        if "smart_meter" in frames:
            counts["smart_meter"] = load_meters(spark, frames["smart_meter"], f"{base_dir}/smart_meter")
        for name in APPENDS:
            if name in frames:
                counts[name] = load_dataframe(frames[name], f"{base_dir}/{name}", "append")
    except Exception as e:
        log("failed", str(e)[:500])
        raise
    log("success")
    return counts


def load_totals(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One row per loaded table and one for all."""
    rows = [*counts.items(), ("total", sum(counts.values()))]
    return spark.createDataFrame(rows, "table_name string, rows_loaded long")


def stage_metrics(extracted: DataFrame, loaded: DataFrame, annual: DataFrame) -> DataFrame:
    """Q4 as metric records.  ``extracted``: source, rows, seconds; ``loaded``:
    table_name, rows_loaded, errors; ``annual``: peak_demand_mw of the latest year."""
    latest = annual.orderBy(F.col("fiscal_year").desc()).limit(1)
    source, name = {"source": F.col("source")}, {"table": F.col("table_name")}
    parts = [metric_rows(extracted, "extraction_rows", F.col("rows"), source),
             metric_rows(extracted, "extraction_duration", F.col("seconds"), source),
             metric_rows(loaded, "load_rows", F.col("rows_loaded"), name),
             metric_rows(loaded, "load_errors", F.col("errors"), name),
             metric_rows(latest, "peak_demand_mw", F.col("peak_demand_mw"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
