"""Structured Streaming re-aims of the meter ingest.

The reference ingests meter files as a daily batch; these run the same
operators incrementally over a file source with ``trigger(availableNow=True)``
so a scheduler can start them like a batch job.  A job has one folder, given by
the caller (the queries take one under the session's shared checkpoint folder):
its table and its checkpoint stay there from trigger to trigger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import instant_as_ntz, ntz_as_instant
from ..operators.loads import append_new_only
from ..sources.raw import path_exists
from ..sources.tables import meter_readings

KEYS = ["meter_id", "timestamp"]


def _event_time(df: DataFrame) -> DataFrame:
    # watermarks need TIMESTAMP (an instant); file timestamps are zone-less UTC
    return df.withColumn("event_time", ntz_as_instant("timestamp"))


def run_dir(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/meterlens-stream/{name}-{uuid.uuid4().hex[:12]}"


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """File stream over ``folder``; only files matching ``pattern`` are read,
    new files are picked up on later triggers."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def ingest_deduplicated(spark: SparkSession, folder: str, job_dir: str,
                        pattern: str = "events*.parquet") -> DataFrame:
    """File stream -> meter view -> rows of new keys appended to the table.

    Each micro-batch goes through ``append_new_only`` against the stored table:
    the first row per (meter, timestamp) stays, later ones are skipped, and a
    late row is kept like any other, however old.  The table is partitioned by
    day, and a batch is compared with its own range of days only.  A batch that
    runs again after a failure finds its rows stored and adds none twice.
    Returns the batch view of the table.
    """
    target = f"{job_dir}/data"
    day = F.to_date("timestamp")

    def append(batch: DataFrame, _epoch: int) -> None:
        rows = batch.withColumn("day", day)
        low, high, n = rows.agg(F.min("day"), F.max("day"), F.count(F.lit(1))).first()
        if not n:
            return
        if path_exists(batch.sparkSession, target):
            stored = batch.sparkSession.read.schema(rows.schema).parquet(target)
            stored = stored.filter(F.col("day").isNull() | F.col("day").between(low, high))
        else:
            stored = rows.limit(0)
        new = append_new_only(stored, rows, KEYS, [F.col("reading_id")])
        new.write.mode("append").partitionBy("day").parquet(target)

    q = (meter_readings(event_stream(spark, folder, pattern)).writeStream.foreachBatch(append)
         .option("checkpointLocation", f"{job_dir}/_ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(target).drop("day")


def hourly_load_stream(spark: SparkSession, folder: str, job_dir: str,
                       pattern: str = "events*.parquet") -> DataFrame:
    """Hourly system load over event time.

    Each micro-batch is aggregated by (hour, type) and its sums and counts are
    appended as one more part of the table (a folder per micro-batch, rewritten
    if the batch runs again); readers add the parts up.  So a trigger writes
    what it has read, not the whole history, late rows count, and no state grows.
    """
    target = f"{job_dir}/data"

    def write(batch: DataFrame, epoch: int) -> None:
        part = batch.groupBy(F.col("timestamp").alias("hour_start"), "consumer_type").agg(
            F.sum("consumption_kwh").alias("kwh"), F.sum("voltage_v").alias("v"), F.count("voltage_v").alias("n_v"),
            F.sum("power_factor").alias("pf"), F.count("power_factor").alias("n_pf"), F.count(F.lit(1)).alias("n"))
        part.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    q = (meter_readings(event_stream(spark, folder, pattern)).writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{job_dir}/_ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    parts = spark.read.option("basePath", target).parquet(target)
    return parts.groupBy("hour_start", "consumer_type").agg(
        F.sum("kwh").alias("total_kwh"), F.try_divide(F.sum("v"), F.sum("n_v")).alias("avg_voltage"),
        F.try_divide(F.sum("pf"), F.sum("n_pf")).alias("avg_pf"), F.sum("n").alias("readings"))


def low_consumption_sessions(meters: DataFrame, gap: str = "2 hours") -> DataFrame:
    """Per-meter sessions of bad readings (kWh == 0 or voltage < 180)
    closed by a gap.  Works on batch and on streaming (with a watermark)
    DataFrames; it approximates the batch outage islands, which close on the
    first good reading instead of on a gap."""
    bad = F.coalesce((F.col("consumption_kwh") == 0) | (F.col("voltage_v") < 180), F.lit(False))
    s = _event_time(meters.filter(bad))
    g = s.groupBy("meter_id", F.session_window("event_time", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("bad_readings"), F.min("timestamp").alias("first_bad"),
        F.max("timestamp").alias("last_bad"))
    return g.select("meter_id", "first_bad", "last_bad", "bad_readings",
                    instant_as_ntz("s.end").alias("session_end"))
