"""Sinks: versioned Parquet tables, table loads, CSV exports.

Parquet has no in-place update, so each merge result is written to a new
``version=`` folder of the table, and a one-row pointer written after it names
the version that readers take.  A job never overwrites the folder it reads, and
a version that was not finished is never read.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERNAL_COLS = ["extracted_at", "cleaned_at", "aggregated_at"]


def write_version(df: DataFrame, table_dir: str, version: int | None = None) -> int:
    """Write a version (again, if a try of the same number failed), then its pointer."""
    v = int(version if version is not None else time.time() * 1000)
    df.write.mode("overwrite").parquet(f"{table_dir}/version={v}")
    spark = df.sparkSession
    spark.range(1).select(F.lit(v).cast("long").alias("version")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{table_dir}/_pointers/{v}")
    return v


def read_current(spark: SparkSession, table_dir: str) -> DataFrame:
    """The newest finished version; the pointers are tiny, the versions unread."""
    latest = spark.read.parquet(f"{table_dir}/_pointers/*").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{table_dir}/version={latest}")


def prepare_for_load(df: DataFrame) -> DataFrame:
    """Drop internal timestamps and turn NaN into NULL."""
    df = df.drop(*[c for c in INTERNAL_COLS if c in df.columns])
    fixes = {f.name: F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name))
             for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fixes) if fixes else df


def load_dataframe(df: DataFrame, path: str, if_exists: str = "append",
                   partition_by: list[str] | None = None) -> int:
    """Write ``df`` (append / replace / fail) and return the row count, measured
    by an ``Observation`` during the write (no second pass).  An empty input is
    skipped: nothing is written or replaced."""
    mode = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}[if_exists]
    if df.isEmpty():
        return 0
    obs = Observation("load")
    out = prepare_for_load(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV export; ``single_file`` only for small report results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
