"""Derive a replicated events table for scale runs (not committed data).

Copies the given ``events`` table ``copies`` times with Spark: each copy gets
new event ids and is shifted by 30 days; in the first third of the copies
every row is re-keyed to one meter (user_id 0), so one meter holds about a
third of all rows.  Usage: python tools/scale_events.py SRC_DIR OUT_DIR [copies]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from meterlens.session import local_session  # noqa: E402


def main() -> None:
    src, out = sys.argv[1], sys.argv[2]
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 100
    spark = local_session(8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    hot = copies // 3
    x = ev.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    x = x.select(
        (F.col("event_id") + F.col("_c") * 10_000_000).alias("event_id"),
        F.timestamp_add("DAY", (F.col("_c") * 30).cast("int"), F.col("ts")).alias("ts"),
        F.when(F.col("_c") < hot, F.lit(0)).otherwise(F.col("user_id") + F.col("_c") * 100_000)
        .alias("user_id"),
        "event_type", "value", "props")
    x.repartition(32).write.mode("overwrite").parquet(f"{out}/events.parquet")
    print(spark.read.parquet(f"{out}/events.parquet").count())


if __name__ == "__main__":
    main()
