"""Session helpers: a local session for tests/bench and checkpoint-dir lookup.

Library code never creates a session; it receives one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "meterlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("METERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, the folder that a cluster's
    executors share.  A local master that names none (tests) gets one scratch
    folder a session; any other session must name it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not hasattr(sc, "_meterlens_checkpoints"):
            sc._meterlens_checkpoints = tempfile.mkdtemp(prefix="meterlens-ckpt-")
        d = sc._meterlens_checkpoints
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder (never a local
    checkpoint)."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


ensure_test_checkpoint_dir = checkpoint_folder  # name used by tests and tools
