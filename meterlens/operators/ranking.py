"""Distributed global ordering without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
``global_rank`` instead range-partitions the rows on the sort key, numbers the
rows inside each sorted partition, and adds per-partition offsets.  The offset
table has one row per range partition (its size is the partition count the
caller chooses), so broadcasting it is bounded.

Range bounds come from sampling, so two executions of the same range exchange
may cut the data differently.  The sorted, range-partitioned rows are
therefore checkpointed once (reliable checkpoint in the session's
``spark.checkpoint.dir``) and both the partition counts and the row numbers
are read from that stored copy.  The order must be total (append a unique
tie-breaker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sequence import null_safe_join

_PID, _MID, _OFF, _CNT, _TOT = "_rk_pid", "_rk_mid", "_rk_off", "_rk_cnt", "_rk_tot"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order``.

    When ``total_col`` is given, the total row count is added as well (no
    second scan and no single-row cross join: it rides on the offset table).
    """
    n = _num_partitions(df, num_partitions)
    stored = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    counts = (stored.select(F.spark_partition_id().alias(_PID))
              .groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT)))
    ranged = (stored.withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    w = Window.orderBy(_PID)  # one row per range partition: bounded by n
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_CNT).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias(_OFF),
        F.sum(_CNT).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias(_TOT),
    )
    within = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out = ranged.join(F.broadcast(offsets), _PID).withColumn(
        rank_col, (F.col(_OFF) + within + 1).cast("long"))
    if total_col:
        out = out.withColumn(total_col, F.col(_TOT).cast("long"))
    return out.drop(_PID, _MID, _OFF, _TOT)


def rank_within_groups(df: DataFrame, group: list[str], order: list[Column],
                       rank_col: str = "rank", size_col: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` per group that stays balanced when one group is huge.

    Rows are globally ranked on (group, order); a group's first global rank
    comes from a partial aggregation (one row per group), so a hot group is
    spread over many range partitions instead of one window task.
    """
    keyed = global_rank(df, [F.col(g) for g in group] + order, "_rk_g",
                        num_partitions=num_partitions)
    starts = keyed.groupBy(*group).agg(F.min("_rk_g").alias("_rk_first"),
                                       F.count(F.lit(1)).alias("_rk_size"))
    out = null_safe_join(keyed, starts, group).withColumn(
        rank_col, F.col("_rk_g") - F.col("_rk_first") + 1)
    if size_col:
        out = out.withColumn(size_col, F.col("_rk_size"))
    return out.drop("_rk_g", "_rk_first", "_rk_size")
