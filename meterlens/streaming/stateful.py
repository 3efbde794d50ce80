"""Streams with watermarks and state: ingest (T1), hourly load (T2), outages.

A job has one folder.  ``route`` lands each micro-batch in it and splits off the
rows that are older than the watermark (``delay`` behind the latest event time
of all earlier batches) or have no event time: the side table.  The stateful
queries read what is on time from there with the same watermark, so none of
them drops a row that the side table does not hold.  Their state lives in
RocksDB and holds ``delay`` of event time and no more; each step writes by batch
number, so a batch that runs again after a failure replaces its own output.

* T1 keeps the first reading of a (meter, hour): ``dropDuplicatesWithinWatermark``
  for rows on time; rows of the side table are compared with the stored rows of
  their own days only.  Within a micro-batch the smallest reading_id counts as first.
* T2 aggregates tumbling hours in append mode: an hour is written once, when the
  watermark has passed it; late rows add parts to closed hours.  Parts beyond
  ``max_parts`` are combined into one, named by a pointer.
* T3 keeps a meter's open outage and its readings younger than the watermark; a
  timer takes them in event-time order once the watermark has passed them, and
  the first good reading closes the outage.

``close_job`` moves the watermark past everything landed, as at the end of a
period; what arrives for that time afterwards is late.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.calendar import instant_as_ntz, ntz_as_instant
from ..functions.exprs import snap
from ..operators.loads import append_new_only
from ..operators.meters import KWH, METER, RID, TS, TYPE, VOLT, VOLTAGE_MIN
from ..sources.raw import path_exists
from ..sources.sinks import write_version
from ..sources.tables import meter_readings
from .ingest import KEYS, event_stream

DELAY = dt.timedelta(days=2)
MAX_PARTS = 8
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUTAGE = f"{METER} {{meter}}, {TYPE} string, outage_start timestamp, outage_end timestamp"


@dataclass
class Ingested:
    """The table after a trigger, and what its state store held then."""
    table: DataFrame
    state_rows: int
    state_bytes: int


@contextmanager
def _rocksdb(spark: SparkSession):
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def _mark(spark: SparkSession, job: str, before: int | None = None) -> dt.datetime | None:
    """The latest event time of the batches before one (a closing counts always), UTC."""
    if not path_exists(spark, f"{job}/marks"):
        return None
    marks = spark.read.schema("epoch long, mark timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{job}/marks")
    return (marks if before is None else marks.filter(F.col("epoch") < before)).agg(F.max("mark")).first()[0]


def _write_mark(spark: SparkSession, job: str, name: str, epoch: int, mark: dt.datetime | None) -> None:
    spark.createDataFrame([(epoch, mark)], "epoch long, mark timestamp_ntz").coalesce(1) \
        .write.mode("overwrite").parquet(f"{job}/marks/{name}")


def route(spark: SparkSession, folder: str, job: str, delay: dt.timedelta = DELAY, pattern: str = "events*.parquet") -> None:
    """New files of ``folder`` as meter readings in ``landed``, by ``batch`` and
    ``late``; ``repeat`` marks all but the first reading of a key in the batch."""
    def land(batch: DataFrame, epoch: int) -> None:
        mark = _mark(spark, job, epoch)
        late = F.col(TS).isNull() if mark is None else F.col(TS).isNull() | (F.col(TS) <= F.lit(mark - delay))
        seen = Observation()
        first = F.row_number().over(Window.partitionBy(*KEYS).orderBy(RID))
        rows = batch.withColumn("repeat", first > 1).withColumn("late", late).withColumn("closing", F.lit(False))
        rows.observe(seen, F.max(TS).alias("mark")).write.mode("overwrite").partitionBy("late").parquet(f"{job}/landed/batch={epoch}")
        _write_mark(spark, job, str(epoch), epoch, seen.get["mark"])

    stream = meter_readings(event_stream(spark, folder, pattern))
    stream.writeStream.foreachBatch(land).option("checkpointLocation", f"{job}/_ckpt/route") \
        .trigger(availableNow=True).start().awaitTermination()


def close_job(spark: SparkSession, job: str, delay: dt.timedelta = DELAY) -> None:
    """A row that moves the watermark past all that has landed; no query returns it."""
    mark = _mark(spark, job)
    if mark is None:
        return
    past = mark + delay + dt.timedelta(hours=1)
    landed = spark.read.parquet(f"{job}/landed")
    kinds = {f.name: f.dataType for f in landed.schema if f.name not in ("batch", "late")}
    row = {TS: past, "repeat": False, "closing": True}
    line = spark.range(1).select(*[F.lit(row.get(c)).cast(k).alias(c) for c, k in kinds.items()])
    number = -int(past.replace(tzinfo=dt.timezone.utc).timestamp())  # below the numbers of micro-batches
    line.coalesce(1).write.mode("overwrite").parquet(f"{job}/landed/batch={number}/late=false")
    _write_mark(spark, job, f"closed-{past:%Y%m%d%H%M%S}", -1, past)


def _on_time(spark: SparkSession, job: str, delay: dt.timedelta) -> DataFrame:
    """The landed rows on time as a stream with its watermark, closing rows taken out."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").parquet(f"{job}/landed").schema
    rows = (spark.readStream.schema(files).option("recursiveFileLookup", True).parquet(f"{job}/landed/*/late=false")
            .withColumn("event_time", ntz_as_instant(TS)))
    rows = rows.withWatermark("event_time", f"{int(delay.total_seconds() * 1000)} milliseconds")
    # the condition names the event time, so that it stays above the watermark
    return rows.filter(F.when(F.col("closing"), F.lit(False)).otherwise(F.col("event_time").isNotNull()))


def _late(spark: SparkSession, job: str, after: int) -> DataFrame:
    """Rows of the side table of the batches after one."""
    landed = spark.read.option("basePath", f"{job}/landed").parquet(f"{job}/landed")
    return landed.filter(F.col("late").cast("boolean") & (F.col("batch") > after))


def _versions(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, f"{path}/_pointers"):
        return []
    return sorted(r[0] for r in spark.read.parquet(f"{path}/_pointers/*").distinct().collect())  # one a merge


def _last_batch(spark: SparkSession, job: str) -> int:
    marks = spark.read.schema("epoch long").option("recursiveFileLookup", True).parquet(f"{job}/marks")
    return marks.agg(F.max("epoch")).first()[0]


def _run(spark: SparkSession, stream: DataFrame, write, checkpoint: str) -> tuple[int, int]:
    """One trigger of a stateful query; rows and bytes that its state held at the end."""
    with _rocksdb(spark):
        q = (stream.writeStream.outputMode("append").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    states = [s for p in q.recentProgress[-1:] for s in p.stateOperators]
    return sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states)


def ingest(spark: SparkSession, folder: str, job: str, delay: dt.timedelta = DELAY, pattern: str = "events*.parquet") -> Ingested:
    """One trigger.  The table has one row per (meter, hour), late rows included."""
    route(spark, folder, job, delay, pattern)
    keep = [f.name for f in spark.read.option("recursiveFileLookup", True).parquet(f"{job}/landed").schema
            if f.name not in ("repeat", "closing")]
    day = F.to_date(TS)
    table = f"{job}/table"

    def append(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(*keep, day.alias("day"))
        rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{table}/batch={epoch}")

    new = _on_time(spark, job, delay).filter(~F.col("repeat")).dropDuplicatesWithinWatermark(KEYS)
    state = _run(spark, new, append, f"{job}/_ckpt/ingest")

    late_dir = f"{job}/late"
    done, last = _versions(spark, late_dir), _last_batch(spark, job)
    late = _late(spark, job, done[-1] if done else -1).select(*keep, day.alias("day"))
    if not late.isEmpty():
        known = _stored(spark, table, late_dir, done, late.schema)
        days = late.select(F.col("day").alias("_d")).distinct()  # no more than the calendar holds
        known = known.join(F.broadcast(days), F.col("day").eqNullSafe(F.col("_d")), "left_semi")
        write_version(append_new_only(known, late, KEYS, [F.col(RID)]), late_dir, last)
        done = _versions(spark, late_dir)
    return Ingested(_stored(spark, table, late_dir, done, late.schema).drop("day"), *state)


def _stored(spark: SparkSession, table: str, late_dir: str, versions: list[int], schema) -> DataFrame:
    out = spark.createDataFrame([], schema)
    if path_exists(spark, table):
        files = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
        out = spark.read.option("basePath", table).schema(files).parquet(table).select(*out.columns)
    if versions:
        out = out.unionByName(spark.read.schema(out.schema).parquet(*[f"{late_dir}/version={v}" for v in versions]))
    return out


_SUMS = ["kwh", "v", "n_v", "pf", "n_pf", "n"]


def _hour_sums():
    return [F.sum(KWH).alias("kwh"), F.sum(VOLT).alias("v"), F.count(VOLT).alias("n_v"),
            F.sum("power_factor").alias("pf"), F.count("power_factor").alias("n_pf"), F.count(F.lit(1)).alias("n")]


def _add_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("hour_start", TYPE).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _combined(spark: SparkSession, job: str) -> tuple[DataFrame | None, int, int]:
    """The combined part, and the last batch on time and the last late one that it covers."""
    versions = _versions(spark, f"{job}/combined")
    if not versions:
        return None, -1, -1
    rows = spark.read.parquet(f"{job}/combined/version={versions[-1]}")
    return rows.drop("upto", "upto_late"), *rows.select("upto", "upto_late").first()


def hour_parts(spark: SparkSession, job: str) -> DataFrame | None:
    """The parts that readers add up: the combined one and those after it; ``part`` names each."""
    out, upto, upto_late = _combined(spark, job)
    out = None if out is None else out.withColumn("part", F.lit("combined"))
    hours, late = f"{job}/hours", [v for v in _versions(spark, f"{job}/late_hours") if v > upto_late]
    found = []
    if path_exists(spark, hours):
        rows = spark.read.option("basePath", hours).parquet(hours).filter(F.col("batch") > upto)
        found.append(rows.withColumn("part", F.concat(F.lit("hours "), F.col("batch").cast("string"))).drop("batch"))
    found += [spark.read.parquet(f"{job}/late_hours/version={v}").withColumn("part", F.lit(f"late {v}")) for v in late]
    for rows in found:
        out = rows if out is None else out.unionByName(rows)
    return out


def compact_hours(spark: SparkSession, job: str, max_parts: int = MAX_PARTS) -> int:
    """Combine the parts into one where there are more than ``max_parts``; how many are left to read."""
    parts = hour_parts(spark, job)
    n = 0 if parts is None else parts.select("part").distinct().count()
    if n <= max_parts:
        return n
    hours, late = f"{job}/hours", _versions(spark, f"{job}/late_hours")
    upto = spark.read.option("basePath", hours).parquet(hours).agg(F.max("batch")).first()[0] if path_exists(spark, hours) else -1
    rows = _add_up(parts).withColumn("upto", F.lit(-1 if upto is None else upto)).withColumn("upto_late", F.lit(late[-1] if late else -1))
    versions = _versions(spark, f"{job}/combined")
    write_version(rows, f"{job}/combined", versions[-1] + 1 if versions else 0)
    return 1


def hourly_load(spark: SparkSession, folder: str, job: str, delay: dt.timedelta = DELAY, pattern: str = "events*.parquet",
                max_parts: int = MAX_PARTS) -> DataFrame:
    """One trigger.  Closed hours by consumer type, late rows added to them."""
    route(spark, folder, job, delay, pattern)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{job}/hours/batch={epoch}")

    hours = _on_time(spark, job, delay).groupBy(F.window("event_time", "1 hour"), TYPE).agg(*_hour_sums())
    hours = hours.select(instant_as_ntz("window.start").alias("hour_start"), TYPE, *_SUMS)
    _run(spark, hours, write, f"{job}/_ckpt/hours")
    done, last = _versions(spark, f"{job}/late_hours"), _last_batch(spark, job)
    late = _late(spark, job, done[-1] if done else -1)
    if not late.isEmpty():
        write_version(late.groupBy(F.col(TS).alias("hour_start"), TYPE).agg(*_hour_sums()), f"{job}/late_hours", last)
    compact_hours(spark, job, max_parts)
    g = _add_up(hour_parts(spark, job))
    return g.select("hour_start", TYPE, F.col("kwh").alias("total_kwh"), F.try_divide("v", "n_v").alias("avg_voltage"),
                    F.try_divide("pf", "n_pf").alias("avg_pf"), F.col("n").alias("readings"))


class OutageProcessor(StatefulProcessor):
    """Readings of one meter in event-time order; see the module's T3."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "at long, rid long, bad boolean, kind string")
        self.begun = handle.getValueState("begun", "at long")

    def _advance(self, new: list, timers) -> "Iterator":
        import pandas as pd

        mark = timers.getCurrentWatermarkInMs() * 1000
        waiting = sorted([*(tuple(r) for r in self.pending.get()), *new], key=lambda r: (r[0], r[1]))
        ready = [r for r in waiting if r[0] <= mark]
        rest = waiting[len(ready):]
        begun = self.begun.get()
        begun = begun[0] if begun else None
        closed = []
        for at, _, bad, kind in ready:
            if bad:
                begun = at if begun is None else begun
            elif begun is not None:
                closed.append((kind, begun, at))
                begun = None
        self.begun.clear() if begun is None else self.begun.update((begun,))
        self.pending.put(rest) if rest else self.pending.clear()
        if rest:
            self.handle.registerTimer(rest[0][0] // 1000)
        if closed:
            yield pd.DataFrame(closed, columns=[TYPE, "outage_start", "outage_end"])

    def _rows(self, key, new, timers):
        import pandas as pd

        for out in self._advance(new, timers):
            for c in ("outage_start", "outage_end"):
                out[c] = pd.to_datetime(out[c], unit="us", utc=True)
            out.insert(0, METER, key[0])
            yield out

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for part in rows:
            new += list(zip(part["at"].tolist(), part[RID].tolist(), part["bad"].tolist(), part[TYPE].tolist()))
        yield from self._rows(key, new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._rows(key, [], timerValues)

    def close(self) -> None:
        pass


def outages(spark: SparkSession, folder: str, job: str, delay: dt.timedelta = DELAY, pattern: str = "events*.parquet",
            min_hours: float = 2.0) -> DataFrame:
    """One trigger.  The outages closed so far, as ``outage_islands`` gives them."""
    route(spark, folder, job, delay, pattern)
    rows = _on_time(spark, job, delay)
    bad = F.coalesce((F.col(KWH) == 0) | (F.col(VOLT) < VOLTAGE_MIN), F.lit(False))
    rows = rows.select(METER, TYPE, RID, F.unix_micros("event_time").alias("at"), bad.alias("bad"), "event_time")
    schema = _OUTAGE.format(meter=rows.schema[METER].dataType.simpleString())
    closed = rows.groupBy(METER).transformWithStateInPandas(
        statefulProcessor=OutageProcessor(), outputStructType=schema, outputMode="append", timeMode="eventtime")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{job}/outages/batch={epoch}")

    _run(spark, closed, write, f"{job}/_ckpt/outages")
    out = spark.read.option("basePath", f"{job}/outages").parquet(f"{job}/outages")
    out = out.select(METER, TYPE, instant_as_ntz("outage_start").alias("outage_start"), instant_as_ntz("outage_end").alias("outage_end"))
    hours = F.timestamp_diff("SECOND", F.col("outage_start"), F.col("outage_end")) / 3600.0
    return out.withColumn("_h", hours).filter(F.col("_h") >= min_hours).select(
        METER, TYPE, "outage_start", "outage_end", snap("_h", 2).alias("duration_hours"))
