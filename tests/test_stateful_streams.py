import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from meterlens.operators.loads import append_new_only
from meterlens.operators.meters import outage_islands
from meterlens.session import checkpoint_folder
from meterlens.sources.tables import meter_readings
from meterlens.streaming import stateful as S
from meterlens.streaming.ingest import KEYS, run_dir

EV = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
T0 = dt.datetime(2024, 1, 1)
DELAY = dt.timedelta(hours=12)
PARTS = "part-*.parquet"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, EV).coalesce(1).write.mode("append").parquet(folder)


def _readings(rng, n, hours, first=0):
    out = []
    for i in range(n):
        at = T0 + dt.timedelta(hours=rng.randrange(hours), minutes=rng.randrange(60))
        out.append((first + i, at, rng.choice([1, 2, 3]), rng.choice(["view", "click"]), rng.choice([0.0, 1.0, 9.0, 20.0]),
                    '{"k": %d}' % rng.choice([5, 40, 60])))
    return out


def _files(rng, n, days):
    """Day by day, each file out of order inside; a reading may come up to 8 hours behind the file before."""
    files = []
    for d in range(days):
        rows = _readings(rng, n, 24 + (8 if d else 0), 1000 * d)
        shift = dt.timedelta(hours=24 * d - (8 if d else 0))
        files.append([(r[0], r[1] + shift, *r[2:]) for r in rows])
    return files


def _as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ingest_with_watermark_equals_batch_with_late_rows(spark):
    rng = random.Random(1)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), run_dir(checkpoint_folder(spark), "st-ingest")
    files = _files(rng, 40, 4)
    files.append([(9000, T0, 1, "view", 3.0, '{"k": 1}'), (9001, T0 + dt.timedelta(hours=5, minutes=59), 77, "view", 3.0, '{"k": 1}'),
                  (9002, None, 1, "view", 3.0, '{"k": 1}'), (9003, None, 1, "view", 3.0, '{"k": 1}')])
    want, seen = None, []
    for rows in files:
        _write(spark, src, rows)
        got = S.ingest(spark, src, job, DELAY, PARTS)
        batch = meter_readings(spark.createDataFrame(rows, EV))
        known = batch.limit(0) if want is None else spark.createDataFrame(want, batch.schema)
        want = (want or []) + append_new_only(known, batch, KEYS, [F.col("reading_id")]).collect()
        assert _as_rows(got.table) == sorted((tuple(r) for r in want), key=str)
        seen.append(got.state_rows)
    assert max(seen) < 3 * 24 * 3  # two days at most of three meters' hours, not the history
    assert _as_rows(S.ingest(spark, src, job, DELAY, PARTS).table) == sorted((tuple(r) for r in want), key=str)  # nothing new


def test_ingest_goes_on_after_a_failed_step(spark, monkeypatch):
    rng = random.Random(5)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), run_dir(checkpoint_folder(spark), "st-crash")
    first, second = _files(rng, 30, 2)
    _write(spark, src, first)
    S.ingest(spark, src, job, DELAY, PARTS)
    _write(spark, src, second)
    late = [(8000, T0 - dt.timedelta(days=3), 5, "view", 3.0, '{"k": 1}')]
    _write(spark, src, late)

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(S, "_run", fail)
        with pytest.raises(RuntimeError):
            S.ingest(spark, src, job, DELAY, PARTS)
    got = S.ingest(spark, src, job, DELAY, PARTS).table
    keys = {(r[2], r[1].replace(minute=0)) for r in first + second + late}
    found = [(r.meter_id, r.timestamp) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == keys


def test_hourly_windows_equal_batch_and_parts_stay_bounded(spark):
    rng = random.Random(2)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), run_dir(checkpoint_folder(spark), "st-hours")
    files = _files(rng, 30, 5)
    files.append(_readings(rng, 6, 20, 7000))  # late: days behind
    for rows in files:
        _write(spark, src, rows)
        S.hourly_load(spark, src, job, DELAY, PARTS, max_parts=3)
        assert S.hour_parts(spark, job).select("part").distinct().count() <= 3
    S.close_job(spark, job, DELAY)
    _write(spark, src, [(9999, T0, 1, "view", 30.0, '{"k": 5}')])  # after the closing: late again
    got = S.hourly_load(spark, src, job, DELAY, PARTS, max_parts=3)
    rows = [r for f in files for r in f] + [(9999, T0, 1, "view", 30.0, '{"k": 5}')]
    m = meter_readings(spark.createDataFrame(rows, EV))
    want = m.groupBy(F.col("timestamp").alias("hour_start"), "consumer_type").agg(
        F.sum("consumption_kwh").alias("total_kwh"), F.avg("voltage_v").alias("avg_voltage"),
        F.avg("power_factor").alias("avg_pf"), F.count(F.lit(1)).alias("readings"))
    a = {tuple(r)[:2]: tuple(r)[2:] for r in got.collect()}
    b = {tuple(r)[:2]: tuple(r)[2:] for r in want.collect()}
    assert a.keys() == b.keys()
    for k in b:
        assert a[k] == pytest.approx(b[k])


def test_parts_of_fifty_triggers_are_combined(spark):
    job = run_dir(checkpoint_folder(spark), "st-parts")
    schema = "hour_start timestamp_ntz, consumer_type string, kwh double, v double, n_v long, pf double, n_pf long, n long"
    most = 0
    for i in range(50):
        part = spark.createDataFrame([(T0 + dt.timedelta(hours=i // 2), "view", 1.0, 2.0, 1, 0.5, 1, 1)], schema)
        part.coalesce(1).write.parquet(f"{job}/hours/batch={i}")
        most = max(most, S.compact_hours(spark, job, 10))
    assert most <= 10
    total = S._add_up(S.hour_parts(spark, job)).agg(F.count(F.lit(1)), F.sum("n")).first()
    assert tuple(total) == (25, 50)


def test_outage_stream_equals_islands(spark):
    rng = random.Random(3)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), run_dir(checkpoint_folder(spark), "st-outage")
    files = _files(rng, 60, 4)
    for rows in files:
        _write(spark, src, rows)
        S.outages(spark, src, job, DELAY, PARTS)
    S.close_job(spark, job, DELAY)
    got = S.outages(spark, src, job, DELAY, PARTS)
    want = outage_islands(meter_readings(spark.createDataFrame([r for f in files for r in f], EV)))
    assert _as_rows(got) == _as_rows(want)
    assert want.count() > 3
