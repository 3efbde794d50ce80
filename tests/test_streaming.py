import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from meterlens.operators import meters as M
from meterlens.session import checkpoint_folder
from meterlens.sources.tables import meter_readings
from meterlens.streaming import ingest as ST

EV = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, EV).coalesce(1).write.mode("append").parquet(folder)


def test_incremental_ingest_dedupes_across_batches(spark):
    base = checkpoint_folder(spark)
    src = tempfile.mkdtemp(prefix="ml-src-")
    out = ST.run_dir(base, "test-ingest")
    t = dt.datetime(2024, 1, 1, 10, 5)
    first = [(1, t, 7, "click", 3.0, '{"k": 50}'), (2, t + dt.timedelta(minutes=10), 7, "click", 4.0, '{"k": 50}'),
             (3, t + dt.timedelta(hours=1), 7, "click", 6.0, '{"k": 5}')]
    _write(spark, src, first)
    got1 = ST.ingest_deduplicated(spark, src, out, pattern="part-*.parquet").count()
    assert got1 == 2  # two readings in the same hour collapse to one key
    second = [(4, t + dt.timedelta(minutes=30), 7, "click", 9.0, '{"k": 1}'),   # late duplicate key
              (5, t + dt.timedelta(hours=2), 7, "view", 8.0, '{"k": 2}')]
    _write(spark, src, second)
    df = ST.ingest_deduplicated(spark, src, out, pattern="part-*.parquet")
    keys = sorted((r.meter_id, r.timestamp) for r in df.collect())
    assert keys == [(7, dt.datetime(2024, 1, 1, 10)), (7, dt.datetime(2024, 1, 1, 11)),
                    (7, dt.datetime(2024, 1, 1, 12))]


def test_late_files_are_kept_and_batches_are_not_stored_twice(spark):
    base = checkpoint_folder(spark)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), ST.run_dir(base, "test-late")
    t = dt.datetime(2024, 1, 20)
    _write(spark, src, [(10, t, 1, "click", 3.0, '{"k": 50}'), (11, t, None, "view", 4.0, '{"k": 9}')])
    ST.ingest_deduplicated(spark, src, job, pattern="part-*.parquet")
    _write(spark, src, [(1, dt.datetime(2023, 5, 1), 1, "click", 7.0, '{"k": 1}'), (2, t, 1, "click", 8.0, '{"k": 2}'),
                        (3, t, None, "view", 8.0, '{"k": 2}')])
    got = ST.ingest_deduplicated(spark, src, job, pattern="part-*.parquet")
    assert sorted(r.reading_id for r in got.collect()) == [1, 10, 11]
    assert got.columns == meter_readings(spark.read.parquet(src)).columns
    again = ST.ingest_deduplicated(spark, src, job, pattern="part-*.parquet")
    assert again.count() == 3


def test_hourly_stream_adds_up_over_triggers(spark):
    base = checkpoint_folder(spark)
    src, job = tempfile.mkdtemp(prefix="ml-src-"), ST.run_dir(base, "test-hours")
    t = dt.datetime(2024, 1, 1, 5, 30)
    for k in (2, 1):
        _write(spark, src, [(k, t, k, "click", 10.0 * k, '{"k": %d}' % (10 * k))])
        got = ST.hourly_load_stream(spark, src, job, pattern="part-*.parquet")
    r = got.collect()
    assert len(r) == 1 and (r[0].total_kwh, r[0].avg_voltage, r[0].readings) == (30.0, 185.0, 2)


def test_hourly_stream_matches_batch(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = ST.run_dir(checkpoint_folder(spark), "test-hourly")
    s = ST.hourly_load_stream(spark, sf, out)
    b = (meter_readings(spark.read.parquet(f"{sf}/events.parquet"))
         .groupBy(F.col("timestamp").alias("hour_start"), "consumer_type")
         .agg(F.count(F.lit(1)).alias("readings")))
    assert s.count() == b.count()
    assert s.join(b, ["hour_start", "consumer_type", "readings"]).count() == b.count()


def test_sessions_close_on_gap(spark):
    schema = ("timestamp timestamp_ntz, meter_id string, consumer_type string, consumption_kwh double, "
              "voltage_v double, power_factor double, reading_id long")
    h = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    rows = [(h(0), "A", "D", 0.0, 230.0, 0.9, 1), (h(1), "A", "D", 0.0, 230.0, 0.9, 2),
            (h(3), "A", "D", 0.0, 230.0, 0.9, 3), (h(6), "A", "D", 0.0, 230.0, 0.9, 4),
            (h(7), "A", "D", 5.0, 230.0, 0.9, 5)]
    got = ST.low_consumption_sessions(spark.createDataFrame(rows, schema), "2 hours").orderBy("first_bad").collect()
    assert [(r.first_bad, r.last_bad, r.bad_readings) for r in got] == [(h(0), h(3), 3), (h(6), h(6), 1)]
    assert M is not None
