"""Keyed tables: only touched files are rewritten, failed merges leave the old version."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from meterlens.sources.keyed_table import KeyedTable

SCHEMA = "meter_id string, timestamp timestamp_ntz, kwh double, note string, seq long"
T0 = dt.datetime(2024, 1, 1)
KEYS = ("meter_id", "timestamp")


def at(day, hour=0):
    return T0 + dt.timedelta(days=day, hours=hour)


def new_table(rows_per_file=100):
    return KeyedTable(tempfile.mkdtemp(prefix="ml-keyed-") + "/t", KEYS, "date_trunc('month', timestamp)", rows_per_file)


def facts(days, meters=4):
    return [(f"m{m}", at(d, h), 1.0, "old", 0) for m in range(meters) for d in range(days) for h in range(0, 24, 6)]


def merge(spark, t, rows, schema=SCHEMA):
    return t.merge(spark.createDataFrame(rows, schema), ["kwh", "seq"], [F.col("seq")])


def content(df):
    return sorted((tuple(r) for r in df.select("meter_id", "timestamp", "kwh", "note").collect()), key=str)


def plain(stored, batch):
    """The same merge as a loop over a dict."""
    out, last = {(m, t): (k, n) for m, t, k, n, _ in stored}, {}
    for m, t, k, n, s in sorted(batch, key=lambda r: r[4]):
        last[m, t] = (k, n)
    for key, (k, n) in last.items():
        out[key] = (k, out[key][1]) if key in out else (k, n)
    return sorted(((m, t, k, n) for (m, t), (k, n) in out.items()), key=str)


def test_merge_rewrites_only_files_that_hold_a_key(spark):
    t, stored = new_table(), facts(90)
    t.create(spark.createDataFrame(stored, SCHEMA))
    before = {tuple(r) for r in t.manifest(spark).select("folder", "file").distinct().collect()}
    assert len(before) >= 10
    batch = [("m1", at(3, 6), 5.0, "new", 1), ("m1", at(3, 6), 7.0, "new", 2), ("m9", at(80), 9.0, "new", 1)]
    done = merge(spark, t, batch)
    after = {tuple(r) for r in t.manifest(spark).select("folder", "file").distinct().collect()}
    kept = before & after
    assert done.files_before == len(before) and done.batch_rows == 2
    assert done.files_rewritten == len(before) - len(kept) == 1  # the new key m9 is in no file's range or filter
    assert done.rows_read <= 2 * t.rows_per_file
    assert content(t.read(spark)) == plain(stored, batch)
    assert content(t.read(spark, 0)) == plain(stored, [])  # the old version is still whole


def test_many_merges_equal_a_dict(spark):
    rnd, t, stored = random.Random(5), new_table(60), facts(40, 3)
    t.create(spark.createDataFrame(stored, SCHEMA))
    want = stored
    for step in range(1, 4):
        batch = [(f"m{rnd.randrange(5)}", at(rnd.randrange(60), rnd.choice([0, 3, 6])), rnd.random(), f"b{step}", i)
                 for i in range(40)]
        merge(spark, t, batch)
        merged = plain(want, batch)
        assert content(t.read(spark)) == merged
        want = [(m, ts, k, n, 0) for m, ts, k, n in merged]
    assert t.read(spark).groupBy(*KEYS).count().filter("count > 1").isEmpty()


def test_a_broken_merge_leaves_the_old_version_and_can_be_repeated(spark, monkeypatch):
    t, stored = new_table(), facts(30)
    t.create(spark.createDataFrame(stored, SCHEMA))
    batch = [("m0", at(1), 5.0, "new", 1), ("x", at(1), 5.0, "new", 1)]
    real = KeyedTable._commit

    def broken(self, *args):
        raise OSError("lost between the data and the pointer")

    monkeypatch.setattr(KeyedTable, "_commit", broken)
    with pytest.raises(OSError):
        merge(spark, t, batch)
    assert t._names(spark, "data") and "1" in t._names(spark, "data")  # written, but no pointer names it
    assert t.version(spark) == 0 and content(t.read(spark)) == plain(stored, [])
    monkeypatch.setattr(KeyedTable, "_commit", real)
    assert merge(spark, t, batch).version == 1
    assert content(t.read(spark)) == plain(stored, batch)


def test_expired_versions_go_and_shared_files_stay(spark):
    t, stored = new_table(), facts(60)
    t.create(spark.createDataFrame(stored, SCHEMA))
    batches = [[(f"m{i}", at(2 + 20 * i), 5.0 + i, "new", 1)] for i in range(3)]
    want = stored
    for b in batches:
        merge(spark, t, b)
        want = [(*r, 0) for r in plain(want, b)]
    first = {r.file for r in t.manifest(spark, 0).select("file").collect()}
    assert t.expire(spark, keep=1) == [0, 1, 2] and t.expire(spark, keep=1) == []
    assert content(t.read(spark)) == plain(want, [])
    left = {n for n in t._names(spark, "data/0") if n.endswith(".parquet")}
    live = {r.file for r in t.manifest(spark).filter("folder = 0").select("file").collect()}
    assert left == live and live < first  # untouched files of version 0 are still in use
    assert t._names(spark, "_pointers") == ["3"]
    assert merge(spark, t, [("m0", at(2), 1.5, "new", 1)]).files_rewritten == 1


def test_nulls_empty_batches_other_types_and_columns(spark):
    t = new_table()
    rows = [(None, at(0), 1.0, "old", 0), ("m0", None, 2.0, "old", 0), ("m0", at(0), 3.0, "old", 0)]
    t.create(spark.createDataFrame(rows, SCHEMA))
    assert merge(spark, t, []).version == 0
    done = merge(spark, t, [(None, at(0), 8.0, "new", 1), ("m0", at(0), 9.0, "new", 1)],
                 "meter_id string, timestamp timestamp_ntz, kwh double, slice string, seq int")
    assert done.batch_rows == 2
    got = content(t.read(spark))
    assert got == sorted([(None, at(0), 1.0, "old"), (None, at(0), 8.0, None), ("m0", None, 2.0, "old"),
                          ("m0", at(0), 9.0, "old")], key=str)
    empty = new_table()
    empty.create(spark.createDataFrame([], SCHEMA))
    assert content(empty.read(spark)) == []
    merge(spark, empty, rows)
    assert content(empty.read(spark)) == sorted([r[:4] for r in rows], key=str)
    with pytest.raises(ValueError):
        empty.create(spark.createDataFrame(rows, SCHEMA))


def test_a_meter_and_time_range_opens_few_files(spark):
    t, stored = KeyedTable(tempfile.mkdtemp(prefix="ml-keyed-") + "/t", KEYS, "to_date(timestamp)", 150), facts(60, 40)
    t.create(spark.createDataFrame(stored, SCHEMA))
    files = t.manifest(spark).select("folder", "file").distinct().count()
    part = t.read_range(spark, ("m7",), ("m7",), "slice between '2024-01-11' and '2024-01-13'")
    want = [r[:4] for r in stored if r[0] == "m7" and at(10) <= r[1] < at(13)]
    assert content(part) == sorted(want, key=str) and len(want) == 12
    assert files > 40 and len(part.inputFiles()) <= 6  # a tenth of the table's files at most
    point = t.read_range(spark, ("m7", at(20)), ("m7", at(20, 6)))
    assert content(point) == sorted([r[:4] for r in stored if r[0] == "m7" and at(20) <= r[1] <= at(20, 6)], key=str)
    assert t.read_range(spark, ("zz",), ("zz",)).isEmpty()
