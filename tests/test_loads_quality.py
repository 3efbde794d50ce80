import datetime as dt
import json

from pyspark.sql import functions as F

from meterlens.operators import loads as L
from meterlens.operators import quality as Q
from meterlens.sources.payloads import decode_weather, decode_worldbank

T = "fiscal_year string, total_energy_gwh double, peak_demand_mw double, notes string"


def test_upsert_semantics(spark):
    target = spark.createDataFrame([("2015/16", 1.0, 10.0, "keep"), ("2016/17", 2.0, 20.0, "old")], T)
    batch = spark.createDataFrame([("2016/17", 5.0, 50.0, "new", 1), ("2016/17", 6.0, 60.0, "newer", 2),
                                   ("2017/18", 7.0, 70.0, "ins", 1)], T + ", seq int")
    merged = L.upsert(target, batch, ["fiscal_year"], ["total_energy_gwh"], order=[F.col("seq")])
    got = {r.fiscal_year: r for r in merged.collect()}
    assert got["2015/16"].merge_action == "kept" and got["2015/16"].total_energy_gwh == 1.0
    u = got["2016/17"]
    assert u.merge_action == "updated" and u.total_energy_gwh == 6.0       # last in batch wins
    assert u.peak_demand_mw == 20.0 and u.notes == "old"                   # not in update list: kept
    i = got["2017/18"]
    assert i.merge_action == "inserted" and i.peak_demand_mw == 70.0 and i.notes == "ins"
    # idempotent: merging the same batch into the result changes nothing
    again = L.upsert(merged.drop("merge_action", "seq"), batch, ["fiscal_year"], ["total_energy_gwh"],
                     order=[F.col("seq")])
    cols = ["fiscal_year", "total_energy_gwh", "peak_demand_mw", "notes"]
    assert sorted(map(tuple, again.select(cols).collect())) == sorted(map(tuple, merged.select(cols).collect()))


def test_append_new_only(spark):
    s = "meter_id string, timestamp timestamp_ntz, kwh double, reading_id long"
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([("A", t0, 1.0, 1)], s)
    batch = spark.createDataFrame([("A", t0, 9.0, 5), ("B", t0, 2.0, 7), ("B", t0, 3.0, 6),
                                   ("C", t0, 4.0, 8)], s)
    got = sorted(tuple(r) for r in L.append_new_only(target, batch, ["meter_id", "timestamp"],
                                                     [F.col("reading_id")]).collect())
    assert got == [("B", t0, 3.0, 6), ("C", t0, 4.0, 8)]
    assert L.append_new_only(batch, batch, ["meter_id", "timestamp"], [F.col("reading_id")]).count() == 0


def test_range_join_open_ended(spark):
    facts = spark.createDataFrame([(1, "D", dt.datetime(2023, 7, 16)), (2, "D", dt.datetime(2023, 7, 17)),
                                   (3, "D", dt.datetime(2026, 1, 1)), (4, "X", dt.datetime(2024, 1, 1))],
                                  "id int, code string, at timestamp_ntz")
    rates = spark.createDataFrame([("D", 8.0, dt.datetime(2022, 7, 17), dt.datetime(2023, 7, 17)),
                                   ("D", 9.0, dt.datetime(2023, 7, 17), None)],
                                  "code string, rate double, effective_from timestamp_ntz, effective_to timestamp_ntz")
    got = {r.id: r.rate for r in L.range_join(facts, rates, "code", "at").collect()}
    assert got == {1: 8.0, 2: 9.0, 3: 9.0, 4: None}
    # a rate after the last fact, one before the first, and an end far in the future
    more = rates.unionByName(spark.createDataFrame(
        [("D", 99.0, dt.datetime(2030, 1, 1), None), ("D", 1.0, dt.datetime(1999, 1, 1), dt.datetime(1999, 6, 1)),
         ("X", 7.0, dt.datetime(2000, 1, 1), dt.datetime(9999, 12, 31))], rates.schema))
    got = {r.id: r.rate for r in L.range_join(facts, more, "code", "at").collect()}
    assert got == {1: 8.0, 2: 9.0, 3: 9.0, 4: 7.0}
    assert L.range_join(facts.filter("id = 0"), more, "code", "at").count() == 0


def test_validation_checks_thresholds(spark):
    annual = spark.createDataFrame([(f"20{i:02d}/{i + 1:02d}", v) for i, v in
                                    enumerate([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 6.0, 5.0, 4.0, 5.0])],
                                   "fiscal_year string, total_energy_gwh double")
    monthly = spark.createDataFrame([(1.0,), (None,)], "total_gwh double")
    c = {r.check_name: r for r in Q.validation_checks(annual, None, None, monthly).collect()}
    assert c["annual_growth"].value == 0.7 and c["annual_growth"].passed     # exactly 70 % passes
    assert not c["monthly_totals_positive"].passed                           # NULL counts as failure
    assert Q.run_passes(Q.validation_checks(annual, None, None, monthly)).first()[0] is False


def test_alerts_strictly_greater_and_empty_quality(spark):
    m = spark.createDataFrame([("system_loss_pct", 25.0, {"p": "a"}, None),
                               ("system_loss_pct", 25.1, {"p": "b"}, None),
                               ("peak_demand_mw", 2600.0, {}, None)],
                              "name string, value double, labels map<string,string>, ts timestamp_ntz")
    a = Q.check_alerts(m).collect()
    assert sorted((r.metric, r.severity) for r in a) == [("peak_demand_mw", "CRITICAL"),
                                                         ("system_loss_pct", "WARNING")]
    empty = spark.createDataFrame([], "x double")
    assert Q.data_quality("e", empty, F.col("x") > 0).first().value == 0.0


def test_latest_metrics_and_increment(spark):
    ev = spark.createDataFrame([("rows", 1.0, {"t": "a"}, dt.datetime(2024, 1, 1)),
                                ("rows", 5.0, {"t": "a"}, dt.datetime(2024, 1, 2)),
                                ("rows", 7.0, {"t": "b"}, dt.datetime(2024, 1, 1))],
                               "name string, value double, labels map<string,string>, ts timestamp_ntz")
    got = sorted(r.value for r in Q.latest_metrics(ev).collect())
    assert got == [5.0, 7.0]
    assert Q.increment_totals(ev).first().value == 13.0


def test_weather_payload_decode(spark):
    full = {"main": {"temp": 20.1, "temp_max": 25.0, "temp_min": 15.0, "feels_like": 19.0, "humidity": 60},
            "wind": {"speed": 2.5}, "clouds": {"all": 40}, "rain": {"1h": 1.2},
            "weather": [{"description": "light rain"}]}
    no_rain = {k: v for k, v in full.items() if k != "rain"} | {"weather": []}
    df = spark.createDataFrame([("KTM001", json.dumps(full)), ("KTM001", json.dumps(no_rain)),
                                ("KTM001", "{not json")], "station_id string, payload string")
    rows = decode_weather(df).collect()
    assert rows[0].wind_speed_kmh == 9.0 and rows[0].rainfall_mm == 1.2 and rows[0].weather_desc == "light rain"
    assert rows[1].rainfall_mm == 0.0 and rows[1].weather_desc is None
    assert rows[2].malformed or rows[2].avg_temp_c is None


def test_worldbank_payload_decode(spark):
    payload = json.dumps([{"page": 1}, [{"date": "2015", "value": 131.5}, {"date": "2014", "value": None},
                                        {"date": "2013", "value": 120.0}]])
    out = decode_worldbank(spark.createDataFrame([(payload,)], "payload string")).collect()
    assert [(r.year, r.per_capita_kwh_wb) for r in out] == [(2013, 120.0), (2015, 131.5)]


def test_load_stage_merges_skips_and_logs(spark):
    import tempfile

    import pytest

    from meterlens.operators import load_stage as LS
    from meterlens.sources.sinks import read_current
    base = tempfile.mkdtemp(prefix="ml-load-")
    annual = spark.createDataFrame([("2015/16", 1.0, 10.0, float("nan"))], "fiscal_year string, total_energy_gwh double, peak_demand_mw double, x double")
    m = "meter_id string, timestamp timestamp_ntz, kwh double, reading_id long"
    t0 = dt.datetime(2024, 1, 5)
    meters = spark.createDataFrame([("A", t0, 1.0, 2), ("A", t0, 2.0, 1), (None, t0, 3.0, 3)], m)
    assert LS.run_load(spark, {"annual": annual, "smart_meter": meters}, base) == {"annual": 1, "smart_meter": 2}
    later = spark.createDataFrame([("2015/16", 5.0, 50.0, 1.0), ("2016/17", 6.0, 60.0, 1.0)], annual.schema)
    old = spark.createDataFrame([("A", t0, 9.0, 9), (None, t0, 9.0, 9), ("A", t0 - dt.timedelta(days=900), 4.0, 4)], m)
    assert LS.run_load(spark, {"annual": later, "smart_meter": old}, base) == {"annual": 2, "smart_meter": 1}
    got = {r.fiscal_year: r for r in read_current(spark, f"{base}/annual").collect()}
    assert got["2015/16"].total_energy_gwh == 5.0 and got["2015/16"].x is None and len(got) == 2
    stored = spark.read.parquet(f"{base}/smart_meter")
    assert sorted(r.reading_id for r in stored.collect()) == [1, 3, 4]
    with pytest.raises(Exception):
        LS.run_load(spark, {"annual": later, "smart_meter": later}, base)
    log = spark.read.parquet(f"{base}/pipeline_runs").orderBy("start_time").collect()
    assert [(r.status, r.records_loaded) for r in log] == [("success", 3), ("success", 3), ("failed", 2)]
    assert log[2].error_message and LS.run_load(spark, {"annual": later.limit(0)}, base) == {"annual": 0}


def test_load_of_meters_reads_only_the_days_of_the_batch(spark):
    import tempfile

    from meterlens.operators import load_stage as LS
    base = tempfile.mkdtemp(prefix="ml-load-") + "/meters"
    t0 = dt.datetime(2024, 1, 5)
    first = [(f"m{i}", t0 + dt.timedelta(days=d, hours=h), 1.0, 1000 * i + 24 * d + h) for i in range(5) for d in range(10) for h in range(24)]
    m = "meter_id string, timestamp timestamp_ntz, kwh double, reading_id long"
    assert LS.load_meters(spark, spark.createDataFrame(first, m).repartition(16), base) == 1200
    files = spark.read.parquet(base).select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count().collect()
    assert len(files) == 10 and all(r["count"] == 1 for r in files)
    # a day between the two days of the batch is damaged: it must not be read
    with open(f"{base}/day=2024-01-08/part-bad.parquet", "w") as f:
        f.write("no parquet")
    late = [("m0", t0, 9.0, 1), ("m9", t0, 1.0, 2), ("m9", t0 + dt.timedelta(days=9), 1.0, 3)]
    assert LS.load_meters(spark, spark.createDataFrame(late, m), base) == 2


def test_load_of_projects_and_districts(spark):
    import tempfile

    from meterlens.operators import load_stage as LS
    base = tempfile.mkdtemp(prefix="ml-load-")
    hydro = spark.createDataFrame([("P1", 10.0), ("P2", float("nan"))], "project string, capacity_mw double")
    district = spark.createDataFrame([(1, "D")], "district_id int, district_name string")
    assert LS.run_load(spark, {"hydro_projects": hydro, "district": district}, base) == {"district": 1, "hydro_projects": 2}
    assert {r.capacity_mw for r in spark.read.parquet(f"{base}/hydro_projects").collect()} == {10.0, None}


def test_table_audit_counts_each_test_once(spark):
    child = spark.createDataFrame([(1, 5, 0.5), (2, 9, 2.0), (None, 5, None), (7, None, 0.1)], "a int, b int, v double")
    pa = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    pb = spark.createDataFrame([(5,)], "k int")
    got = {r.check_name: r.violations for r in Q.table_audit(
        child, "t", {"a": (pa, "k"), "b": (pb, "k")}, {"v_small": F.col("v") < 1}).collect()}
    assert got == {"foreign_key(a)": 1, "foreign_key(b)": 1, "v_small": 2}


def test_panel_colours_and_quality_floor(spark):
    m = spark.createDataFrame([("system_loss_pct", 17.9), ("system_loss_pct", 18.0), ("system_loss_pct", 22.0), ("data_quality_pct", 94.9),
                               ("pipeline_duration_minutes", 120.0), ("other", 1.0)], "name string, value double").withColumn("labels", F.create_map().cast("map<string,string>"))
    got = [(r.name, r.value, r.colour) for r in Q.panel_colours(m).collect()]
    assert [c for _, _, c in got] == ["green", "yellow", "red", "yellow", "red"]
    assert [(r.metric, r.value) for r in Q.check_alerts(m, min_quality=95.0).collect()] == [("data_quality_pct", 94.9)]
