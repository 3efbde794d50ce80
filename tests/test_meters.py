import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlens.functions.exprs import snap
from meterlens.operators import meters as M
from meterlens.operators.ranking import global_rank, rank_within_groups

SCHEMA = ("timestamp timestamp_ntz, meter_id string, consumer_type string, consumption_kwh double, "
          "voltage_v double, power_factor double, reading_id long")
T0 = dt.datetime(2024, 1, 1)


def h(i):
    return T0 + dt.timedelta(hours=i)


def frame(spark, rows):
    return spark.createDataFrame(
        [(h(i), m, t, k, v, pf, rid) for rid, (i, m, t, k, v, pf) in enumerate(rows)], SCHEMA)


def test_clean_dedupe_caps_flags(spark):
    rows = [
        (0, "A", "Domestic", 5.0, 230.0, 0.9),
        (0, "A", "Domestic", 9.0, 230.0, 0.9),     # duplicate key: first (reading_id) kept
        (1, "A", "Domestic", 20.0, 179.9, 1.2),    # capped to 15, voltage flagged then capped
        (2, "A", "Domestic", -1.0, 180.0, -0.1),
        (3, "A", "Domestic", 3.0, 260.0, None),
        (4, "A", "Domestic", 3.0, 260.1, 0.5),
        (0, "B", "Unknown", 5000.0, None, 0.9),     # unknown type passes through
    ]
    out = {(r.meter_id, r.timestamp): r for r in M.clean_meters(frame(spark, rows)).collect()}
    assert len(out) == 6
    assert out[("A", h(0))].consumption_kwh == 5.0
    r1 = out[("A", h(1))]
    assert (r1.consumption_kwh, r1.voltage_v, r1.voltage_flag, r1.power_factor) == (15.0, 180.0, True, 1.0)
    r2 = out[("A", h(2))]
    assert (r2.consumption_kwh, r2.voltage_flag, r2.power_factor) == (0.0, False, 0.0)
    assert out[("A", h(3))].voltage_flag is False and out[("A", h(3))].power_factor is None
    assert out[("A", h(4))].voltage_flag is True and out[("A", h(4))].voltage_v == 260.0
    rb = out[("B", h(0))]
    assert rb.consumption_kwh == 5000.0 and rb.voltage_v is None and rb.voltage_flag is False


def brute_outages(pdf, min_hours=2.0):
    """Reference semantics written as a plain loop (test oracle only)."""
    out = []
    pdf = pdf.sort_values(["meter_id", "timestamp", "reading_id"])
    for m, g in pdf.groupby("meter_id"):
        start = None
        for _, r in g.iterrows():
            bad = (r.consumption_kwh == 0) or (r.voltage_v is not None and not pd.isna(r.voltage_v)
                                               and r.voltage_v < 180)
            if bad and start is None:
                start = r.timestamp
            elif not bad and start is not None:
                hours = (r.timestamp - start).total_seconds() / 3600
                if hours >= min_hours:
                    out.append((m, r.consumer_type, start, r.timestamp, round(hours, 2)))
                start = None
    return sorted(out)


def test_outage_islands_edge_cases(spark):
    good, bad = 2.0, 0.0
    rows = []
    # meter A: run of 1h (dropped), run of 2h, back-to-back, gap inside a run, open run at end
    seq = [bad, good, bad, bad, good, bad, bad, bad, good, bad, good, good]
    rows += [(i, "A", "Domestic", k, 230.0, 0.9) for i, k in enumerate(seq)]
    rows += [(20, "A", "Domestic", bad, 230.0, 0.9), (25, "A", "Domestic", good, 230.0, 0.9)]  # gap
    rows += [(30, "A", "Domestic", bad, 230.0, 0.9), (31, "A", "Domestic", bad, 230.0, 0.9)]   # open
    # meter B: run at the start, voltage-based, null voltage
    rows += [(0, "B", "Commercial", 1.0, 170.0, 0.9), (1, "B", "Commercial", 1.0, None, 0.9),
             (2, "B", "Industrial", 1.0, 175.0, 0.9), (5, "B", "Industrial", 1.0, 230.0, 0.9)]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in M.outage_islands(df).collect())
    assert got == brute_outages(df.toPandas())
    assert (("A", "Domestic", h(2), h(4), 2.0)) in got
    assert (("A", "Domestic", h(20), h(25), 5.0)) in got
    assert all(r[2] != h(30) for r in got)


def test_outage_islands_random_vs_loop(spark):
    rnd = random.Random(7)
    rows = []
    for m in range(15):
        t = 0
        for _ in range(80):
            t += rnd.choice([1, 1, 1, 2, 3])
            k = 0.0 if rnd.random() < 0.25 else rnd.uniform(1, 10)
            v = None if rnd.random() < 0.05 else rnd.choice([175.0, 230.0, 230.0, 230.0])
            rows.append((t, f"M{m}", "Domestic", k, v, 0.9))
    df = frame(spark, rows)
    assert sorted(tuple(r) for r in M.outage_islands(df).collect()) == brute_outages(df.toPandas())


def test_outage_suspects(spark):
    seq = [0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    df = M.clean_meters(frame(spark, [(i, "A", "Domestic", k, 230.0, 0.9) for i, k in enumerate(seq)]))
    got = sorted(r.suspected_outage_start for r in M.outage_suspects(df).collect())
    assert got == [h(2), h(5), h(6)]


def test_features_match_pandas_rolling(spark):
    rnd = random.Random(3)
    rows = [(i, f"M{m}", "Domestic", None if rnd.random() < 0.05 else rnd.uniform(0, 10), 230.0, 0.9)
            for m in range(3) for i in range(0, 400, rnd.choice([1, 2]))]
    clean = M.clean_meters(frame(spark, rows))
    got = M.engineer_features(clean).toPandas().sort_values(["meter_id", "timestamp"])
    pdf = clean.toPandas().sort_values(["meter_id", "timestamp"])
    r24 = pdf.groupby("meter_id")["consumption_kwh"].transform(lambda x: x.rolling(24, min_periods=1).mean())
    r168 = pdf.groupby("meter_id")["consumption_kwh"].transform(lambda x: x.rolling(168, min_periods=1).mean())
    dev = pdf["consumption_kwh"] - pdf.groupby(["meter_id", "date"])["consumption_kwh"].transform("mean")
    np.testing.assert_allclose(got["rolling_24h_kwh"].values, r24.round(4).values, atol=1e-4, equal_nan=True)
    np.testing.assert_allclose(got["rolling_7d_kwh"].values, r168.round(4).values, atol=1e-4, equal_nan=True)
    np.testing.assert_allclose(got["deviation_from_daily_avg"].values, dev.round(4).values, atol=1e-4,
                               equal_nan=True)
    ratio = got["consumption_kwh"] / (got["rolling_24h_kwh"] + 1e-9)
    exp = np.where(ratio >= 1.5, "High", np.where(ratio >= 0.8, "Normal", "Low"))
    assert (got["demand_category"].values == exp).all()


def test_profile_percentiles_and_std(spark):
    rows = [(0, "A", "Domestic", 1.0, 230.0, 0.9), (24, "A", "Domestic", 2.0, 230.0, 0.9),
            (48, "A", "Domestic", 10.0, 230.0, 0.9), (1, "A", "Domestic", 4.0, 230.0, 0.9)]
    prof = {(r.hour, r.is_weekend): r for r in M.hourly_load_profile(M.clean_meters(frame(spark, rows))).collect()}
    r0 = prof[(0, False)]
    assert r0.p95_kwh == round(float(np.percentile([1, 2, 10], 95)), 4) == 9.2
    assert r0.std_kwh == round(float(np.std([1, 2, 10], ddof=1)), 4)
    r1 = prof[(1, False)]
    assert r1.std_kwh is None and r1.sample_count == 1 and r1.day_type == "Weekday"


def test_load_factor_zero_peak_and_pivot(spark):
    rows = [(0, "A", "Domestic", 0.0, 230.0, 0.9), (1, "A", "Domestic", 0.0, 230.0, 0.9),
            (7, "B", "Commercial", 4.0, 230.0, 0.9)]
    clean = M.clean_meters(frame(spark, rows))
    lf = {r.consumer_type: r.load_factor_pct for r in M.load_factor_daily(clean).collect()}
    assert lf == {"Domestic": None, "Commercial": 100.0}
    piv = {r.consumer_type: r for r in M.peak_offpeak_ratio(clean).collect()}
    assert piv["Commercial"].offpeak_avg_kwh is None and piv["Commercial"].peak_to_offpeak_ratio is None
    assert piv["Domestic"].peak_avg_kwh is None


def test_demand_peaks_ties_and_small_n(spark):
    rows = [(i, "A", "Domestic", k, 230.0, 0.9) for i, k in enumerate([5.0, 7.0, 7.0, 1.0])]
    top = M.demand_peaks(frame(spark, rows), top_n=2).orderBy("timestamp").collect()
    assert [r.timestamp for r in top] == [h(1), h(2)]
    assert M.demand_peaks(frame(spark, rows), top_n=10).count() == 4


def test_load_duration_curve_properties(spark):
    rnd = random.Random(1)
    rows = [(i, f"M{m}", "Domestic", float(rnd.randint(0, 5)), 230.0, 0.9)
            for m in range(4) for i in range(200)]
    ldc = M.load_duration_curve(M.clean_meters(frame(spark, rows)), num_partitions=7).orderBy("rank").toPandas()
    assert list(ldc["rank"]) == list(range(1, 201))
    assert (ldc["load_kwh"].diff().dropna() <= 0).all()
    assert ldc["exceedance_pct"].iloc[-1] == 100.0
    single = M.load_duration_curve(M.clean_meters(frame(spark, rows[:1]))).collect()
    assert single[0]["exceedance_pct"] == 100.0


def test_global_rank_matches_row_number(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randint(0, 50), rnd.choice("abc")) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v long, g string")
    got = global_rank(df, [F.col("v").desc(), F.col("id")], "r", "n", num_partitions=13).toPandas()
    exp = sorted(data, key=lambda x: (-x[1], x[0]))
    assert list(got.sort_values("r")["id"]) == [x[0] for x in exp]
    assert (got["n"] == 3000).all()
    # per-group ranks with one hot group holding most rows
    hot = [(i, rnd.randint(0, 9), "hot" if i % 10 else rnd.choice("xy")) for i in range(2000)]
    g = rank_within_groups(spark.createDataFrame(hot, "id long, v long, g string"), ["g"],
                           [F.col("v"), F.col("id")], "r", "size", num_partitions=11).toPandas()
    p = pd.DataFrame(hot, columns=["id", "v", "g"]).sort_values(["g", "v", "id"])
    p["r"] = p.groupby("g").cumcount() + 1
    m = g.merge(p, on=["id"], suffixes=("", "_exp"))
    assert (m["r"] == m["r_exp"]).all() and len(m) == 2000


def test_peak_calendar_true_hour(spark):
    rows = [(0, "A", "Domestic", 3.0, 230.0, 0.9), (5, "A", "Domestic", 9.0, 230.0, 0.9),
            (7, "B", "Domestic", 9.0, 230.0, 0.9)]
    r = M.peak_calendar(M.clean_meters(frame(spark, rows))).first()
    assert r.peak_hour == 5 and r.peak_hour_kwh == 9.0 and r.weekday == "Monday" and r.week_number == 1


def awkward_readings(hot):
    """A meter ``hot`` with most rows, five small ones and one without an id;
    several readings an hour, gaps, whole bad days."""
    rnd = random.Random(11)
    rows = []
    for i in range(1500):
        dead = rnd.random() < 0.2 or 300 < i < 420
        rows.append((i // 2 + (i % 7 == 0) * 3, hot, "Domestic", 0.0 if dead else rnd.uniform(0, 12),
                     rnd.choice([170.0, 230.0, 230.0, None]), 0.9))
    for m in [f"M{k}" for k in range(5)] + [None]:
        rows += [(i, m, rnd.choice(["Commercial", None]), 0.0 if rnd.random() < 0.3 else rnd.uniform(0, 50), 230.0, 0.9)
                 for i in range(0, 120, rnd.choice([1, 2]))]
    return rows


@pytest.mark.parametrize("hot", ["HOT", None])
def test_balanced_paths_equal_plain_windows(spark, hot):
    raw = frame(spark, awkward_readings(hot))
    clean = M.clean_meters(raw)
    w = Window.partitionBy("meter_id").orderBy("timestamp", "reading_id")
    cols = ["meter_id", "timestamp", "rolling_24h_kwh", "rolling_7d_kwh", "deviation_from_daily_avg"]
    day = Window.partitionBy("meter_id", F.to_date("timestamp"))
    plain = clean.select(
        "meter_id", "timestamp", snap(F.avg("consumption_kwh").over(w.rowsBetween(-23, 0)), 4),
        snap(F.avg("consumption_kwh").over(w.rowsBetween(-167, 0)), 4),
        snap(F.col("consumption_kwh") - F.avg("consumption_kwh").over(day), 4))
    by = lambda rows: sorted(map(tuple, rows), key=str)
    got = M.engineer_features(clean, chunk_rows=200).select(cols)
    assert by(got.collect()) == by(plain.collect()) and got.count() == clean.count()

    bad = F.coalesce((F.col("consumption_kwh") == 0) | (F.col("voltage_v") < 180), F.lit(False))
    d = raw.withColumn("bad", bad).withColumn("prev", F.lag("bad", 1, False).over(w))
    d = d.withColumn("begin", F.last(F.when(F.col("bad") & ~F.col("prev"), F.col("timestamp")), ignorenulls=True)
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = [(r.meter_id, r.consumer_type, r.begin, r.timestamp) for r in d.filter("not bad and prev").collect()
            if (r.timestamp - r.begin).total_seconds() >= 7200]
    islands = M.outage_islands(raw).collect()
    assert by((r.meter_id, r.consumer_type, r.outage_start, r.outage_end) for r in islands) == by(want) and want

    nxt = clean.withColumn("n", F.lead("consumption_kwh", 1).over(w)).filter("consumption_kwh = 0 and n = 0")
    assert by(M.outage_suspects(clean).select("meter_id", "suspected_outage_start").collect()) == \
        by(nxt.select("meter_id", "timestamp").collect())


def test_outage_islands_equal_the_loop(spark):
    raw = frame(spark, [r for r in awkward_readings("HOT") if r[1] is not None and r[2] is not None])
    assert sorted(map(tuple, M.outage_islands(raw).collect())) == brute_outages(raw.toPandas())


def test_global_rank_consistent_across_pruned_branches(spark):
    """Ranks used twice in one plan (a narrow branch and a wide one) over an
    input that comes out of a shuffle must agree -- the range cut is stored once."""
    rnd = random.Random(9)
    base = spark.createDataFrame([(rnd.randint(0, 40), rnd.choice("ab"), float(rnd.randint(0, 99)))
                                  for _ in range(5000)], "k long, g string, v double")
    agg = base.groupBy("k", "g").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("c"))
    r = rank_within_groups(agg, ["g"], [F.col("s"), F.col("k")], "r", num_partitions=7)
    narrow = r.groupBy("g").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count(F.lit(1)).alias("n"))
    wide = r.select("g", "k", "s", "c", "r")
    checked = wide.join(narrow, "g").collect()
    assert all(x.lo == 1 and x.hi == x.n and 1 <= x.r <= x.n for x in checked)
    per = {}
    for x in checked:
        per.setdefault(x.g, []).append(x.r)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())


def test_outage_islands_of_a_hot_day_are_cut_by_row_count(spark):
    """One meter's day holds most rows, many of them in one hour: segments stay
    within the bound and the outages equal the loop's."""
    from meterlens.functions.calendar import trunc_ntz
    from meterlens.operators.sequence import cut_buckets
    rnd, rows = random.Random(11), []
    hours = sorted([rnd.choice(range(24, 48)) for _ in range(1200)] + [30] * 1200)
    run = 0
    for t in [*range(0, 24, 3), *hours, *range(48, 80)]:
        run = run - 1 if run > 0 else (rnd.choice([0, 0, 3, 700]) if rnd.random() < 0.2 else 0)
        rows.append((t, "hot", "Domestic", 0.0 if run else 5.0, 230.0, 0.9))
    for m in range(20):
        rows += [(t, f"m{m}", "Domestic", rnd.choice([0.0, 4.0]), 230.0, 0.9) for t in range(60)]
    df = frame(spark, rows).repartition(16)
    x = cut_buckets(df.withColumn("_day", trunc_ntz("day", "timestamp")), ["meter_id"], "_day", ["timestamp", "reading_id"], 200)
    sizes = x.groupBy("meter_id", "_day", "_part").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 200 and x.count() == len(rows)
    assert sizes.filter("meter_id = 'hot'").count() > 12
    want = brute_outages(df.toPandas())
    assert sorted(tuple(r) for r in M.outage_islands(df, segment_rows=200).collect()) == want and want
    assert sorted(tuple(r) for r in M.outage_islands(df).collect()) == want
