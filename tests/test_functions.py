import datetime as dt
import math

from pyspark.sql import functions as F

from meterlens.functions import calendar as cal
from meterlens.functions.exprs import clip, pct_change, safe_div, snap


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (0.0,), (20.0,), (40.0,), (41.0,)], "x double")
    got = [r[0] for r in df.select(clip("x", 0.0, 40.0)).collect()]
    assert got[0] is None and got[1] is None
    assert got[2:] == [0.0, 0.0, 20.0, 40.0, 40.0]


def test_snap_modes(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (2.675,), (-2.5,), (85.9825,)], "x double")
    even = [r[0] for r in df.select(snap("x", 0)).collect()]
    up = [r[0] for r in df.select(snap("x", 0, "half_up")).collect()]
    assert even[:2] == [2.0, 4.0] and up[:2] == [3.0, 4.0]
    assert df.select(snap("x", 2)).collect()[2][0] == 2.68  # decimal, not binary, tie
    assert up[3] == -3.0
    assert df.select(snap("x", 3)).collect()[4][0] == 85.982  # pandas half-even


def test_safe_div_and_pct_change(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, 1.5, None]
    assert [r[0] for r in df.select(pct_change("a", "b")).collect()] == [None, 50.0, None]


def test_fiscal_year_and_quarter(spark):
    days = [dt.date(2023, 7, 16), dt.date(2023, 7, 17), dt.date(2023, 7, 1), dt.date(2023, 12, 31),
            dt.date(1999, 12, 31), dt.date(2024, 4, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(cal.fiscal_year("d"), cal.fiscal_quarter("d")).collect()
    assert [tuple(r) for r in got] == [("2022/23", "Q1"), ("2023/24", "Q1"), ("2022/23", "Q1"),
                                       ("2023/24", "Q2"), ("1999/00", "Q2"), ("2023/24", "Q4")]
    assert df.select(cal.fiscal_year_start_date(F.lit("2023/24"))).first()[0] == dt.date(2023, 7, 17)


def test_seasons(spark):
    df = spark.createDataFrame([(m,) for m in [12, 2, 3, 5, 6, 9, 10]], "m int")
    a = [r[0] for r in df.select(cal.season_of_month("m")).collect()]
    b = [r[0] for r in df.select(cal.season_of_month("m", dec_is_winter=False)).collect()]
    assert a == ["Winter", "Winter", "Pre-Monsoon", "Pre-Monsoon", "Monsoon", "Monsoon", "Post-Monsoon"]
    assert b[0] == "Post-Monsoon" and b[1:] == a[1:]


def test_meter_time_features(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 18, 0),), (dt.datetime(2024, 1, 8, 7, 0),),
                                (dt.datetime(2024, 1, 8, 12, 0),)], "timestamp timestamp_ntz")
    feats = cal.meter_time_features("timestamp")
    got = df.select(*[c.alias(n) for n, c in feats.items()]).collect()
    assert got[0]["day_of_week"] == 5 and got[0]["is_weekend"] and got[0]["is_evening_peak"]
    assert got[1]["day_of_week"] == 0 and got[1]["is_morning_peak"] and got[1]["is_peak_hour"]
    assert not got[2]["is_peak_hour"]
    assert not math.isnan(got[2]["hour"])
