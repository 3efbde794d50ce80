"""Rolled-up sketches against exact answers."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from meterlens.operators import sketches as S


def readings(spark, n=60_000):
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int"))
    load = F.pow(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100_000)) / 100_000.0, 3) * 50
    df = spark.range(n).select(
        day.alias("date"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 300 == 1, F.lit(None)).otherwise("cold").alias("consumer_type"),
        (F.col("id") % 24).cast("int").alias("hour"), F.when(F.col("id") % 500 != 7, F.pmod(F.xxhash64("id"), F.lit(7000))).alias("meter_id"),
        F.when(F.col("id") % 400 != 9, load).alias("consumption_kwh"))
    return df


def test_distinct_meters_of_any_period(spark):
    df = readings(spark)
    daily = S.daily_meters(df)
    want = {r.consumer_type: r.n for r in df.groupBy("consumer_type").agg(F.count_distinct("meter_id").alias("n")).collect()}
    got = {r.consumer_type: r.n_meters for r in S.distinct_meters(daily, ["consumer_type"]).collect()}
    direct = {r.consumer_type: r.e for r in df.filter("meter_id IS NOT NULL").groupBy("consumer_type").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col("meter_id").cast("string"), F.lit(S.LOG_BUCKETS))).alias("e")).collect()}
    assert set(got) == set(want) == {"hot", "cold", None}
    for t in want:
        assert abs(got[t] - want[t]) <= 4 * S.hll_error() * want[t]
        assert abs(got[t] - direct[t]) <= 4 * S.hll_error() * want[t]
    assert all(r.estimate_close for r in S.distinct_meters_checked(df).collect())
    assert S.distinct_meters_checked(df.filter("hour > 99")).count() == 0


def test_load_quantiles_of_any_period(spark):
    df = readings(spark)
    daily = S.daily_loads(df)
    got = {r.consumer_type: r for r in S.load_quantiles(daily, ["consumer_type"], {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    for t in ("hot", "cold", None):
        x = np.sort([r.consumption_kwh for r in df.filter(F.col("consumer_type").eqNullSafe(F.lit(t))).filter("consumption_kwh IS NOT NULL").collect()])
        assert got[t].readings == len(x)
        for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            low, high = np.searchsorted(x, got[t][name]) / len(x), np.searchsorted(x, got[t][name], "right") / len(x)
            assert low - 2 * S.kll_error() <= p <= high + 2 * S.kll_error()
    checked = S.load_quantiles_checked(df, {"p50": 0.5, "p95": 0.95}).collect()
    assert len(checked) == 9 and all(r.p50_close and r.p95_close for r in checked)


def test_a_month_of_nulls_only(spark):
    df = readings(spark, 300).withColumn("consumption_kwh", F.lit(None).cast("double")).withColumn("meter_id", F.lit(None).cast("long"))
    assert {(r.meter_count, r.estimate_close) for r in S.distinct_meters_checked(df).collect()} == {(0, True)}
    assert S.load_quantiles_checked(df, {"p50": 0.5}).count() == 0
