import random

import pytest

from pyspark.sql import functions as F

from meterlens.operators.quantiles import exact_percentiles, grouped_percentiles


def _data(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(4000):                      # hot group with many ties
        rows.append(("hot", float(rnd.randint(0, 60)) / 4))
    for g in range(30):                        # small groups, some of size 1 and 2
        for _ in range(rnd.choice([1, 2, 3, 17])):
            rows.append((f"g{g}", rnd.uniform(-5, 5)))
    rows += [("g0", None), ("nulls", None)]
    rows += [(None, float(k) / 3) for k in range(50)]     # NULL is a group like any other
    rows += [("odd", x) for x in (float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1e-300, -1e300, 5.0)]
    return spark.createDataFrame(rows, "g string, v double")


def test_percentiles_equal_builtin(spark):
    df = _data(spark)
    probs = {"p95": 0.95, "p05": 0.05, "p50": 0.5, "p90": 0.9}
    exp = {r.g: r for r in df.groupBy("g").agg(*[F.percentile("v", p).alias(n)
                                                  for n, p in probs.items()]).collect()}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(exp) - {"nulls"} and None in got
    for g, r in got.items():
        for n in probs:
            assert repr(r[n]) == repr(exp[g][n]), (g, n, r[n], exp[g][n])


def test_grouped_statistics_equal_builtin(spark):
    df = _data(spark).filter("g is null or g != 'odd'")
    stats = {"cnt": "count", "rows": "rows", "mean": "avg", "top": "max", "sd": "std"}
    got = {r.g: r for r in grouped_percentiles(df, ["g"], "v", {"p95": 0.95}, stats).collect()}
    want = df.groupBy("g").agg(F.count("v").alias("cnt"), F.count(F.lit(1)).alias("rows"), F.avg("v").alias("mean"),
                               F.max("v").alias("top"), F.stddev_samp("v").alias("sd"), F.percentile("v", 0.95).alias("p95"))
    rows = want.collect()
    assert len(rows) == len(got)
    for r in rows:
        for c in ["cnt", "rows", "mean", "top", "sd", "p95"]:
            assert got[r.g][c] is None if r[c] is None else got[r.g][c] == pytest.approx(r[c], rel=1e-9, abs=1e-9, nan_ok=True), (r.g, c)
    assert grouped_percentiles(df.filter("g = 'x'"), ["g"], "v", {"p95": 0.95}, stats).count() == 0
