"""Centred moments against numpy, whole and merged from parts."""

import numpy as np
import pytest

from meterlens.operators import moments as C
from meterlens.operators import weather as W
from meterlens.operators.quantiles import grouped_percentiles


def frame(spark, x, y):
    rows = [("a" if i % 3 else None, int(i % 7), float(p), float(q)) for i, (p, q) in enumerate(zip(x, y))]
    rows += [("a", 3, None, 1.0), ("a", 3, 1.0, None), ("only nulls", 1, None, None), ("one", 1, 5.0, 6.0)]
    return spark.createDataFrame(rows, "g string, day int, x double, y double")


def test_parts_merge_to_the_moments_of_all_rows(spark):
    rng = np.random.default_rng(3)
    x = 1e6 + rng.choice([-0.01, 0.01], 1000) + rng.normal(scale=1e-3, size=1000)
    y = 2e5 - 3 * (x - 1e6) + rng.normal(scale=0.01, size=1000)
    df = frame(spark, x, y)
    parts = C.co_moments(df, ["g", "day"], ["x", "y"])
    for got in (C.merge_moments(parts, ["g"], ["x", "y"]), C.co_moments(df, ["g"], ["x", "y"])):
        rows = {r.g: r for r in got.select("g", "n", "mean_x", C.std_of("x").alias("sd"), C.correlation_of("x", "y").alias("r")).collect()}
        assert set(rows) == {"a", None, "one"}
        for g, at in (("a", np.arange(1000) % 3 != 0), (None, np.arange(1000) % 3 == 0)):
            assert rows[g].n == at.sum() and rows[g].mean_x == pytest.approx(x[at].mean(), rel=1e-14)
            assert rows[g].sd == pytest.approx(x[at].std(ddof=1), rel=1e-7)
            assert rows[g].r == pytest.approx(np.corrcoef(x[at], y[at])[0, 1], rel=1e-7)
        assert rows["one"].sd is None and rows["one"].r is None and rows["one"].n == 1
    merged = C.merge_moments(parts, [], ["x", "y"]).collect()
    assert [r.n for r in merged] == [1001]
    assert C.merge_moments(parts.filter("n < 0"), ["g"], ["x", "y"]).count() == 0


def test_deviation_of_large_values_in_grouped_statistics(spark):
    x = [1e6 + (0.01 if i % 2 else -0.01) for i in range(1000)]
    df = spark.createDataFrame([(1, v) for v in x], "g int, v double")
    got = grouped_percentiles(df, ["g"], "v", {"p50": 0.5}, {"sd": "std"}).first()
    assert got.sd == pytest.approx(np.std(x, ddof=1), rel=1e-9)


@pytest.mark.parametrize("at, spread", [(1e5, 0.5), (1e6, 1.0), (0.0, 1.0)])
def test_regression_on_a_feature_far_from_zero(spark, at, spread):
    rng = np.random.default_rng(5)
    x = at + rng.uniform(-spread, spread, 200)
    y = 7 + 6 * (x - at) + rng.normal(scale=0.05, size=200)
    df = spark.createDataFrame([(float(b), float(a)) for a, b in zip(x, y)], "y double, x double")
    part = C.co_moments(df, [], ["x", "y"]).first()
    beta, r2 = C.least_squares(part, "y", ["x"])
    centred = np.polyfit(x - x.mean(), y, 1)
    assert beta[1] == pytest.approx(centred[0], rel=1e-9)
    assert beta[0] == pytest.approx(centred[1] - centred[0] * x.mean(), rel=1e-9)
    assert r2 == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2, rel=1e-9)
    out = W.ols_regression(df, "y", ["x"]).first()
    assert out.coeff_x == round(float(centred[0]), 6) and out.n_observations == 200


def test_regression_with_constant_and_collinear_features(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=60)
    x = np.column_stack([a, np.full(60, 4.0), 3 * a + 2, rng.normal(size=60)])
    y = 1 + x @ np.array([1.0, 0.5, -0.25, 2.0]) + rng.normal(scale=0.1, size=60)
    names = ["p", "q", "r", "s"]
    df = spark.createDataFrame([(float(t), *map(float, row)) for t, row in zip(y, x)], "y double, p double, q double, r double, s double")
    beta, _ = C.least_squares(C.co_moments(df, [], [*names, "y"]).first(), "y", names)
    want, *_ = np.linalg.lstsq(np.column_stack([np.ones(60), x]), y, rcond=None)
    assert beta == pytest.approx(want, rel=1e-8, abs=1e-9)
