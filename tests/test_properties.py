"""Property checks with small generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlens.operators import meters as M
from meterlens.operators import regions as R
from meterlens.operators import series as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
SECTORS = ["domestic_gwh", "industrial_gwh", "commercial_gwh", "irrigation_gwh", "other_gwh"]


@SETTINGS
@given(st.lists(st.lists(st.floats(0.01, 5000, allow_nan=False), min_size=5, max_size=5),
                min_size=1, max_size=6))
def test_sector_shares_sum_to_100(spark, rows):
    df = spark.createDataFrame([(f"{2000 + i}/{(i + 1) % 100:02d}", *r) for i, r in enumerate(rows)],
                               "fiscal_year string, " + ", ".join(f"{c} double" for c in SECTORS))
    for r in S.sector_breakdown(df).collect():
        total = sum(r[c.replace("_gwh", "_share_pct")] for c in SECTORS)
        assert abs(total - 100.0) <= 0.05 + 1e-9


@SETTINGS
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_gini_in_unit_interval(spark, values):
    df = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(values)], "name string, v double")
    r = R.gini(df, "v", label="name", num_partitions=3).first()
    if sum(values) > 0:
        assert 0.0 <= r.gini_coefficient < 1.0
    else:
        assert r.gini_coefficient is None


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.booleans()), min_size=2, max_size=60))
def test_outage_islands_disjoint_and_ordered(spark, steps):
    t, rows = dt.datetime(2024, 1, 1), []
    for i, (gap, bad) in enumerate(steps):
        t = t + dt.timedelta(hours=gap)
        rows.append((t, "A", "Domestic", 0.0 if bad else 3.0, 230.0, 0.9, i))
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, meter_id string, consumer_type string, "
                                     "consumption_kwh double, voltage_v double, power_factor double, "
                                     "reading_id long")
    isl = sorted((r.outage_start, r.outage_end) for r in M.outage_islands(df).collect())
    for (s1, e1), (s2, e2) in zip(isl, isl[1:]):
        assert s1 < e1 <= s2 < e2
    assert all((e - s).total_seconds() >= 7200 for s, e in isl)
