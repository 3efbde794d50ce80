import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from meterlens.operators import regions as R
from meterlens.operators import series as S
from meterlens.operators import weather as W

ANNUAL = ("fiscal_year string, total_energy_gwh double, domestic_gwh double, industrial_gwh double, "
          "commercial_gwh double, irrigation_gwh double, other_gwh double, peak_demand_mw double, "
          "total_consumers int, per_capita_kwh double, system_loss_pct double, energy_imported_gwh double, "
          "energy_exported_gwh double, installed_capacity_mw double")


def annual_rows(values):
    out = []
    for i, v in enumerate(values):
        fy = f"{2015 + i}/{(16 + i) % 100:02d}"
        out.append((fy, v, v * .4, v * .3, v * .2, v * .05, v * .05, 1000.0 + i, 100 + i, v / 10,
                    20.0 - i, 5.0, 3.0 + i, 900.0 + i))
    return out


def test_annual_summary_yoy_ffill_and_zero(spark):
    df = spark.createDataFrame(annual_rows([100.0, 0.0, 50.0, 60.0]), ANNUAL)
    df = df.withColumn("total_energy_gwh", F.when(F.col("fiscal_year") == "2018/19", None)
                       .otherwise(F.col("total_energy_gwh")))
    s = S.annual_summary(S.clean_annual(df)).orderBy("fiscal_year").collect()
    yoy = [r.total_energy_gwh_yoy_pct for r in s]
    # first row NULL, 100 -> 0 is -100 %, 0 -> 50 divides by zero (NULL), NULL forward-filled -> 0 %
    assert yoy == [None, -100.0, None, 0.0]
    assert s[0].trade_balance_gwh == -2.0


def test_clean_annual_derived(spark):
    df = spark.createDataFrame(annual_rows([3720.0]), ANNUAL).withColumns({
        "energy_imported_gwh": F.lit(1850.0), "energy_exported_gwh": F.lit(320.0),
        "peak_demand_mw": F.lit(1170.0), "system_loss_pct": F.lit(45.0)})
    r = S.clean_annual(df).first()
    assert r.net_energy_gwh == 5250.0 and r.self_sufficiency_ratio == 0.7086
    assert r.load_factor_pct == 36.3 and r.system_loss_pct == 40.0


MONTHLY = ("year int, month int, month_name string, date date, domestic_gwh double, industrial_gwh double, "
           "commercial_gwh double, irrigation_gwh double, other_gwh double, total_gwh double, "
           "peak_demand_mw double, avg_daily_mwh double, load_factor_pct double")


def monthly_rows(spec):
    return [(y, m, "  first month ", dt.date(y, m, 1), 1.0, 1.0, 1.0, 1.0, 1.0, t, 10.0, 1.0, lf)
            for (y, m, t, lf) in spec]


def test_clean_monthly_growth_fill_and_names(spark):
    spec = [(2023, 4, 100.0, 50.0), (2023, 5, None, 120.0), (2023, 6, 110.0, -3.0), (2024, 1, 121.0, 50.0)]
    out = S.clean_monthly(spark.createDataFrame(monthly_rows(spec), MONTHLY)).orderBy("year", "month").collect()
    assert out[1].total_gwh == 5.0                     # filled from components
    assert out[0].growth_rate_pct is None              # first month of its year (starts in April)
    assert out[3].growth_rate_pct is None              # first month of 2024
    assert abs(out[1].growth_rate_pct - (5 / 100 - 1) * 100) < 1e-9
    assert out[2].load_factor_pct == 0.0 and out[0].month_name == "First Month"
    assert [r.season for r in out] == ["Pre-Monsoon", "Pre-Monsoon", "Monsoon", "Winter"]


def test_forecast_matches_polyfit(spark):
    vals = [3720.0, 4770.0, 5560.0, 6340.0, 7010.0, 7320.0, 8210.0, 9300.0, 10250.0]
    fys = [f"{2015 + i}/{(16 + i) % 100:02d}" for i in range(len(vals))]
    df = spark.createDataFrame([("N", f, v) for f, v in zip(fys, vals)] +
                               [("M", f, v * 2) for f, v in zip(reversed(fys), vals)],
                               "series string, fiscal_year string, total_energy_gwh double")
    got = {(r.series, r.fiscal_year): r for r in S.forecast_demand(df).collect()}
    b, a = np.polyfit(np.arange(len(vals)), np.log(vals), 1)
    for i in range(1, 6):
        fy = f"{2023 + i}/{(24 + i) % 100:02d}"
        assert abs(got[("N", fy)].forecast_gwh - round(np.exp(a + b * (len(vals) - 1 + i)), 1)) <= 0.1
    assert got[("N", "2024/25")].growth_assumption_pct == round((np.exp(b) - 1) * 100, 2)
    assert len(got) == 10


def test_national_growth_single_row_and_cagr(spark):
    df = spark.createDataFrame(annual_rows([100.0, 121.0]), ANNUAL)
    g = S.national_growth(df).first()
    assert g.consumption_cagr_pct == 21.0 and g.yoy_growth_pct == 21.0 and g.n_years == 2
    one = S.national_growth(spark.createDataFrame(annual_rows([100.0]), ANNUAL)).first()
    assert one.consumption_cagr_pct is None and one.yoy_growth_pct is None
    zero = S.national_growth(spark.createDataFrame(annual_rows([0.0, 10.0]), ANNUAL)).first()
    assert zero.consumption_cagr_guarded_pct == 0.0


def test_seasonal_profile_keeps_missing_seasons(spark):
    spec = [(2023, 6, 10.0, 50.0), (2023, 7, 20.0, 50.0)]
    out = S.seasonal_profile(S.clean_monthly(spark.createDataFrame(monthly_rows(spec), MONTHLY)))
    got = {r.season: r for r in out.collect()}
    assert set(got) == {"Winter", "Pre-Monsoon", "Monsoon", "Post-Monsoon"}
    assert got["Monsoon"].avg_gwh == 15.0 and got["Winter"].avg_gwh is None


def test_revenue_by_sector_half_even(spark):
    # golden case: 85,982,500,000 NPR -> 85.982 bn (half-even)
    df = spark.createDataFrame([(2023, 85982500000.0, 0.0, 0.0, 0.0, 0.0)],
                               "year int, domestic_revenue_npr double, industrial_revenue_npr double, "
                               "commercial_revenue_npr double, irrigation_revenue_npr double, other_revenue_npr double")
    assert S.revenue_by_sector(df).first().total_revenue_nrs_bn == 85.982


def test_correlations_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1.0), (2.0, 4.0, 5.0, None), (3.0, 6.5, 5.0, 3.0),
                                (4.0, 8.0, 5.0, 4.0)],
                               "total_gwh double, avg_temp_c double, max_temp_c double, total_hdd double")
    got = {r.weather_variable: r for r in W.correlations(df).collect()}
    assert got["max_temp_c"].correlation_r is None
    assert got["total_hdd"].correlation_r == 1.0 and got["total_hdd"].strength == "Strong"
    assert got["avg_temp_c"].correlation_r == round(np.corrcoef([1, 2, 3, 4], [2, 4, 6.5, 8])[0, 1], 4)


def test_ols_matches_lstsq_and_refuses_small(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4))
    x[:, 3] = x[:, 2] * 2  # collinear -> minimum-norm solution
    y = 3 + x @ np.array([1.0, -2.0, 0.5, 0.25]) + rng.normal(scale=0.1, size=30)
    cols = ["avg_temp_c", "total_hdd", "total_cdd", "total_rainfall_mm"]
    df = spark.createDataFrame([(float(yy), *map(float, xx)) for yy, xx in zip(y, x)],
                               "total_gwh double, " + ", ".join(f"{c} double" for c in cols))
    r = W.ols_regression(df).first()
    X = np.column_stack([np.ones(30), x])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert abs(r.intercept - beta[0]) < 1e-3
    for i, c in enumerate(cols):
        assert abs(r[f"coeff_{c}"] - beta[i + 1]) < 1e-4
    assert r.n_observations == 30 and 0.9 < r.r_squared <= 1
    small = W.ols_regression(df.limit(9)).first()
    assert small.error == "Insufficient data for regression"


PROV = ("province_id int, province_name string, households_2021 int, electrification_pct_2021 double, "
        "electricity_consumers_2023 int, annual_consumption_gwh_2023 double, per_capita_kwh_2023 double, "
        "area_sq_km double, system_loss_pct double, transmission_lines_km double, distribution_lines_km double, "
        "installed_capacity_mw_2023 double")


def provinces(spark):
    return spark.createDataFrame([
        (1, "Koshi", 1202457, 94.8, 612450, 1480.0, 297.0, 25905.0, 16.2, 1240.0, 8650.0, 842.0),
        (2, "Madhesh", 1306480, 89.2, 545820, 1210.0, 197.0, 9661.0, 18.9, 680.0, 7840.0, 185.0),
        (3, "Bagmati", 1500000, 98.5, 900000, 3800.0, 620.0, 20300.0, 12.0, 2000.0, 12000.0, 1500.0),
        (4, "Karnali", 300000, 83.7, 90000, 285.0, 170.0, 27984.0, 21.4, 680.0, 3850.0, 60.0),
        (5, "Tie", 300000, 83.7, 90000, 285.0, 170.0, 1000.0, 21.4, 0.0, 0.0, 60.0),
    ], PROV)


def test_ranking_min_method_and_losses(spark):
    p = provinces(spark)
    r = {x.province_name: x for x in R.province_ranking(p).collect()}
    assert r["Karnali"].rank_per_capita == r["Tie"].rank_per_capita == 4
    assert r["Bagmati"].rank_system_loss == 1 and r["Karnali"].rank_system_loss == 4
    l = {x.province_name: x for x in R.system_losses_by_province(p).collect()}
    assert l["Karnali"].estimated_loss_gwh == 60.99 and l["Karnali"].loss_per_km_mwh == 13.46
    assert l["Karnali"].loss_reduction_target_pct == 6.4 and l["Karnali"].potential_saving_gwh == 18.24
    assert l["Tie"].loss_per_km_mwh is None and l["Bagmati"].loss_reduction_target_pct == 0.0
    e = {x.province_name: x for x in R.province_enriched(p, None).collect()}
    assert e["Koshi"].kwh_per_household == 1230.81 and e["Koshi"].consumers_per_km2 == 23.6422


def test_gini_cases(spark):
    df = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 5.0), ("b", "x", 0.0), ("b", "y", 0.0),
                                ("b", "z", 9.0), ("c", "x", None)], "g string, name string, v double")
    got = {r.group_key: r for r in R.gini(df, "v", group="g", label="name", num_partitions=3).collect()}
    assert got["a"].gini_coefficient == 0.0
    vals = np.array([0.0, 0.0, 9.0])
    i = np.arange(1, 4)
    assert got["b"].gini_coefficient == round(((2 * i - 3 - 1) * vals).sum() / (3 * vals.sum()), 4)
    assert got["b"].max_label == "z" and got["b"].ratio_max_to_min is None
    assert "c" not in got


def test_ols_with_a_constant_feature_equals_lstsq(spark):
    import numpy as np

    from meterlens.operators.weather import ols_regression
    r = np.random.default_rng(5)
    a, b = r.normal(20, 4, 40), r.normal(100, 30, 40)
    y = 3 + 0.2 * a - 0.05 * b + r.normal(0, 0.1, 40)
    for c in (np.full(40, 5.0), 2 * a - 1, np.zeros(40), r.normal(size=40)):
        rows = [tuple(map(float, x)) for x in zip(y, a, b, c)]
        df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0)], "total_gwh double, a double, b double, c double")
        got = ols_regression(df, features=["a", "b", "c"]).first()
        want = np.linalg.lstsq(np.column_stack([np.ones(40), a, b, c]), y, rcond=None)[0]
        assert np.allclose([got.intercept, got.coeff_a, got.coeff_b, got.coeff_c], want, atol=6e-5)
        assert got.n_observations == 40


def test_report_year_and_dimension_are_joined_once(spark):
    from meterlens.operators import regions as R
    fact = spark.createDataFrame([(1, "x", y, 100.0, 20.0, 50.0, 200.0, 1000) for y in (2022, 2023)],
                                 "province_id int, province_name string, report_year int, annual_consumption_gwh_2023 double, "
                                 "system_loss_pct double, electrification_pct_2021 double, per_capita_kwh_2023 double, households_2021 int")
    dim = spark.createDataFrame([(1, "East", "Town")], "province_id int, province_name_en string, headquarter string")
    for f in (R.electrification_gap_sql, R.loss_opportunity_sql, R.province_performance_sql):
        assert [r.province_name_en for r in f(fact, dim).collect()] == ["East"]
    loss = R.loss_opportunity_sql(fact, dim).first()
    assert (loss.estimated_loss_gwh, loss.revenue_lost_npr_mn, loss.recoverable_gwh) == (20.0, 180.0, 5.0)
    view = R.province_performance_view(fact, dim).collect()
    assert sorted(r.report_year for r in view) == [2022, 2023] and {r.headquarter for r in view} == {"Town"}
    assert view[0].estimated_revenue_npr_mn == 850.0
