"""Weather operators: cleaning, degree days, monthly aggregation, the
consumption-weather join, correlation, OLS regression, monsoon impact.

Fixed values that must equal the reference:
  * temperature bounds -30..45 C, humidity 0..100 %, rainfall >= 0 (missing = 0).
  * hot day avg >= 30 C, cold day avg <= 5 C, rainy day rainfall > 5 mm.
  * HDD base 18 C, CDD base 24 C; discomfort index T - 0.55 (1 - RH/100)(T - 14.5).
  * temperature-demand index 0.6 * CDD + 0.4 * HDD.
  * correlation strength: |r| > 0.7 Strong, > 0.4 Moderate, else Weak.
  * regression needs at least 10 complete rows.
  * reference station for national weather: "KTM001".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.exprs import clip, exact, safe_div, snap
from .moments import co_moments, least_squares

HDD_BASE, CDD_BASE = 18.0, 24.0
REFERENCE_STATION = "KTM001"
# Weather variables, regression features and the message of a short input.
SHORT_INPUT = "Insufficient data for regression"
CORR_VARS = ["avg_temp_c", "max_temp_c", "avg_humidity_pct", "total_rainfall_mm",
             "total_hdd", "total_cdd", "temp_demand_index"]
OLS_FEATURES = ["avg_temp_c", "total_hdd", "total_cdd", "total_rainfall_mm"]


def degree_days(df: DataFrame) -> DataFrame:
    """HDD/CDD (2 decimals, half-even) and thermal discomfort index."""
    t, rh = F.col("avg_temp_c"), F.col("humidity_pct")
    return df.withColumns({
        "hdd": snap(clip(F.lit(HDD_BASE) - t, 0.0, None), 2),
        "cdd": snap(clip(t - F.lit(CDD_BASE), 0.0, None), 2),
        "thermal_discomfort_index": snap(t - 0.55 * (1 - rh / 100) * (t - 14.5), 2),
    })


def monsoon_flags(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Season variant (b) (December = Post-Monsoon) and monsoon flags."""
    m = F.month(date_col)
    return df.withColumns({
        "season": cal.season_of_month(m, dec_is_winter=False),
        "is_monsoon": cal.is_monsoon(m),
        "is_dry_season": ~cal.is_monsoon(m),
    })


def clean_weather(df: DataFrame) -> DataFrame:
    """bounds, rainfall fill, derived flags, degree days recomputed."""
    df = df.withColumns({
        "max_temp_c": clip("max_temp_c", -30.0, 45.0),
        "min_temp_c": clip("min_temp_c", -30.0, 45.0),
        "avg_temp_c": clip("avg_temp_c", -30.0, 45.0),
        "rainfall_mm": clip(F.coalesce(F.col("rainfall_mm"), F.lit(0.0)), 0.0, None),
        "humidity_pct": clip("humidity_pct", 0.0, 100.0),
    })
    t = F.col("avg_temp_c")
    df = df.withColumns({
        "temp_range_c": snap(F.col("max_temp_c") - F.col("min_temp_c"), 2),
        "is_hot_day": F.coalesce(t >= 30, F.lit(False)),
        "is_cold_day": F.coalesce(t <= 5, F.lit(False)),
        "is_rainy_day": F.coalesce(F.col("rainfall_mm") > 5, F.lit(False)),
        "hdd": snap(clip(F.lit(HDD_BASE) - t, 0.0, None), 2),
        "cdd": snap(clip(t - F.lit(CDD_BASE), 0.0, None), 2),
    })
    return df


def enrich_weather(raw: DataFrame) -> DataFrame:
    """Extraction-stage enrichment then cleaning (the reference's order)."""
    return clean_weather(monsoon_flags(degree_days(raw)))


# ---------------------------------------------------------------- A8 / J1 / C10
def monthly_weather(weather: DataFrame, station: str = REFERENCE_STATION) -> DataFrame:
    """One station's observations by (year, month).  The station filter
    is on a raw column, so it reaches the scan."""
    w = weather.filter(F.col("station_id") == station)
    return (w.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
            .agg(F.avg("avg_temp_c").alias("avg_temp_c"), F.max("max_temp_c").alias("max_temp_c"),
                 F.sum("rainfall_mm").alias("total_rainfall_mm"),
                 F.avg("humidity_pct").alias("avg_humidity_pct"),
                 F.sum("hdd").alias("total_hdd"), F.sum("cdd").alias("total_cdd")))


def consumption_weather(monthly: DataFrame, weather: DataFrame,
                        station: str = REFERENCE_STATION) -> DataFrame:
    """Monthly consumption LEFT JOIN monthly weather on (year, month).

    Both sides are aggregates keyed by calendar month; no hint is given, AQE
    picks a broadcast from the measured size and falls back to a
    sort-merge join beyond its threshold.
    """
    wx = monthly_weather(weather, station)
    wx = wx.select("year", "month", *[exact(c).alias(c) for c in wx.columns[2:]])
    j = monthly.join(wx, ["year", "month"], "left")
    return j.withColumn("temp_demand_index",
                        snap(F.col("total_cdd") * 0.6 + F.col("total_hdd") * 0.4, 2))


def consumption_weather_sql(monthly: DataFrame, weather: DataFrame,
                            station: str = REFERENCE_STATION) -> DataFrame:
    """The SQL form (station test in the ON clause, LEFT JOIN, GROUP BY the
    monthly row), planned as aggregate-then-join: each monthly row matches
    exactly one (year, month) group of station readings, so aggregating the
    big side first gives the same rows while the join input shrinks to one
    row per month instead of every observation shuffled on ~12 keys a year."""
    w = (weather.filter(F.col("station_id") == station)
         .groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
         .agg(F.avg("avg_temp_c").alias("_t"), F.sum("rainfall_mm").alias("_r"),
              F.avg("humidity_pct").alias("_h"), F.sum("hdd").alias("_hdd"),
              F.sum("cdd").alias("_cdd")))
    j = monthly.select("year", "month", "month_name", "total_gwh", "peak_demand_mw") \
        .join(w, ["year", "month"], "left")
    return j.select(
        "year", "month", "month_name", "total_gwh", "peak_demand_mw",
        snap("_t", 2, "half_up").alias("avg_temp_c"),
        snap("_r", 1, "half_up").alias("total_rainfall_mm"),
        snap("_h", 1, "half_up").alias("avg_humidity_pct"),
        snap("_hdd", 2, "half_up").alias("total_hdd"),
        snap("_cdd", 2, "half_up").alias("total_cdd"))


# ---------------------------------------------------------------- A17
def pearson(x: str, y: str):
    """Pearson r with pairwise NULL drop; NULL (not an ANSI error) when either
    side is constant -- where pandas gives NaN."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    den = F.sqrt(F.var_pop(xs) * F.var_pop(ys))
    return F.try_divide(F.covar_pop(xs, ys), F.when(den > 0, den))


def correlations(df: DataFrame, target: str = "total_gwh",
                 variables: list[str] | None = None) -> DataFrame:
    """Pearson r per variable, one aggregation pass, unpivoted to one row
    per variable."""
    vars_ = [v for v in (variables or CORR_VARS) if v in df.columns]
    one = df.agg(*[pearson(v, target).alias(v) for v in vars_])
    long = one.unpivot([], vars_, "weather_variable", "_r")
    r = F.col("_r")
    return long.select(
        "weather_variable", snap(r, 4).alias("correlation_r"),
        F.when(r > 0, "Positive").otherwise("Negative").alias("direction"),
        F.when(F.abs(r) > 0.7, "Strong").when(F.abs(r) > 0.4, "Moderate").otherwise("Weak")
        .alias("strength"),
        exact(F.abs(r)).alias("abs_r")).orderBy(F.col("abs_r").desc_nulls_last(), "weather_variable")


# ---------------------------------------------------------------- A18
def ols_regression(df: DataFrame, target: str = "total_gwh",
                   features: list[str] | None = None, min_rows: int = 10) -> DataFrame:
    """Multi-variable OLS from centred moments.

    One aggregation gives count, means and centred products of (features,
    target); only those k x k numbers reach the driver, where the minimum-norm
    solution over intercept and coefficients is taken.
    """
    spark = df.sparkSession
    feats = [c for c in (features or OLS_FEATURES) if c in df.columns]
    part = co_moments(df, [], [*feats, target]).first()
    n = int(part["n"])
    schema = ("r_squared double, intercept double, n_observations long, error string, "
              + ", ".join(f"coeff_{c} double" for c in feats))
    if n < min_rows:
        return spark.createDataFrame(
            [(None, None, n, SHORT_INPUT, *[None] * len(feats))], schema)
    x, r2 = least_squares(part, target, feats)
    row = spark.createDataFrame([(float(r2), float(x[0]), n, None, *[float(b) for b in x[1:]])], schema)
    return row.select(snap("r_squared", 4).alias("r_squared"), snap("intercept", 4).alias("intercept"),
                      "n_observations", "error", *[snap(f"coeff_{c}", 6).alias(f"coeff_{c}") for c in feats])


# ---------------------------------------------------------------- A15
def monsoon_impact(df: DataFrame) -> DataFrame:
    m = cal.is_monsoon(F.col("month"))
    g = df.agg(F.avg(F.when(m, F.col("total_gwh"))).alias("_mon"),
               F.avg(F.when(~m, F.col("total_gwh"))).alias("_dry"),
               F.avg(F.when(m, F.col("total_rainfall_mm"))).alias("_rain"))
    return g.select(snap("_mon", 3).alias("monsoon_avg_gwh"), snap("_dry", 3).alias("dry_season_avg_gwh"),
                    snap((safe_div(F.col("_mon"), F.col("_dry")) - 1) * 100, 2).alias("monsoon_premium_pct"),
                    snap("_rain", 1).alias("monsoon_avg_rainfall_mm"))
