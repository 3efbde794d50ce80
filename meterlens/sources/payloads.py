"""Decoders for landed JSON payloads (S10, S11): ``from_json`` with declared
schemas, flattened at once; no Python parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEATHER_PAYLOAD = T.StructType([
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()), T.StructField("temp_max", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()), T.StructField("feels_like", T.DoubleType()),
        T.StructField("humidity", T.DoubleType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.DoubleType())])),
    T.StructField("rain", T.StructType([T.StructField("1h", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))),
])

WORLDBANK_ROW = T.StructType([T.StructField("date", T.StringType()),
                              T.StructField("value", T.DoubleType())])


def decode_weather(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Nested weather payload -> flat columns.  Missing ``rain.1h`` -> 0.0;
    wind m/s * 3.6 rounded to 1 decimal; first ``weather`` description."""
    p = F.from_json(F.col(payload), WEATHER_PAYLOAD).alias("_p")
    x = df.select("*", p)
    return x.select(
        *[c for c in df.columns if c != payload],
        F.col("_p.main.temp").alias("avg_temp_c"), F.col("_p.main.temp_max").alias("max_temp_c"),
        F.col("_p.main.temp_min").alias("min_temp_c"), F.col("_p.main.feels_like").alias("feels_like_c"),
        F.col("_p.main.humidity").alias("humidity_pct"),
        F.bround(F.col("_p.wind.speed") * 3.6, 1).alias("wind_speed_kmh"),
        F.col("_p.clouds.all").alias("cloud_cover_pct"),
        F.coalesce(F.col("_p.rain.1h"), F.lit(0.0)).alias("rainfall_mm"),
        F.get(F.col("_p.weather"), 0)["description"].alias("weather_desc"),
        F.col("_p").isNull().alias("malformed"))


def decode_worldbank(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``[meta, rows]`` array -> rows of element 1, NULL values dropped,
    year cast to int, sorted by year."""
    arr = F.from_json(F.col(payload), T.ArrayType(T.StringType()))
    rows = F.from_json(F.get(arr, 1), T.ArrayType(WORLDBANK_ROW))
    x = df.select(F.explode(rows).alias("r"))
    return (x.filter(F.col("r.value").isNotNull())
            .select(F.col("r.date").cast("int").alias("year"),
                    F.col("r.value").alias("per_capita_kwh_wb"),
                    F.lit("World Bank").alias("source"))
            .orderBy("year"))


def decode_props(events: DataFrame) -> DataFrame:
    """Event ``props`` JSON -> typed columns with a declared schema."""
    p = F.from_json("props", "k INT")
    return events.select("event_id", "ts", p["k"].alias("k"),
                         p.isNull().alias("malformed"))
