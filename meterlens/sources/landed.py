"""Folders of landed JSON payloads (S10, S11), read by Spark's own file sources.

``read_payloads`` gives one row per file (or per line of it), ``weather_files``
and ``worldbank_files`` decode them, and ``split_bad`` puts what is no payload
aside.  ``ingest`` does the same for files as they arrive: the file source keeps
the names it has read in the query's checkpoint, and every micro-batch writes
its good and bad rows in folders by batch number, so a repeated batch replaces
its own.  Any path works that Spark reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .payloads import WEATHER_PAYLOAD, decode_weather

Decoder = Callable[[DataFrame], DataFrame]
FILE_COLS = ["file", "modified"]


def read_payloads(spark: SparkSession, folder: str, lines: bool = False, stream: bool = False,
                  name_pattern: str | None = None, name_columns: tuple[str, ...] = (),
                  files_per_trigger: int | None = None) -> DataFrame:
    """payload, file (its name), modified and a column per group of
    ``name_pattern``, a regular expression over the file name (NULL where the
    name does not fit).  ``lines``: a payload a line, empty lines left out.  An
    empty file gives no row: Spark's file sources pass it over."""
    reader = (spark.readStream if stream else spark.read).option("recursiveFileLookup", True)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.schema("value string").option("wholetext", not lines).format("text").load(folder).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"))
    if lines:
        df = df.filter(F.trim("payload") != "")
    if name_pattern:
        fits = F.col("file").rlike(name_pattern)
        df = df.withColumns({c: F.when(fits, F.regexp_extract("file", name_pattern, i))
                             for i, c in enumerate(name_columns, 1)})
    return df


def weather_files(df: DataFrame) -> DataFrame:
    """S11 with a reason (NULL: good): not JSON of the payload's shape, or without
    a temperature, which every observation has."""
    bad = F.from_json("payload", WEATHER_PAYLOAD, {"mode": "PERMISSIVE"})
    reason = (F.when(bad.isNull() | ~F.trim("payload").startswith("{") | F.get_json_object("payload", "$").isNull(), "not a JSON object")
              .when(bad["main"]["temp"].isNull(), "no temperature"))
    return decode_weather(df.withColumns({"reason": reason, "raw": F.col("payload")})).drop("malformed")


def worldbank_files(df: DataFrame) -> DataFrame:
    """S10 per file: rows with year, value and the file they came from; a file
    that is no ``[meta, rows]`` array gives one row with a reason."""
    arr = F.from_json("payload", "array<string>")
    rows = F.from_json(F.get(arr, 1), "array<struct<date: string, value: double>>")
    reason = F.when(rows.isNull(), "not a [meta, rows] array")
    x = df.withColumns({"reason": reason, "raw": F.col("payload"), "r": rows})
    x = x.select(*[c for c in x.columns if c not in ("payload", "r")], F.explode_outer("r").alias("r"))
    x = x.filter(F.col("r.value").isNotNull() | F.col("reason").isNotNull())
    return x.select(*[c for c in x.columns if c != "r"], F.expr("try_cast(r.date AS int)").alias("year"),
                    F.col("r.value").alias("per_capita_kwh_wb"), F.lit("World Bank").alias("source"))


def split_bad(decoded: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows as decoded, and bad ones as (file, modified, reason, payload)."""
    good = decoded.filter(F.col("reason").isNull()).drop("reason", "raw")
    bad = decoded.filter(F.col("reason").isNotNull()).select(*(names or FILE_COLS), "reason", F.col("raw").alias("payload"))
    return good, bad


def ingest(spark: SparkSession, folder: str, job: str, decode: Decoder, files_per_trigger: int | None = None,
           **options) -> tuple[DataFrame, DataFrame]:
    """Decode the files that arrived since the last call; all good and all bad
    rows so far.  ``options`` go to ``read_payloads``."""
    source = read_payloads(spark, folder, stream=True, files_per_trigger=files_per_trigger, **options)

    def step(batch: DataFrame, number: int) -> None:
        for name, rows in zip(("good", "bad"), split_bad(decode(batch))):
            rows.write.mode("overwrite").parquet(f"{job}/{name}/{number}")

    query = (source.writeStream.foreachBatch(step).option("checkpointLocation", f"{job}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    empty = spark.createDataFrame([], source.schema)
    good, bad = split_bad(decode(empty))
    return tuple(spark.read.schema(x.schema).option("recursiveFileLookup", True).parquet(f"{job}/{name}")
                 for name, x in (("good", good), ("bad", bad)))
