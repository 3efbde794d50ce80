"""Keyed Parquet tables merged file by file (S16, S17, J9 for facts that grow).

``sinks.write_version`` writes a whole table anew, which suits tables bounded
by the calendar.  A table of facts is kept here as immutable files in folders by
version, and per version a manifest: one row per file and slice of the table
with its key range and row count.  Every file has a Bloom filter of its keys,
stored as rows (file, word, bits) beside it.

A merge finds the files that may hold a key of the batch: an equi-join on the
slice with the key range as residual condition, then an equi-join of the keys'
filter bits with the stored words.  Only those files are read, merged by
``loads.upsert`` and written again; the other files go into the new manifest as
they are.  A filter never misses a key, and a false hit only rewrites a file
more.  The pointer is written last: until then readers see the old version, and
a repeated merge writes over what a failed one left.

One writer at a time; keys are not named like a manifest column.  Key columns that are NULL match nothing, so such rows
are always inserted (one per key and batch).  The driver holds the list of files
to read, as any Spark scan does; nothing else is collected.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.loads import last_per_key, upsert
from .raw import path_exists

BITS_PER_KEY, HASHES = 10, 7  # about 1 % false hits
FILE = ["folder", "file"]  # identifies a data file: version folder and file name


@dataclass(frozen=True)
class Merge:
    """What a merge did; ``version`` stays the same for an empty batch."""

    version: int
    batch_rows: int
    files_before: int
    files_rewritten: int
    rows_read: int


@dataclass(frozen=True)
class KeyedTable:
    """A table folder.  ``slice_by``: SQL expression over the keys that cuts the
    table (a month, a region), so a batch meets only the files of its slices."""

    path: str
    keys: tuple[str, ...]
    slice_by: str
    rows_per_file: int = 1_000_000

    # ------------------------------------------------------------ reading
    def version(self, spark: SparkSession) -> int | None:
        """The newest finished version; None before the first."""
        if not path_exists(spark, f"{self.path}/_pointers"):
            return None
        return self._pointers(spark).agg(F.max("version")).first()[0]

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        v = self.version(spark) if version is None else version
        return self._files(spark, v, self.manifest(spark, v))

    def read_range(self, spark: SparkSession, lo: tuple, hi: tuple, slices: str = "true",
                   version: int | None = None) -> DataFrame:
        """Rows whose leading keys lie between ``lo`` and ``hi`` (inclusive), of the
        slices for which ``slices``, SQL over the column ``slice``, holds.  Only
        files whose manifest ranges meet both are opened, and inside them Parquet's
        own statistics skip row groups, since files are sorted by slice and keys."""
        v = self.version(spark) if version is None else version
        schema, keys = self._schema(spark, v), self.keys[:len(lo)]
        bound = [F.struct(*[F.lit(x).cast(schema[k].dataType).alias(k) for k, x in zip(keys, b)]) for b in (lo, hi)]
        at = [F.struct(*[F.col(f"{end}.{k}").alias(k) for k in keys]) for end in ("lo", "hi")]
        files = self.manifest(spark, v).filter(slices).filter((at[0] <= bound[1]) & (at[1] >= bound[0]))
        rows = self._files(spark, v, files).filter(F.col(keys[0]).between(lo[0], hi[0]))  # reaches the scan
        inside = F.struct(*keys).between(*bound)
        return rows.withColumn("slice", F.expr(self.slice_by)).filter(inside).filter(slices).drop("slice")

    def manifest(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """folder, file, slice, lo, hi, n_rows, bits (of the file's filter)."""
        return spark.read.parquet(f"{self.path}/manifests/{self.version(spark) if version is None else version}")

    def _pointers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("version long, columns string").parquet(f"{self.path}/_pointers/*")

    def _schema(self, spark: SparkSession, version: int) -> T.StructType:
        row = self._pointers(spark).filter(F.col("version") == version).first()
        return T.StructType.fromJson(json.loads(row["columns"]))

    def _files(self, spark: SparkSession, version: int, manifest: DataFrame) -> DataFrame:
        schema = self._schema(spark, version)
        paths = [f"{self.path}/data/{r.folder}/{r.file}" for r in manifest.select(*FILE).distinct().collect()]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    # ------------------------------------------------------------ writing
    def create(self, df: DataFrame) -> int:
        """Version 0 from rows of distinct keys (nothing is checked or dropped)."""
        if self.version(df.sparkSession) is not None:
            raise ValueError(f"{self.path} is a table already")
        if "loaded_at" not in df.columns:
            df = df.withColumn("loaded_at", F.current_timestamp())
        rows = self._land(df, 0)
        self._write(rows, rows.count(), 0)
        self._commit(df.sparkSession, 0, df.schema, None, None)
        return 0

    def merge(self, batch: DataFrame, update_cols: list[str], order: list[Column]) -> Merge:
        """``loads.upsert`` of the batch (last row per key by ``order``) into the
        files that may hold its keys.  Columns the table lacks are left out,
        columns the batch lacks stay NULL in inserted rows."""
        spark = batch.sparkSession
        v = self.version(spark)
        schema, manifest = self._schema(spark, v), self.manifest(spark, v)
        rows = last_per_key(batch, list(self.keys), order)
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema if f.name in batch.columns and f.name != "loaded_at"])
        rows = self._land(rows, v + 1)
        n, before = rows.count(), manifest.select(*FILE).distinct().count()
        if not n:
            return Merge(v, 0, before, 0, 0)
        self._touched(rows, manifest).write.mode("overwrite").parquet(f"{self.path}/touched/{v + 1}")
        touched = spark.read.schema("folder long, file string").parquet(f"{self.path}/touched/{v + 1}")
        hit = manifest.join(touched, FILE, "left_semi")
        stored = hit.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        merged = upsert(self._files(spark, v, hit), rows, list(self.keys), update_cols, [F.lit(0)])
        self._write(merged.select(*schema.names), stored + n, v + 1)
        self._commit(spark, v + 1, schema, manifest, touched)
        return Merge(v + 1, n, before, touched.count(), stored)

    def expire(self, spark: SparkSession, keep: int = 2) -> list[int]:
        """Forget all but the newest ``keep`` versions and delete the files that
        only forgotten ones use; the versions forgotten.  A version's pointer goes
        first and its manifest last, so the next run ends what a broken one began."""
        newest = sorted(r.version for r in self._pointers(spark).select("version").collect())[-max(keep, 1):]
        live = {tuple(r) for v in newest for r in self.manifest(spark, v).select(*FILE).distinct().collect()}
        folders = {folder for folder, _ in live}
        old = sorted(v for v in map(int, self._names(spark, "manifests")) if v < newest[0])
        for v in old:
            self._delete(spark, f"_pointers/{v}")
            dead = {tuple(r) for r in self.manifest(spark, v).select(*FILE).distinct().collect()} - live
            for folder, file in dead:
                self._delete(spark, f"data/{folder}/{file}")
        for name in ("blooms", "data"):
            for v in map(int, self._names(spark, name)):
                if v < newest[0] and v not in folders:
                    self._delete(spark, f"{name}/{v}")
        for v in old:
            for name in ("batches", "touched", "manifests"):
                self._delete(spark, f"{name}/{v}")
        return old

    # ------------------------------------------------------------ parts
    def _land(self, df: DataFrame, version: int) -> DataFrame:
        """``df`` computed once and read back: counting, sampling and writing share it."""
        df.write.mode("overwrite").parquet(f"{self.path}/batches/{version}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.path}/batches/{version}")

    def _write(self, df: DataFrame, n_rows: int, version: int) -> None:
        """Files of about ``rows_per_file`` rows, each a run of (slice, keys).  The
        hash of the row parts rows whose keys are NULL."""
        plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
        at = [F.expr(self.slice_by), *map(F.col, self.keys)]
        (df.repartitionByRange(max(1, ceil(n_rows / self.rows_per_file)), *at, F.xxhash64(*plain))
         .sortWithinPartitions(*at).write.mode("overwrite").parquet(f"{self.path}/data/{version}"))

    def _commit(self, spark: SparkSession, version: int, schema: T.StructType, manifest: DataFrame | None,
                touched: DataFrame | None) -> None:
        """Filters, manifest and, last, the pointer of a written version."""
        bits = max(64, ceil(self.rows_per_file * BITS_PER_KEY / 64) * 64)
        key = F.struct(*self.keys)
        data = spark.read.schema(schema).parquet(f"{self.path}/data/{version}").select(
            F.lit(version).cast("long").alias("folder"), F.col("_metadata.file_name").alias("file"),
            F.expr(self.slice_by).alias("slice"), *self.keys)
        known = data.dropna(subset=list(self.keys)).withColumn("bits", F.lit(bits).cast("long"))
        self._bits(known).groupBy(*FILE, "word").agg(F.bit_or("mask").alias("mask")) \
            .write.mode("overwrite").parquet(f"{self.path}/blooms/{version}")
        files = data.groupBy(*FILE, "slice").agg(
            F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n_rows"), F.lit(bits).cast("long").alias("bits"))
        if manifest is not None:
            files = manifest.join(touched, FILE, "left_anti").unionByName(files)
        files.write.mode("overwrite").parquet(f"{self.path}/manifests/{version}")
        spark.createDataFrame([(version, schema.json())], "version long, columns string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/_pointers/{version}")

    def _bits(self, keyed: DataFrame) -> DataFrame:
        """Every key's ``HASHES`` filter bits (word, mask) in a filter of ``bits`` bits."""
        h1, h2 = (F.pmod(F.xxhash64(*self.keys, *more), F.col("bits")) for more in ((), (F.lit(1),)))
        x = keyed.select("*", h1.alias("_h1"), h2.alias("_h2"), F.explode(F.sequence(F.lit(0), F.lit(HASHES - 1))).alias("_i"))
        at = F.pmod(F.col("_h1") + F.col("_i") * F.col("_h2"), F.col("bits"))
        return x.withColumn("_at", at).select(
            "*", F.expr("_at div 64").alias("word"), F.expr("shiftleft(1L, cast(_at % 64 as int))").alias("mask"))

    def _touched(self, rows: DataFrame, manifest: DataFrame) -> DataFrame:
        """The files that may hold a key of ``rows``."""
        spark, key = rows.sparkSession, F.struct(*self.keys)
        near = rows.dropna(subset=list(self.keys)).select(*self.keys, F.expr(self.slice_by).alias("_slice")).join(
            manifest, F.col("_slice").eqNullSafe(F.col("slice")) & (key >= F.col("lo")) & (key <= F.col("hi")))
        folders = [r.folder for r in manifest.select("folder").distinct().collect()]
        if not folders:
            return manifest.select(*FILE)
        words = spark.read.schema("folder long, file string, word long, mask long").parquet(
            *[f"{self.path}/blooms/{v}" for v in folders]).withColumnRenamed("mask", "set_bits")
        hits = self._bits(near.select(*FILE, *self.keys, "bits")).join(words, [*FILE, "word"]).filter(
            F.col("set_bits").bitwiseAND(F.col("mask")) != 0)
        return (hits.groupBy(*FILE, *self.keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == HASHES)
                .select(*FILE).distinct())

    def _fs(self, spark: SparkSession, name: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path

    def _names(self, spark: SparkSession, name: str) -> list[str]:
        fs, path = self._fs(spark, name)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, spark: SparkSession, name: str) -> None:
        fs, path = self._fs(spark, name)
        fs.delete(path, True)
