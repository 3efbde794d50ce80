"""Load semantics: keyed upsert, duplicate-skipping append, range (as-of) join.

Plain Parquet cannot update in place, so ``upsert`` returns the merged
table as a DataFrame; ``sources.sinks.write_version`` writes it to a new
version directory and never overwrites the path it reads from.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import trunc_ntz


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the last row per key (``order`` ascending; last wins)."""
    down = [o.desc() for o in order]
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*down))
    return df.withColumn("_last", last).filter(F.col("_last") == 1).drop("_last")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           order: list[Column], loaded_at: Column | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols.

    * keys only in ``target`` are kept as they are;
    * keys only in ``source`` are inserted with all their columns;
    * matched keys take ``update_cols`` (and ``loaded_at``) from the source,
      every other column keeps the stored value.
    Duplicate keys inside the batch: the last row by ``order`` wins.
    """
    source = last_per_key(source, keys, order)
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    src = source.withColumn("loaded_at", loaded_at)
    tgt = target if "loaded_at" in target.columns else target.withColumn(
        "loaded_at", F.lit(None).cast(src.schema["loaded_at"].dataType))
    cols = [c for c in tgt.columns if c not in keys]
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in src.columns],
                   F.lit(True).alias("_s_hit"))
    t = tgt.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    j = t.join(s, keys, "full_outer")
    upd = set(update_cols) | {"loaded_at"}
    out = []
    for c in cols:
        has_src = c in src.columns
        if not has_src:
            out.append(F.col(f"_t_{c}").alias(c))
        elif c in upd:
            out.append(F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_t_hit"), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
    action = (F.when(F.col("_t_hit") & F.col("_s_hit"), "updated")
              .when(F.col("_s_hit"), "inserted").otherwise("kept"))
    return j.select(*keys, *out, action.alias("merge_action"))


def append_new_only(target: DataFrame, batch: DataFrame, keys: list[str],
                    order: list[Column]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (row-level skip of
    duplicates), first row per key inside the batch.  Append the result."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    dedup = batch.withColumn("_first", first).filter(F.col("_first") == 1).drop("_first")
    known = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return dedup.join(known, same, "left_anti")


def range_join(facts: DataFrame, ranges: DataFrame, key: str, at: str,
               start: str = "effective_from", end: str = "effective_to",
               bucket: str = "month") -> DataFrame:
    """Effective-dated lookup: fact row matches the range row with the same
    ``key`` and ``start <= at < end`` (``end`` NULL = still active).

    Each range row is replicated once per ``bucket`` period it covers, and
    both sides join on (key, bucket) plus the range condition -- an
    equi-join with many distinct keys instead of a nested loop or a join on a
    handful of hot category keys.  Ranges are expanded only over the periods
    that have facts: one that starts after the last fact is left out, an open or
    far-future end stops there (two scalars, read once).
    """
    first, last = facts.agg(F.min(F.col(at)), F.max(F.col(at))).first()
    b = lambda c: trunc_ntz(bucket, c)
    first, last = (F.lit(x).cast("timestamp_ntz") for x in (first, last))
    lo, hi = F.greatest(F.col(start), first), F.least(F.coalesce(F.col(end), last), last)
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    r = ranges.filter((F.col(start) <= last) & (b(lo) <= b(hi))).withColumn("_bk", F.explode(F.sequence(b(lo), b(hi), step)))
    f = facts.withColumn("_bk", b(F.col(at)))
    cond = ((f[key] == r[key]) & (f["_bk"] == r["_bk"]) & (f[at] >= r[start])
            & (r[end].isNull() | (f[at] < r[end])))
    return f.join(r, cond, "left").drop(r["_bk"]).drop(r[key]).drop(f["_bk"])
