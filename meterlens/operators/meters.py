"""Smart-meter operators: extraction filter, cleaning, features, load analytics.

Input schema (canonical names): ``timestamp`` (hourly), ``meter_id``,
``consumer_type``, ``consumption_kwh``, ``voltage_v``, ``power_factor`` and a
unique ``reading_id`` used only to break ties deterministically.

Fixed values that must equal the reference:
  * consumption caps (kWh/hour): Domestic 0-15, Commercial 0-100, Industrial 0-800;
    types outside this table pass through uncapped.
  * voltage bounds 180-260 V (flag computed before the cap); power factor 0-1.
  * demand category: kWh / (rolling 24-row mean + 1e-9) >= 1.5 High, >= 0.8 Normal, else Low.
  * power quality: power factor < 0.85 is low; voltage < 210 is a dip.
  * outage: kWh == 0 or voltage < 180, kept when lasting >= 2 hours.
  * national scale factor: 4,950,000 consumers / 100 sample meters.
  * low power-factor report: hours with PF < 0.85, meters with mean PF < 0.88.
  * peak hours for the peak/off-peak split: 06-08 and 18-21.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.exprs import clip, exact, safe_div, snap
from .quantiles import grouped_percentiles
from .ranking import global_rank
from .sequence import DEFAULT_CHUNK_ROWS, cut_buckets, index_within, rolling_avgs

CONSUMPTION_BOUNDS = {
    "Domestic": (0.0, 15.0),
    "Commercial": (0.0, 100.0),
    "Industrial": (0.0, 800.0),
}
VOLTAGE_MIN, VOLTAGE_MAX = 180.0, 260.0
SCALE = 4_950_000 / 100
SUSPECT_FLAG = "Possible 2-hour outage"  # fixed value

TS, METER, TYPE, KWH, VOLT, PF, RID = (
    "timestamp", "meter_id", "consumer_type", "consumption_kwh", "voltage_v",
    "power_factor", "reading_id")


def _meter_order() -> list[Column]:
    return [F.col(TS), F.col(RID)]


# ---------------------------------------------------------------- S8 / F9 / U1
def readings_in_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive range filter on the raw timestamp (pushed to the scan).

    As in the reference, ``end`` is compared with midnight of that day, so the
    rest of the end day is excluded.
    """
    if start:
        df = df.filter(F.col(TS) >= F.to_timestamp_ntz(F.lit(start)))
    if end:
        df = df.filter(F.col(TS) <= F.to_timestamp_ntz(F.lit(end)))
    return df


def extraction_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(METER).alias("meter_count"),
                  F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"))


# ---------------------------------------------------------------- A1
def meter_registry(df: DataFrame) -> DataFrame:
    return (df.groupBy(METER, TYPE)
            .agg(F.min(TS).alias("first_reading"), F.max(TS).alias("last_reading"),
                 exact(F.avg(KWH)).alias("avg_consumption_kwh"),
                 exact(F.avg(VOLT)).alias("avg_voltage"),
                 exact(F.avg(PF)).alias("avg_power_factor")))


# ---------------------------------------------------------------- F3 / C4 / U3
def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key by an explicit order (pandas keep='first').

    ``row_number() = 1`` plans a WindowGroupLimit before the shuffle, so a task
    sends one row per key however often the key repeats, and columns that a
    query does not use are pruned down to the scan.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_first", first).filter(F.col("_first") == 1).drop("_first")


def _capped_consumption(bounds: dict[str, tuple[float, float]]) -> Column:
    kwh = F.col(KWH)
    out = None
    for ctype, (lo, hi) in bounds.items():
        branch = clip(kwh, lo, hi)
        out = (F.when(F.col(TYPE) == ctype, branch) if out is None
               else out.when(F.col(TYPE) == ctype, branch))
    return kwh if out is None else out.otherwise(kwh)


def clean_meters(df: DataFrame, bounds: dict | None = None, dedupe: bool = True) -> DataFrame:
    """de-duplicate (meter, timestamp), cap per type, flag+cap voltage,
    clip power factor, add time features."""
    bounds = CONSUMPTION_BOUNDS if bounds is None else bounds
    if dedupe:
        df = dedupe_first(df, [METER, TS], [RID])
    v = F.col(VOLT)
    df = df.select(
        *[c for c in df.columns if c not in (KWH, VOLT, PF)],
        _capped_consumption(bounds).alias(KWH),
        clip(v, VOLTAGE_MIN, VOLTAGE_MAX).alias(VOLT),
        clip(PF, 0.0, 1.0).alias(PF),
        F.coalesce((v < VOLTAGE_MIN) | (v > VOLTAGE_MAX), F.lit(False)).alias("voltage_flag"),
    )
    feats = cal.meter_time_features(TS)
    return df.select("*", *[c.alias(n) for n, c in feats.items()])


def outlier_counts(df: DataFrame, bounds: dict | None = None) -> DataFrame:
    """out-of-range counts per consumer type, in one aggregation pass."""
    bounds = CONSUMPTION_BOUNDS if bounds is None else bounds
    lo = hi = None
    for ctype, (a, b) in bounds.items():
        lo = F.when(F.col(TYPE) == ctype, a) if lo is None else lo.when(F.col(TYPE) == ctype, a)
        hi = F.when(F.col(TYPE) == ctype, b) if hi is None else hi.when(F.col(TYPE) == ctype, b)
    kwh, v = F.col(KWH), F.col(VOLT)
    return df.groupBy(TYPE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((kwh < lo) | (kwh > hi)).alias("consumption_outliers"),
        F.count_if((v < VOLTAGE_MIN) | (v > VOLTAGE_MAX)).alias("voltage_outliers"),
        F.count_if((F.col(PF) < 0) | (F.col(PF) > 1)).alias("power_factor_outliers"),
    )


# ---------------------------------------------------------------- C13 / W4 / W5 / C6 / C7
def engineer_features(clean: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Rolling 24/168-reading means, demand category, quality flags, daily deviation.

    The daily mean is a window on (meter, day); the rolling means run over
    chunks of ``chunk_rows`` consecutive readings of a meter with a 167-row halo
    (``sequence.rolling_avgs``), so no task holds a whole hot meter.
    """
    kwh = F.col(KWH)
    cols = clean.columns
    # daily mean first, on (meter, day): the partitioning the row index reuses
    x = clean.withColumn("_day", cal.trunc_ntz("day", TS))
    x = x.withColumn("_daily", F.avg(kwh).over(Window.partitionBy(METER, "_day")))
    x = index_within(x, [METER], TS, [RID], "_idx", bucket_col="_day")
    x = rolling_avgs(x, [METER], "_idx", {"_r24": (KWH, 24), "_r168": (KWH, 168)}, chunk_rows)
    out = x.select(*cols,
                   snap("_r24", 4).alias("rolling_24h_kwh"),
                   snap("_r168", 4).alias("rolling_7d_kwh"),
                   snap(kwh - F.col("_daily"), 4).alias("deviation_from_daily_avg"))
    ratio = kwh / (F.col("rolling_24h_kwh") + F.lit(1e-9))
    return out.select(
        "*",
        F.when(ratio >= 1.5, "High").when(ratio >= 0.8, "Normal").otherwise("Low")
        .alias("demand_category"),
        F.coalesce(F.col(PF) < 0.85, F.lit(False)).alias("low_power_factor"),
        F.coalesce(F.col(VOLT) < 210, F.lit(False)).alias("voltage_dip"),
    )


# ---------------------------------------------------------------- A2 / C2
def hourly_system_load(clean: DataFrame, scale: float = SCALE) -> DataFrame:
    g = (clean.groupBy("date", "hour", TYPE)
         .agg(F.sum(KWH).alias("_kwh"), F.count_distinct(METER).alias("meter_count"),
              F.avg(VOLT).alias("_v"), F.avg(PF).alias("_pf")))
    return g.select(
        "date", "hour", TYPE, exact("_kwh").alias("total_kwh"), "meter_count",
        exact("_v").alias("avg_voltage"), exact("_pf").alias("avg_pf"),
        snap(F.col("_kwh") * F.lit(scale) / 1000, 2).alias("scaled_mwh"),
        cal.fiscal_year("date").alias("fiscal_year"),
        cal.fiscal_quarter("date").alias("fiscal_quarter"),
    )


# ---------------------------------------------------------------- A3
def hourly_load_profile(clean: DataFrame, approx: bool = False) -> DataFrame:
    """Mean, p95, p05 (exact, linear interpolation), sample std and count by
    (type, hour, weekend).  ``approx=True`` uses ``percentile_approx`` (bounded
    memory, approximate)."""
    kwh = F.col(KWH)
    keys = [TYPE, "hour", "is_weekend"]
    if approx:
        g = clean.groupBy(*keys).agg(
            F.avg(kwh).alias("_avg"), F.percentile_approx(kwh, 0.95).alias("_p95"),
            F.percentile_approx(kwh, 0.05).alias("_p05"), F.stddev_samp(kwh).alias("_std"),
            F.count(kwh).alias("sample_count"))
    else:
        g = grouped_percentiles(clean, keys, KWH, {"_p95": 0.95, "_p05": 0.05},
                                {"_avg": "avg", "_std": "std", "sample_count": "count"})
    return g.select(*keys, snap("_avg", 4).alias("avg_kwh"), snap("_p95", 4).alias("p95_kwh"),
                    snap("_p05", 4).alias("p05_kwh"), snap("_std", 4).alias("std_kwh"),
                    "sample_count", cal.day_type("is_weekend").alias("day_type"))


# ---------------------------------------------------------------- A25
def load_profile_sql(clean: DataFrame) -> DataFrame:
    """SQL form of the load profile: NUMERIC (half-up) rounding, exact p90."""
    keys = [TYPE, "hour", "is_weekend"]
    g = grouped_percentiles(clean, keys, KWH, {"_p90": 0.9},
                            {"_avg": "avg", "_max": "max", "sample_count": "rows"})
    return g.select(TYPE, "hour", cal.day_type("is_weekend").alias("day_type"),
                    snap("_avg", 4, "half_up").alias("avg_kwh"),
                    snap("_max", 4, "half_up").alias("peak_kwh"),
                    snap("_p90", 4, "half_up").alias("p90_kwh"), "sample_count")


# ---------------------------------------------------------------- A5
def daily_load_curve(clean: DataFrame) -> DataFrame:
    keys = [TYPE, "hour", "is_weekend"]
    g = grouped_percentiles(clean, keys, KWH, {"_p90": 0.9}, {"_avg": "avg", "max_kwh": "max"})
    return g.select(*keys, exact("_avg").alias("avg_kwh"), "max_kwh", exact("_p90").alias("p90_kwh"),
                    F.col("hour").between(18, 21).alias("is_nea_peak"),
                    cal.hour_label("hour").alias("time_label"))


# ---------------------------------------------------------------- A4
def peak_calendar(clean: DataFrame) -> DataFrame:
    """Daily peak per type; ``peak_hour`` is the hour of the daily maximum
    (earliest reading on ties)."""
    kwh = F.col(KWH)
    g = (clean.groupBy("date", TYPE)
         .agg(exact(F.sum(kwh)).alias("daily_total_kwh"), F.max(kwh).alias("peak_hour_kwh"),
              F.min_by("hour", F.when(kwh.isNotNull(), F.struct(-kwh, F.col(TS), F.col(RID))))
              .alias("peak_hour"),
              exact(F.avg(kwh)).alias("avg_kwh"), exact(F.avg(VOLT)).alias("avg_voltage"),
              exact(F.avg(PF)).alias("avg_pf")))
    return g.select("*", cal.day_name("date").alias("weekday"),
                    cal.iso_week("date").alias("week_number"))


# ---------------------------------------------------------------- A6 / A26
def load_factor_daily(clean: DataFrame) -> DataFrame:
    kwh = F.col(KWH)
    g = (clean.groupBy("date", TYPE)
         .agg(F.avg(kwh).alias("_avg"), F.max(kwh).alias("peak_kwh"), F.sum(kwh).alias("_sum")))
    return g.select("date", TYPE, exact("_avg").alias("avg_kwh"), "peak_kwh",
                    exact("_sum").alias("total_kwh"),
                    snap(safe_div(F.col("_avg"), F.col("peak_kwh")) * 100, 2).alias("load_factor_pct"))


def mean_load_factor(load_factor: DataFrame) -> DataFrame:
    return load_factor.agg(exact(F.avg("load_factor_pct")).alias("avg_load_factor_pct"))


# ---------------------------------------------------------------- A7
def peak_offpeak_ratio(clean: DataFrame) -> DataFrame:
    """Mean kWh by (type, period) pivoted with explicit values (no extra job)."""
    h = F.col("hour")
    period = F.when(h.between(6, 8) | h.between(18, 21), "Peak").otherwise("Off-Peak")
    p = (clean.withColumn("period", period).groupBy(TYPE)
         .pivot("period", ["Peak", "Off-Peak"]).agg(F.avg(KWH)))
    return p.select(TYPE, exact("Peak").alias("peak_avg_kwh"),
                    exact("Off-Peak").alias("offpeak_avg_kwh"),
                    snap(safe_div(F.col("Peak"), F.col("Off-Peak")), 3, "half_even")
                    .alias("peak_to_offpeak_ratio"))


# ---------------------------------------------------------------- A27
def low_power_factor_meters(clean: DataFrame, low: float = 0.85, having: float = 0.88) -> DataFrame:
    pf = F.col(PF)
    g = (clean.groupBy(METER, TYPE)
         .agg(F.avg(pf).alias("_avg"), F.count_if(pf < low).alias("low_pf_hours"),
              F.count(F.lit(1)).alias("total_hours")))
    # compare the 10-decimal value: exact-decimal semantics of the SQL original
    return (g.filter(exact("_avg") < having)
            .select(METER, TYPE, snap("_avg", 4, "half_up").alias("avg_pf"), "low_pf_hours",
                    "total_hours",
                    snap(F.col("low_pf_hours") * 100.0 / F.col("total_hours"), 2, "half_up")
                    .alias("low_pf_pct")))


# ---------------------------------------------------------------- W10
def outage_islands(raw: DataFrame, min_hours: float = 2.0, segment_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Gaps-and-islands outage detection.

    A run of bad readings starts at its first bad row and ends at the first
    good row after it (that row also gives the consumer type); runs still
    open at the end of a meter's data are dropped, and readings without a
    timestamp have no place in the order and are left out.

    Runs that begin and end in one segment, a meter's day or at most
    ``segment_rows`` consecutive readings of a longer one, are found inside it;
    runs that touch a segment's edge are stitched from a table with one row per
    segment, so no task holds a hot meter or a hot day of it.
    """
    bad = F.coalesce((F.col(KWH) == 0) | (F.col(VOLT) < VOLTAGE_MIN), F.lit(False))
    x = raw.filter(F.col(TS).isNotNull()).select(
        METER, TYPE, TS, RID, bad.alias("_bad"), cal.trunc_ntz("day", TS).alias("_day"))
    x = cut_buckets(x, [METER], "_day", [TS, RID], segment_rows)
    day = Window.partitionBy(METER, "_day", "_part").orderBy(*_meter_order())
    x = x.select("*", F.lag("_bad", 1).over(day).alias("_prev"))
    begins = F.when(F.col("_bad") & ~F.col("_prev"), F.col(TS))  # NULL on a segment's first row
    x = x.select("*", begins.alias("_begin"), F.last(begins, ignorenulls=True).over(
        day.rowsBetween(Window.unboundedPreceding, 0)).alias("_open"))
    inside = x.filter(~F.col("_bad") & F.col("_prev") & F.col("_open").isNotNull()).select(
        METER, TYPE, F.col("_open").alias("outage_start"), F.col(TS).alias("outage_end"))

    at = F.struct(TS, RID)
    good = ~F.col("_bad")
    days = x.groupBy(METER, "_day", "_part").agg(
        F.min(TS).alias("_first"), F.max(good).alias("_has_good"),
        F.min_by("_bad", at).alias("_leads_bad"), F.max_by("_bad", at).alias("_ends_bad"),
        F.min_by(F.struct(TYPE, TS), F.when(good, at)).alias("_good"), F.max("_begin").alias("_begin"))
    left_open = F.when(~F.col("_has_good"), F.col("_first")).when(F.col("_ends_bad"), F.col("_begin"))
    order = Window.partitionBy(METER).orderBy("_day", "_part")  # one row per segment
    days = days.select("*", left_open.alias("_left_open"), F.sum(F.col("_has_good").cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)).alias("_seg"))
    # a group: a segment with a good reading and the wholly bad ones after it
    seg = Window.partitionBy(METER, "_seg").orderBy("_day", "_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    days = days.select("*", F.first("_left_open", ignorenulls=True).over(seg).alias("_carry"))
    days = days.select("*", F.lag("_carry", 1).over(order).alias("_since"))
    edges = days.filter(F.col("_has_good") & (F.col("_since").isNotNull() | F.col("_leads_bad"))).select(
        METER, F.col(f"_good.{TYPE}").alias(TYPE), F.coalesce("_since", "_first").alias("outage_start"),
        F.col(f"_good.{TS}").alias("outage_end"))

    hours = F.timestamp_diff("SECOND", F.col("outage_start"), F.col("outage_end")) / 3600.0
    return (inside.unionByName(edges).withColumn("_h", hours).filter(F.col("_h") >= min_hours)
            .select(METER, TYPE, "outage_start", "outage_end", snap("_h", 2).alias("duration_hours")))


# ---------------------------------------------------------------- W11
def outage_suspects(clean: DataFrame) -> DataFrame:
    """Zero reading followed by a zero reading (one row per hit).  The next
    reading is looked up inside (meter, day), and for a day's last reading in a
    table with one row per meter and day."""
    x = clean.filter(F.col(TS).isNotNull()).select(
        METER, TS, RID, KWH, cal.trunc_ntz("day", TS).alias("_day"))
    day = Window.partitionBy(METER, "_day").orderBy(*_meter_order())
    inside = (x.select("*", F.lead(KWH, 1).over(day).alias("_next"))
              .filter((F.col(KWH) == 0) & (F.col("_next") == 0)).select(METER, TS))
    at = F.struct(TS, RID)
    days = x.groupBy(METER, "_day").agg(F.min_by(KWH, at).alias("_first"),
                                        F.max_by(F.struct(KWH, TS), at).alias("_last"))
    order = Window.partitionBy(METER).orderBy("_day")
    edges = (days.select("*", F.lead("_first", 1).over(order).alias("_next"))
             .filter((F.col(f"_last.{KWH}") == 0) & (F.col("_next") == 0))
             .select(METER, F.col(f"_last.{TS}").alias(TS)))
    return inside.unionByName(edges).select(METER, F.col(TS).alias("suspected_outage_start"),
                                            F.lit(SUSPECT_FLAG).alias("flag"))


# ---------------------------------------------------------------- K1
def demand_peaks(raw: DataFrame, top_n: int = 100) -> DataFrame:
    """Top-N readings per meter.  ``row_number() <= N`` plans a
    WindowGroupLimit before the shuffle, so a hot meter sends at most N rows
    per map task."""
    w = Window.partitionBy(METER).orderBy(F.col(KWH).desc(), F.col(TS), F.col(RID))
    return (raw.select(METER, TYPE, TS, KWH, VOLT, PF, F.row_number().over(w).alias("_rn"))
            .filter(F.col("_rn") <= top_n)
            .select(METER, TYPE, TS, F.col(KWH).alias("peak_consumption_kwh"), VOLT, PF))


# ---------------------------------------------------------------- K2
def system_peak_days(clean: DataFrame, top_n: int = 20) -> DataFrame:
    daily = clean.groupBy("date").agg(F.max(KWH).alias("peak_kwh"))
    top = daily.orderBy(F.col("peak_kwh").desc(), F.col("date")).limit(top_n)
    # at most top_n rows remain, so the unpartitioned window is bounded
    w = Window.orderBy(F.col("peak_kwh").desc(), F.col("date"))
    return top.select("date", "peak_kwh", cal.day_name("date").alias("weekday"),
                      F.month("date").alias("month"), F.row_number().over(w).alias("rank"))


# ---------------------------------------------------------------- K3
def peak_hours(clean: DataFrame, top_n: int = 20) -> DataFrame:
    g = (clean.groupBy(TS, TYPE)
         .agg(F.sum(KWH).alias("_kwh"), F.avg(VOLT).alias("_v"), F.avg(PF).alias("_pf")))
    g = g.select(TS, F.to_date(TS).alias("date"), F.hour(TS).alias("hour"), TYPE,
                 snap("_kwh", 2, "half_up").alias("total_kwh"),
                 snap("_v", 2, "half_up").alias("avg_voltage"),
                 snap("_pf", 4, "half_up").alias("avg_pf"))
    return g.orderBy(F.col("total_kwh").desc(), F.col(TS), F.col(TYPE)).limit(top_n)


# ---------------------------------------------------------------- W12
def load_duration_curve(clean: DataFrame, consumer_type: str | None = None,
                        num_partitions: int | None = None) -> DataFrame:
    """Hourly system totals ranked in descending order with exceedance %.

    Uses the distributed ``global_rank`` (range partitioning), never a
    single-partition window.
    """
    df = clean if consumer_type is None else clean.filter(F.col(TYPE) == consumer_type)
    totals = df.groupBy(TS).agg(exact(F.sum(KWH)).alias("_load"))
    ranked = global_rank(totals, [F.col("_load").desc(), F.col(TS)], "rank", "_n",
                         num_partitions=num_partitions)
    return ranked.select(
        "rank", F.col("_load").alias("load_kwh"),
        (F.col("rank") / F.col("_n") * 100).alias("exceedance_pct"),
        F.lit(consumer_type or "All").alias("consumer_type"), TS)
