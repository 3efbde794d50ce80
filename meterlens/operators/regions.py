"""Regional (province / district) operators: cleaning, enrichment, rankings,
electrification gap, system losses, inequality.

Province tables are dimension-sized (one row per province and year; their
row count follows geography, not data volume), so the rankings use plain
``rank()`` windows.  The inequality operator also works on raw per-entity
values of any size: its ordering uses the distributed ``rank_within_groups``.

Fixed values that must equal the reference:
  * electrification clip 0-100 %, per-capita >= 0, system loss clip 0-40 %.
  * domestic tariff 8.5 NPR/kWh for revenue potential; average tariff 9 NPR/kWh
    for lost revenue; connection cost 25,000 NPR per household.
  * loss target 15 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, exact, present, safe_div, snap
from .ranking import rank_within_groups

DOMESTIC_TARIFF = 8.5
AVG_TARIFF = 9.0
CONNECTION_COST_NPR = 25_000
LOSS_TARGET = 15.0
# Population extras of J2; measures of the composite rank (and whether low is good).
POP_COLS = ["province_id", "per_capita_income_usd", "gdp_contribution_pct",
            "avg_household_size", "urban_pct", "literacy_rate_pct"]
COMPOSITE = [("per_capita_kwh_2023", False), ("electrification_pct_2021", False),
             ("system_loss_pct", True), ("installed_capacity_mw_2023", False)]


# ---------------------------------------------------------------- F5
def clean_provinces(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "electrification_pct_2021": clip("electrification_pct_2021", 0.0, 100.0),
        "per_capita_kwh_2023": clip("per_capita_kwh_2023", 0.0, None),
        "system_loss_pct": clip("system_loss_pct", 0.0, 40.0),
    })


# ---------------------------------------------------------------- J2 / C9
def province_enriched(province: DataFrame, population: DataFrame | None) -> DataFrame:
    """LEFT JOIN population extras (present columns only), then ratios."""
    merged = province
    if population is not None:
        cols = present(population, POP_COLS)
        if len(cols) > 1 and "province_id" in cols:
            merged = province.join(population.select(*cols), "province_id", "left")
    cons = F.col("annual_consumption_gwh_2023")
    return merged.withColumns({
        "kwh_per_household": snap(safe_div(cons * 1e6, F.col("households_2021")), 2),
        "electrification_gap_pct": snap(100 - F.col("electrification_pct_2021"), 2),
        "consumers_per_km2": snap(safe_div(F.col("electricity_consumers_2023"),
                                           F.col("area_sq_km")), 4),
        "estimated_revenue_npr_mn": snap(cons * 1e6 * DOMESTIC_TARIFF / 1e6, 2),
    })


# ---------------------------------------------------------------- W7
def province_ranking(df: DataFrame) -> DataFrame:
    """Four min-method ranks: loss ascending, the rest descending."""
    spec = {"per_capita_kwh_2023": ("rank_per_capita", False),
            "annual_consumption_gwh_2023": ("rank_consumption", False),
            "electrification_pct_2021": ("rank_electrification", False),
            "system_loss_pct": ("rank_system_loss", True)}
    out = df
    for c, (name, asc) in spec.items():
        o = F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
        out = out.withColumn(name, F.rank().over(Window.orderBy(o)))
    return out


# ---------------------------------------------------------------- J3
def with_province_dimension(fact: DataFrame, dim: DataFrame, report_year: int | None = None) -> DataFrame:
    """Facts of one report year (all years if None) with the dimension's columns."""
    f = fact if report_year is None else fact.filter(F.col("report_year") == report_year)
    return f.drop("province_name").join(dim, "province_id")


def _estimated(name: str):
    """Stored estimates of the fact table: lost energy, its value, revenue."""
    cons, loss = F.col("annual_consumption_gwh_2023"), F.col("system_loss_pct")
    return {
        "estimated_loss_gwh": snap(cons * loss / 100, 2),
        "revenue_lost_npr_mn": snap(snap(cons * loss / 100, 3) * 1e6 * AVG_TARIFF / 1e6, 2),
        "estimated_revenue_npr_mn": snap(cons * 1e6 * DOMESTIC_TARIFF / 1e6, 2),
    }[name].alias(name)


# ---------------------------------------------------------------- W9
def province_performance_sql(fact: DataFrame, dim: DataFrame, report_year: int = 2023) -> DataFrame:
    """Fact JOIN province dimension for one report year, with three ranks."""
    j = with_province_dimension(fact, dim, report_year)
    return j.select(
        "province_name_en", F.col("electrification_pct_2021").alias("electrification_pct"),
        F.col("per_capita_kwh_2023").alias("per_capita_kwh"),
        F.col("annual_consumption_gwh_2023").alias("annual_consumption_gwh"), "system_loss_pct",
        _estimated("estimated_loss_gwh"), _estimated("estimated_revenue_npr_mn"),
        # PostgreSQL null order: NULLs sort as the largest value
        F.rank().over(Window.orderBy(F.col("per_capita_kwh_2023").desc_nulls_first()))
        .alias("rank_per_capita"),
        F.rank().over(Window.orderBy(F.col("electrification_pct_2021").desc_nulls_first()))
        .alias("rank_electrification"),
        F.rank().over(Window.orderBy(F.col("system_loss_pct").asc_nulls_last()))
        .alias("rank_efficiency")).orderBy(F.col("annual_consumption_gwh").desc_nulls_first(), "province_name_en")


# ---------------------------------------------------------------- J6
def province_performance_view(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Every report year's facts with the dimension; ranks within a year."""
    j = with_province_dimension(fact, dim)
    w = Window.partitionBy("report_year")
    return j.select(
        "province_name_en", "headquarter", "report_year",
        F.col("annual_consumption_gwh_2023").alias("annual_consumption_gwh"),
        F.col("per_capita_kwh_2023").alias("per_capita_kwh"),
        F.col("electrification_pct_2021").alias("electrification_pct"), "system_loss_pct",
        F.rank().over(w.orderBy(F.col("per_capita_kwh_2023").desc_nulls_last())).alias("rank_per_capita"),
        F.rank().over(w.orderBy(F.col("electrification_pct_2021").desc_nulls_last())).alias("rank_electrification"),
        _estimated("estimated_revenue_npr_mn"))


# ---------------------------------------------------------------- W8
def composite_rank(df: DataFrame) -> DataFrame:
    spec = [(c, a) for c, a in COMPOSITE if c in df.columns]
    out = df
    names = []
    for c, asc in spec:
        o = F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
        out = out.withColumn(f"rank_{c}", F.rank().over(Window.orderBy(o)))
        names.append(f"rank_{c}")
    score = sum(F.col(n) for n in names) / len(names)
    out = out.withColumn("composite_score", snap(score, 2))
    out = out.withColumn("overall_rank",
                         F.rank().over(Window.orderBy(F.col("composite_score").asc_nulls_last())))
    return out.select("province_name", "overall_rank", "composite_score", *names) \
        .orderBy("overall_rank", "province_name")


# ---------------------------------------------------------------- W13 / W14 / F17
def electrification_gap(df: DataFrame) -> DataFrame:
    elec = F.col("electrification_pct_2021")
    unserved = F.bround(F.col("households_2021") * (1 - elec / 100), 0).cast("long")
    # Unweighted mean over the dimension-sized province table
    mean = F.avg(elec).over(Window.partitionBy())
    return df.select(
        "province_name", "province_id", "electrification_pct_2021",
        unserved.alias("unelectrified_households"),
        snap(unserved * CONNECTION_COST_NPR / 1_000_000, 2).alias("est_connection_cost_npr_mn"),
        snap(elec - mean, 2).alias("gap_vs_national_avg_pp")) \
        .orderBy(F.col("unelectrified_households").desc_nulls_last(), "province_id")


def electrification_gap_sql(fact: DataFrame, dim: DataFrame, report_year: int = 2023) -> DataFrame:
    """F17 over J3: one report year's facts with the dimension's names."""
    elec = F.col("electrification_pct_2021")
    raw = F.col("households_2021") * (1 - elec / 100)
    return with_province_dimension(fact, dim, report_year).select(
        "province_name_en", elec.alias("electrification_pct"), F.col("households_2021").alias("households"),
        snap(raw, 0, "half_up").cast("int").alias("unelectrified_hh"),
        snap(raw * 25000 / 1000000, 2, "half_up").alias("est_connection_cost_npr_mn")) \
        .orderBy(F.col("unelectrified_hh").desc_nulls_first(), "province_name_en")


# ---------------------------------------------------------------- A10 / W15 / F18
def system_losses_by_province(df: DataFrame) -> DataFrame:
    cons, loss = F.col("annual_consumption_gwh_2023"), F.col("system_loss_pct")
    lines = F.col("transmission_lines_km") + F.col("distribution_lines_km")
    out = df.select("province_id", "province_name", "annual_consumption_gwh_2023",
                    "system_loss_pct", "transmission_lines_km", "distribution_lines_km",
                    snap(cons * loss / 100, 2).alias("estimated_loss_gwh"))
    out = out.withColumns({
        "loss_per_km_mwh": snap(safe_div(F.col("estimated_loss_gwh") * 1000, lines), 2),
        "loss_reduction_target_pct": snap(clip(loss - LOSS_TARGET, 0.0, None), 2),
    })
    return out.withColumn("potential_saving_gwh",
                          snap(cons * F.col("loss_reduction_target_pct") / 100, 2)) \
        .orderBy(F.col("estimated_loss_gwh").desc_nulls_last(), "province_id")


def system_losses_analysis(df: DataFrame) -> DataFrame:
    cons, loss = F.col("annual_consumption_gwh_2023"), F.col("system_loss_pct")
    out = df.select("province_name", "system_loss_pct",
                    snap(cons * loss / 100, 3).alias("energy_lost_gwh"),
                    snap(cons * clip(loss - LOSS_TARGET, 0.0, None) / 100, 3).alias("recoverable_gwh"))
    return out.withColumns({
        "revenue_lost_npr_mn": snap(F.col("energy_lost_gwh") * 1e6 * AVG_TARIFF / 1e6, 2),
        "recoverable_revenue_npr_mn": snap(F.col("recoverable_gwh") * 1e6 * AVG_TARIFF / 1e6, 2),
    }).orderBy(F.col("energy_lost_gwh").desc_nulls_last(), "province_name")


def loss_opportunity_sql(fact: DataFrame, dim: DataFrame, report_year: int = 2023) -> DataFrame:
    """F18 over J3: one report year's facts with the dimension's names."""
    cons, loss = F.col("annual_consumption_gwh_2023"), F.col("system_loss_pct")
    excess = F.greatest(F.lit(0.0), loss - LOSS_TARGET)
    return with_province_dimension(fact, dim, report_year).select(
        "province_name_en", "system_loss_pct", _estimated("estimated_loss_gwh"), _estimated("revenue_lost_npr_mn"),
        exact(excess).alias("excess_loss_pp"),
        snap(cons * excess / 100, 3, "half_up").alias("recoverable_gwh"),
        snap(cons * excess / 100 * 9, 2, "half_up").alias("recoverable_npr_mn")) \
        .orderBy(F.col("system_loss_pct").desc_nulls_first(), "province_name_en")


# ---------------------------------------------------------------- A19
def gini(df: DataFrame, value: str, group: str | None = None,
         label: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Gini = sum((2i - n - 1) x_i) / (n sum x) over ascending non-null values,
    per group (or overall), plus argmax/argmin label, max/min ratio and mean.

    Ranks come from ``rank_within_groups`` (range-partitioned), so a group
    holding a third of all rows is still spread over many tasks.
    """
    g = group or "_all"
    x = df.filter(F.col(value).isNotNull())
    if group is None:
        x = x.withColumn(g, F.lit("All"))
    lab = label or value
    x = x.select(*dict.fromkeys([g, value, lab]))  # the stored cut holds no other column
    order = [F.col(value)] + ([F.col(label)] if label else [])
    ranked = rank_within_groups(x, [g], order, "_i", "_n", num_partitions=num_partitions)
    i, n, v = F.col("_i"), F.col("_n"), F.col(value)
    agg = ranked.groupBy(g).agg(
        F.sum((2 * i - n - 1) * v).alias("_num"), F.sum(v).alias("_sum"),
        F.first("_n").alias("n"),
        F.max(v).alias("max_value"), F.min(v).alias("min_value"), F.avg(v).alias("_avg"),
        F.min_by(F.col(lab), F.struct(-v, *order[1:])).alias("max_label"),
        F.min_by(F.col(lab), F.struct(v, *order[1:])).alias("min_label"))
    return agg.select(
        F.col(g).alias("group_key"), "n", "max_label", "max_value", "min_label", "min_value",
        snap(safe_div(F.col("max_value"), F.col("min_value")), 2).alias("ratio_max_to_min"),
        snap(safe_div(F.col("_num"), F.col("n") * F.col("_sum")), 4).alias("gini_coefficient"),
        snap("_avg", 1).alias("mean_value"))
