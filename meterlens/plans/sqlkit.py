"""Helpers that spell the engine's rounding/clipping rules in DuckDB SQL.

Used only to build the independent oracle queries (``oracle_sql``).
"""

from __future__ import annotations


def snap(expr: str, digits: int, mode: str = "half_even") -> str:
    fn = "round_even" if mode == "half_even" else "round"
    return f"CAST({fn}(TRY_CAST(({expr}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def exact(expr: str) -> str:
    return f"CAST(TRY_CAST(({expr}) AS DECIMAL(38,10)) AS DOUBLE)"


def clip(expr: str, lo=None, hi=None) -> str:
    parts = [f"WHEN ({expr}) IS NULL OR isnan({expr}) THEN NULL"]
    if lo is not None:
        parts.append(f"WHEN ({expr}) < {float(lo)!r} THEN {float(lo)!r}")
    if hi is not None:
        parts.append(f"WHEN ({expr}) > {float(hi)!r} THEN {float(hi)!r}")
    return f"CAST(CASE {' '.join(parts)} ELSE ({expr}) END AS DOUBLE)"


def fiscal_year(d: str) -> str:
    start = (f"(CASE WHEN month({d}) > 7 OR (month({d}) = 7 AND day({d}) >= 17) "
             f"THEN year({d}) ELSE year({d}) - 1 END)")
    return (f"(CAST({start} AS VARCHAR) || '/' || "
            f"lpad(CAST(({start} + 1) % 100 AS VARCHAR), 2, '0'))")


def fiscal_quarter(d: str) -> str:
    return (f"(CASE WHEN month({d}) BETWEEN 7 AND 9 THEN 'Q1' "
            f"WHEN month({d}) BETWEEN 10 AND 12 THEN 'Q2' "
            f"WHEN month({d}) BETWEEN 1 AND 3 THEN 'Q3' ELSE 'Q4' END)")


def season(m: str, dec_is_winter: bool = True) -> str:
    post = "10 AND 11" if dec_is_winter else "10 AND 12"
    return (f"(CASE WHEN {m} BETWEEN 3 AND 5 THEN 'Pre-Monsoon' "
            f"WHEN {m} BETWEEN 6 AND 9 THEN 'Monsoon' "
            f"WHEN {m} BETWEEN {post} THEN 'Post-Monsoon' ELSE 'Winter' END)")


def day_name(d: str) -> str:
    return f"dayname({d})"


# Stand-in views (same derivations as meterlens.sources.tables) -------------

METER_VIEW = """
meter AS (
  SELECT date_trunc('hour', ts) AS "timestamp",
         user_id AS meter_id,
         event_type AS consumer_type,
         CASE WHEN value < 5.0 THEN 0.0 ELSE value END AS consumption_kwh,
         CAST(170.0 AS DOUBLE) + CAST(json_extract_string(props, '$.k') AS INTEGER) AS voltage_v,
         CAST(0.75 AS DOUBLE) + (CAST(json_extract_string(props, '$.k') AS INTEGER) % 26)
             / CAST(100.0 AS DOUBLE) AS power_factor,
         ts AS read_at,
         event_id AS reading_id
  FROM events
)"""

_BOUNDS = {"click": (0.0, 15.0), "view": (0.0, 100.0), "purchase": (0.0, 800.0)}


def _capped_kwh() -> str:
    whens = " ".join(
        f"WHEN consumer_type = '{t}' THEN {clip('consumption_kwh', lo, hi)}"
        for t, (lo, hi) in _BOUNDS.items())
    return f"CASE {whens} ELSE consumption_kwh END"


CLEAN_VIEW = METER_VIEW + """,
dedup AS (
  SELECT * FROM meter
  QUALIFY row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY reading_id) = 1
),
clean AS (
  SELECT "timestamp", meter_id, consumer_type, read_at, reading_id,
         """ + _capped_kwh() + """ AS consumption_kwh,
         """ + clip("voltage_v", 180.0, 260.0) + """ AS voltage_v,
         """ + clip("power_factor", 0.0, 1.0) + """ AS power_factor,
         COALESCE(voltage_v < 180.0 OR voltage_v > 260.0, false) AS voltage_flag,
         CAST(hour("timestamp") AS INTEGER) AS hour,
         CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
         CAST("timestamp" AS DATE) AS date,
         isodow("timestamp") IN (6, 7) AS is_weekend,
         hour("timestamp") BETWEEN 18 AND 21 AS is_evening_peak,
         hour("timestamp") BETWEEN 6 AND 8 AS is_morning_peak,
         (hour("timestamp") BETWEEN 18 AND 21) OR (hour("timestamp") BETWEEN 6 AND 8) AS is_peak_hour
  FROM dedup
)"""


def with_views(views: str, body: str) -> str:
    return f"WITH {views}\n{body}"


_PRIO = [("1-URGENT", "domestic"), ("2-HIGH", "industrial"), ("3-MEDIUM", "commercial"),
         ("4-NOT SPECIFIED", "irrigation"), ("5-LOW", "other")]


def _sector_sums() -> str:
    return ",\n".join(
        f"    {snap(f'sum(CASE WHEN o_orderpriority = {p!r} THEN o_totalprice ELSE 0.0 END) / 1e6', 6)} AS {s}_gwh"
        for p, s in _PRIO)


MONTHLY_RAW = """
monthly_g AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
""" + _sector_sums() + f""",
    {snap('sum(o_totalprice) / 1e6', 6)} AS total_gwh,
    {snap('max(o_totalprice) / 1e3', 6)} AS peak_demand_mw,
    {snap('avg(o_totalprice) / max(o_totalprice) * 100', 6)} AS load_factor_pct
  FROM orders GROUP BY 1, 2
),
monthly_raw AS (
  SELECT year, month, strftime(make_date(year, month, 1), '%B') AS month_name,
         make_date(year, month, 1) AS date,
         domestic_gwh, industrial_gwh, commercial_gwh, irrigation_gwh, other_gwh,
         total_gwh, peak_demand_mw,
         {snap('total_gwh * 1000 / day(last_day(make_date(year, month, 1)))', 6)} AS avg_daily_mwh,
         load_factor_pct
  FROM monthly_g
)"""

# clean_monthly (F2): total fill, load-factor clip, season, name, MoM growth
MONTHLY_VIEW = MONTHLY_RAW + f""",
monthly_c AS (
  SELECT year, month, upper(substr(trim(month_name), 1, 1)) || lower(substr(trim(month_name), 2)) AS month_name, date,
         domestic_gwh, industrial_gwh, commercial_gwh, irrigation_gwh, other_gwh,
         COALESCE(total_gwh, domestic_gwh + industrial_gwh + commercial_gwh + irrigation_gwh + other_gwh) AS total_gwh,
         peak_demand_mw, avg_daily_mwh,
         {clip('load_factor_pct', 0.0, 100.0)} AS load_factor_pct,
         {season('month')} AS season
  FROM monthly_raw
),
monthly_f AS (
  SELECT *, last_value(total_gwh IGNORE NULLS) OVER (ORDER BY year, month ROWS UNBOUNDED PRECEDING) AS _f
  FROM monthly_c
),
monthly AS (
  SELECT year, month, month_name, date, domestic_gwh, industrial_gwh, commercial_gwh, irrigation_gwh,
         other_gwh, total_gwh, peak_demand_mw, avg_daily_mwh, load_factor_pct, season,
         CASE WHEN month = min(month) OVER (PARTITION BY year) THEN NULL
              ELSE {exact('(_f / NULLIF(lag(_f) OVER (ORDER BY year, month), 0) - 1) * 100')} END AS growth_rate_pct
  FROM monthly_f
)"""

ANNUAL_RAW = """
annual_g AS (
  SELECT """ + fiscal_year("o_orderdate") + """ AS fiscal_year,
""" + f"""    {snap('sum(o_totalprice) / 1e6', 6)} AS total_energy_gwh,
""" + _sector_sums() + f""",
    {snap('max(o_totalprice) / 1e3', 6)} AS peak_demand_mw,
    CAST(count(DISTINCT o_custkey) AS INTEGER) AS total_consumers,
    {snap("sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0.0 END) * 100 / sum(o_totalprice)", 6)} AS system_loss_pct,
    {snap("sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END) / 1e7", 6)} AS energy_imported_gwh,
    {snap("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END) / 1e7", 6)} AS energy_exported_gwh,
    {snap('max(o_totalprice) / 1e3 * 1.5', 6)} AS installed_capacity_mw
  FROM orders GROUP BY 1
),
annual_raw AS (
  SELECT fiscal_year, total_energy_gwh, domestic_gwh, industrial_gwh, commercial_gwh, irrigation_gwh,
         other_gwh, peak_demand_mw, total_consumers,
         {snap('total_energy_gwh * 1e6 / total_consumers', 6)} AS per_capita_kwh,
         system_loss_pct, energy_imported_gwh, energy_exported_gwh, installed_capacity_mw
  FROM annual_g
)"""

_GWH = ["total_energy_gwh", "domestic_gwh", "industrial_gwh", "commercial_gwh", "irrigation_gwh",
        "other_gwh", "energy_imported_gwh", "energy_exported_gwh"]

# clean_annual (F1)
ANNUAL_VIEW = ANNUAL_RAW + """,
annual_c AS (
  SELECT trim(fiscal_year) AS fiscal_year,
""" + ",\n".join(f"    {clip(c, 0.0)} AS {c}" for c in _GWH) + f""",
    peak_demand_mw, total_consumers, per_capita_kwh,
    {clip('system_loss_pct', 0.0, 40.0)} AS system_loss_pct, installed_capacity_mw
  FROM annual_raw
),
annual_n AS (
  SELECT *, {snap('total_energy_gwh + energy_imported_gwh - energy_exported_gwh', 2)} AS net_energy_gwh
  FROM annual_c
),
annual AS (
  SELECT *, {snap('total_energy_gwh / NULLIF(net_energy_gwh, 0)', 4)} AS self_sufficiency_ratio,
         {snap('total_energy_gwh * 1000 / NULLIF(peak_demand_mw * 8760, 0) * 100', 2)} AS load_factor_pct
  FROM annual_n
)"""

WEATHER_VIEW = f"""
wx_raw AS (
  SELECT CAST(l_shipdate AS DATE) AS date, 'ST-' || l_returnflag AS station_id,
         {exact('(l_quantity - CAST(12.0 AS DOUBLE)) + l_tax * 100')} AS max_temp_c,
         {exact('(l_quantity - CAST(12.0 AS DOUBLE)) - l_discount * 100')} AS min_temp_c,
         l_quantity - CAST(12.0 AS DOUBLE) AS avg_temp_c,
         {exact('l_discount * 1000')} AS humidity_pct,
         CASE WHEN l_linestatus = 'O' THEN {exact('l_extendedprice / 1000')} END AS rainfall_mm
  FROM lineitem
),
wx_c AS (
  SELECT date, station_id,
         {clip('max_temp_c', -30.0, 45.0)} AS max_temp_c,
         {clip('min_temp_c', -30.0, 45.0)} AS min_temp_c,
         {clip('avg_temp_c', -30.0, 45.0)} AS avg_temp_c,
         {clip('COALESCE(rainfall_mm, CAST(0.0 AS DOUBLE))', 0.0)} AS rainfall_mm,
         {clip('humidity_pct', 0.0, 100.0)} AS humidity_pct,
         {snap('avg_temp_c - CAST(0.55 AS DOUBLE) * (1 - humidity_pct / 100) * (avg_temp_c - CAST(14.5 AS DOUBLE))', 2)} AS thermal_discomfort_index,
         {season('month(date)', dec_is_winter=False)} AS season,
         month(date) BETWEEN 6 AND 9 AS is_monsoon,
         NOT (month(date) BETWEEN 6 AND 9) AS is_dry_season
  FROM wx_raw
),
weather AS (
  SELECT *, {snap('max_temp_c - min_temp_c', 2)} AS temp_range_c,
         COALESCE(avg_temp_c >= 30, false) AS is_hot_day,
         COALESCE(avg_temp_c <= 5, false) AS is_cold_day,
         COALESCE(rainfall_mm > 5, false) AS is_rainy_day,
         {snap(clip('CAST(18.0 AS DOUBLE) - avg_temp_c', 0.0), 2)} AS hdd,
         {snap(clip('avg_temp_c - CAST(24.0 AS DOUBLE)', 0.0), 2)} AS cdd
  FROM wx_c
)"""

JOINED_VIEW = MONTHLY_VIEW + "," + WEATHER_VIEW + f""",
mwx AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         {exact('avg(avg_temp_c)')} AS avg_temp_c, {exact('max(max_temp_c)')} AS max_temp_c,
         {exact('sum(rainfall_mm)')} AS total_rainfall_mm, {exact('avg(humidity_pct)')} AS avg_humidity_pct,
         {exact('sum(hdd)')} AS total_hdd, {exact('sum(cdd)')} AS total_cdd
  FROM weather WHERE station_id = 'ST-N' GROUP BY 1, 2
),
joined AS (
  SELECT m.*, w.avg_temp_c, w.max_temp_c, w.total_rainfall_mm, w.avg_humidity_pct, w.total_hdd, w.total_cdd,
         {snap('w.total_cdd * 0.6 + w.total_hdd * 0.4', 2)} AS temp_demand_index
  FROM monthly m LEFT JOIN mwx w USING (year, month)
)"""

PROVINCE_VIEW = f"""
p_cust AS (SELECT c_nationkey AS province_id, count(*) AS n_cust,
                  count(*) FILTER (WHERE c_acctbal > 0) AS n_pos FROM customer GROUP BY 1),
p_supp AS (SELECT s_nationkey AS province_id, count(*) AS n_supp, avg(s_acctbal) AS avg_bal
           FROM supplier GROUP BY 1),
p_per_supp AS (SELECT l_suppkey, sum(l_extendedprice) AS rev, max(l_extendedprice) AS mx
               FROM lineitem GROUP BY 1),
p_cons AS (SELECT s_nationkey AS province_id,
                  {snap('sum(rev) / 1e6', 6)} AS annual_consumption_gwh_2023,
                  {snap('max(mx) / 1e3', 6)} AS peak_demand_mw_2023
           FROM p_per_supp JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
province_raw AS (
  SELECT n_nationkey AS province_id, n_name AS province_name, n_regionkey AS region_id,
         CAST(1000.0 AS DOUBLE) + n_nationkey * CAST(500.0 AS DOUBLE) AS area_sq_km,
         CAST(COALESCE(n_cust, 0) * 1000 AS INTEGER) AS population_2021,
         CAST(COALESCE(n_cust, 0) * 200 AS INTEGER) AS households_2021,
         {snap('CAST(n_pos AS DOUBLE) * 100.0 / NULLIF(n_cust, 0)', 6)} AS electrification_pct_2021,
         CAST(COALESCE(n_pos, 0) * 150 AS INTEGER) AS electricity_consumers_2023,
         annual_consumption_gwh_2023,
         {snap('annual_consumption_gwh_2023 * 1e6 / NULLIF(n_cust * 1000, 0)', 6)} AS per_capita_kwh_2023,
         peak_demand_mw_2023,
         CAST(COALESCE(n_supp, 0) AS DOUBLE) * 100.0 AS transmission_lines_km,
         CAST(COALESCE(n_cust, 0) AS DOUBLE) * 10.0 AS distribution_lines_km,
         {snap('CAST(10.0 AS DOUBLE) + avg_bal / 400.0', 6)} AS system_loss_pct,
         2023 AS report_year,
         CAST(COALESCE(n_supp, 0) AS DOUBLE) * 50.0 AS installed_capacity_mw_2023
  FROM nation
  LEFT JOIN p_cust ON n_nationkey = p_cust.province_id
  LEFT JOIN p_supp ON n_nationkey = p_supp.province_id
  LEFT JOIN p_cons ON n_nationkey = p_cons.province_id
),
province AS (
  SELECT * REPLACE (
    {clip('electrification_pct_2021', 0.0, 100.0)} AS electrification_pct_2021,
    {clip('per_capita_kwh_2023', 0.0)} AS per_capita_kwh_2023,
    {clip('system_loss_pct', 0.0, 40.0)} AS system_loss_pct)
  FROM province_raw
)"""

# the same facts for two report years; the earlier one with a tenth less consumption
PROVINCE_YEARS_VIEW = PROVINCE_VIEW + f""",
province_years AS (
  SELECT * FROM province
  UNION ALL
  SELECT * REPLACE (2022 AS report_year, {snap('annual_consumption_gwh_2023 * 0.9', 6)} AS annual_consumption_gwh_2023) FROM province
)"""

POPULATION_VIEW = f"""
population AS (
  SELECT c_nationkey AS province_id, {snap('avg(c_acctbal)', 6)} AS per_capita_income_usd,
         {snap("CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS DOUBLE) * 100.0 / count(*)", 6)} AS urban_pct,
         {snap('CAST(count(*) FILTER (WHERE c_acctbal > 1000) AS DOUBLE) * 100.0 / count(*)', 6)} AS literacy_rate_pct
  FROM customer GROUP BY 1
)"""


def renamed_view(view: str, base: str, prefix: str, source_table: str, where: str) -> str:
    """Copy of a view chain with its CTE names prefixed and its source table filtered."""
    import re
    out = re.sub(rf"\b{base}(_\w+)?\b", lambda m: prefix + (m.group(1) or ""), view)
    return out.replace(f"FROM {source_table} ", f"FROM (SELECT * FROM {source_table} WHERE {where}) ") \
              .replace(f"FROM {source_table}\n", f"FROM (SELECT * FROM {source_table} WHERE {where})\n")
