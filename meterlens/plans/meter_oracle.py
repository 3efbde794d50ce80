"""DuckDB oracle SQL for the meter queries (independent formulation)."""

from __future__ import annotations

from .sqlkit import CLEAN_VIEW, METER_VIEW, exact, fiscal_quarter, fiscal_year, snap, with_views

KWH = "consumption_kwh"

ORACLE = {
    "distinct_meters_rollup": with_views(CLEAN_VIEW, """
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, consumer_type,
       count(DISTINCT meter_id) AS meter_count, TRUE AS estimate_close
FROM clean GROUP BY ALL
"""),
    "load_quantiles_rollup": with_views(CLEAN_VIEW, f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, consumer_type, count(*) AS readings,
       {snap(f'quantile_cont({KWH}, 0.5)', 4)} AS p50_kwh, {snap(f'quantile_cont({KWH}, 0.9)', 4)} AS p90_kwh,
       TRUE AS p50_kwh_close, TRUE AS p90_kwh_close
FROM clean WHERE {KWH} IS NOT NULL GROUP BY ALL
"""),
    "load_moments_rollup": with_views(CLEAN_VIEW, f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, consumer_type, count(*) AS readings,
       {snap(f'avg({KWH})', 4)} AS avg_kwh, {snap(f'stddev_samp({KWH})', 4)} AS std_kwh,
       {snap(f"CASE WHEN stddev_pop({KWH}) * stddev_pop(voltage_v) > 0 THEN corr({KWH}, voltage_v) END", 4)} AS r_kwh_voltage
FROM clean WHERE {KWH} IS NOT NULL AND voltage_v IS NOT NULL GROUP BY ALL
"""),
    "meter_readings_range": with_views(METER_VIEW, """
SELECT * FROM meter
WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-20 00:00:00'
"""),
    "meter_extract_stats": with_views(METER_VIEW, """
SELECT count(*) AS row_count, count(DISTINCT meter_id) AS meter_count,
       min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM meter
WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-20 00:00:00'
"""),
    "meter_registry": with_views(METER_VIEW, f"""
SELECT meter_id, consumer_type, min("timestamp") AS first_reading, max("timestamp") AS last_reading,
       {exact(f'avg({KWH})')} AS avg_consumption_kwh,
       {exact('avg(voltage_v)')} AS avg_voltage,
       {exact('avg(power_factor)')} AS avg_power_factor
FROM meter GROUP BY meter_id, consumer_type
"""),
    "meter_clean": with_views(CLEAN_VIEW, "SELECT * FROM clean"),
    "meter_outlier_counts": with_views(METER_VIEW, f"""
SELECT consumer_type, count(*) AS rows,
       count(*) FILTER (WHERE (consumer_type = 'click' AND ({KWH} < 0 OR {KWH} > 15))
                          OR (consumer_type = 'view' AND ({KWH} < 0 OR {KWH} > 100))
                          OR (consumer_type = 'purchase' AND ({KWH} < 0 OR {KWH} > 800)))
         AS consumption_outliers,
       count(*) FILTER (WHERE voltage_v < 180 OR voltage_v > 260) AS voltage_outliers,
       count(*) FILTER (WHERE power_factor < 0 OR power_factor > 1) AS power_factor_outliers
FROM meter GROUP BY consumer_type
"""),
    "meter_features": with_views(CLEAN_VIEW, f""",
f AS (
  SELECT *,
    {snap(f'avg({KWH}) OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)', 4)} AS rolling_24h_kwh,
    {snap(f'avg({KWH}) OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)', 4)} AS rolling_7d_kwh,
    {snap(f'{KWH} - avg({KWH}) OVER (PARTITION BY meter_id, date)', 4)} AS deviation_from_daily_avg
  FROM clean
)
SELECT *,
  CASE WHEN {KWH} / (rolling_24h_kwh + 1e-9) >= 1.5 THEN 'High'
       WHEN {KWH} / (rolling_24h_kwh + 1e-9) >= 0.8 THEN 'Normal' ELSE 'Low' END AS demand_category,
  COALESCE(power_factor < 0.85, false) AS low_power_factor,
  COALESCE(voltage_v < 210, false) AS voltage_dip
FROM f
"""),
    "hourly_system_load": with_views(CLEAN_VIEW, f"""
SELECT date, hour, consumer_type, {exact(f'sum({KWH})')} AS total_kwh,
       count(DISTINCT meter_id) AS meter_count,
       {exact('avg(voltage_v)')} AS avg_voltage, {exact('avg(power_factor)')} AS avg_pf,
       {snap(f'sum({KWH}) * 49500.0 / 1000', 2)} AS scaled_mwh,
       {fiscal_year('date')} AS fiscal_year, {fiscal_quarter('date')} AS fiscal_quarter
FROM clean GROUP BY date, hour, consumer_type
"""),
    "hourly_load_profile": with_views(CLEAN_VIEW, f"""
SELECT consumer_type, hour, is_weekend,
       {snap(f'avg({KWH})', 4)} AS avg_kwh,
       {snap(f'quantile_cont({KWH}, 0.95)', 4)} AS p95_kwh,
       {snap(f'quantile_cont({KWH}, 0.05)', 4)} AS p05_kwh,
       {snap(f'stddev_samp({KWH})', 4)} AS std_kwh,
       count({KWH}) AS sample_count,
       CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type
FROM clean GROUP BY consumer_type, hour, is_weekend
"""),
    "load_profile_sql": with_views(CLEAN_VIEW, f"""
SELECT consumer_type, hour, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {snap(f'avg({KWH})', 4, 'half_up')} AS avg_kwh,
       {snap(f'max({KWH})', 4, 'half_up')} AS peak_kwh,
       {snap(f'quantile_cont({KWH}, 0.9)', 4, 'half_up')} AS p90_kwh,
       count(*) AS sample_count
FROM clean GROUP BY consumer_type, hour, is_weekend
"""),
    "daily_load_curve": with_views(CLEAN_VIEW, f"""
SELECT consumer_type, hour, is_weekend,
       {exact(f'avg({KWH})')} AS avg_kwh, max({KWH}) AS max_kwh,
       {exact(f'quantile_cont({KWH}, 0.9)')} AS p90_kwh,
       hour BETWEEN 18 AND 21 AS is_nea_peak,
       lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS time_label
FROM clean GROUP BY consumer_type, hour, is_weekend
"""),
    "peak_calendar": with_views(CLEAN_VIEW, f"""
SELECT date, consumer_type, {exact(f'sum({KWH})')} AS daily_total_kwh,
       max({KWH}) AS peak_hour_kwh,
       arg_min(hour, CASE WHEN {KWH} IS NOT NULL THEN ({KWH} * -1, "timestamp", reading_id) END) AS peak_hour,
       {exact(f'avg({KWH})')} AS avg_kwh, {exact('avg(voltage_v)')} AS avg_voltage,
       {exact('avg(power_factor)')} AS avg_pf,
       dayname(date) AS weekday, CAST(weekofyear(date) AS INTEGER) AS week_number
FROM clean GROUP BY date, consumer_type
"""),
    "load_factor_daily": with_views(CLEAN_VIEW, f"""
SELECT date, consumer_type, {exact(f'avg({KWH})')} AS avg_kwh, max({KWH}) AS peak_kwh,
       {exact(f'sum({KWH})')} AS total_kwh,
       {snap(f'avg({KWH}) / NULLIF(max({KWH}), 0) * 100', 2)} AS load_factor_pct
FROM clean GROUP BY date, consumer_type
"""),
    "mean_load_factor": with_views(CLEAN_VIEW, f""",
lf AS (SELECT date, consumer_type, {snap(f'avg({KWH}) / NULLIF(max({KWH}), 0) * 100', 2)} AS load_factor_pct
       FROM clean GROUP BY date, consumer_type)
SELECT {exact('avg(load_factor_pct)')} AS avg_load_factor_pct FROM lf
"""),
    "peak_offpeak_ratio": with_views(CLEAN_VIEW, f""",
p AS (
  SELECT consumer_type,
         avg({KWH}) FILTER (WHERE hour BETWEEN 6 AND 8 OR hour BETWEEN 18 AND 21) AS pk,
         avg({KWH}) FILTER (WHERE NOT (hour BETWEEN 6 AND 8 OR hour BETWEEN 18 AND 21)) AS op
  FROM clean GROUP BY consumer_type
)
SELECT consumer_type, {exact('pk')} AS peak_avg_kwh, {exact('op')} AS offpeak_avg_kwh,
       {snap('pk / NULLIF(op, 0)', 3)} AS peak_to_offpeak_ratio
FROM p
"""),
    "low_value_meters": with_views(CLEAN_VIEW, """
SELECT meter_id, consumer_type, """ + snap("avg(power_factor)", 4, "half_up") + """ AS avg_pf,
       count(*) FILTER (WHERE power_factor < 0.85) AS low_pf_hours,
       count(*) AS total_hours,
       """ + snap("count(*) FILTER (WHERE power_factor < 0.85) * 100.0 / count(*)", 2, "half_up") + """ AS low_pf_pct
FROM clean GROUP BY meter_id, consumer_type
HAVING """ + exact("avg(power_factor)") + """ < 0.88
"""),
    "outage_islands": with_views(METER_VIEW, f""",
b AS (
  SELECT meter_id, consumer_type, "timestamp", reading_id,
         COALESCE({KWH} = 0 OR voltage_v < 180, false) AS bad
  FROM meter
),
l AS (
  SELECT *, COALESCE(lag(bad) OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id), false) AS prev_bad
  FROM b
),
s AS (
  SELECT *, sum(CASE WHEN bad AND NOT prev_bad THEN 1 ELSE 0 END)
            OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id ROWS UNBOUNDED PRECEDING) AS island
  FROM l
),
starts AS (SELECT meter_id, island, "timestamp" AS outage_start FROM s WHERE bad AND NOT prev_bad),
ends AS (SELECT meter_id, island, consumer_type, "timestamp" AS outage_end FROM s WHERE NOT bad AND prev_bad)
SELECT e.meter_id, e.consumer_type, st.outage_start, e.outage_end,
       {snap('date_diff(\'second\', st.outage_start, e.outage_end) / 3600.0', 2)} AS duration_hours
FROM ends e JOIN starts st USING (meter_id, island)
WHERE date_diff('second', st.outage_start, e.outage_end) / 3600.0 >= 2
"""),
    "outage_suspects": with_views(CLEAN_VIEW, f""",
h AS (
  SELECT meter_id, "timestamp", {KWH},
         lead({KWH}) OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id) AS next_kwh
  FROM clean
)
SELECT meter_id, "timestamp" AS suspected_outage_start, 'Possible 2-hour outage' AS flag
FROM h WHERE {KWH} = 0 AND next_kwh = 0
"""),
    "demand_peaks_topn": with_views(METER_VIEW, f"""
SELECT meter_id, consumer_type, "timestamp", {KWH} AS peak_consumption_kwh, voltage_v, power_factor
FROM meter
QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY {KWH} DESC, "timestamp", reading_id) <= 100
"""),
    "system_peak_days": with_views(CLEAN_VIEW, f""",
d AS (SELECT date, max({KWH}) AS peak_kwh FROM clean GROUP BY date)
SELECT date, peak_kwh, dayname(date) AS weekday, CAST(month(date) AS INTEGER) AS month,
       CAST(row_number() OVER (ORDER BY peak_kwh DESC, date) AS INTEGER) AS rank
FROM d QUALIFY row_number() OVER (ORDER BY peak_kwh DESC, date) <= 20
"""),
    "peak_hours_top20": with_views(CLEAN_VIEW, f""",
g AS (
  SELECT "timestamp", CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour,
         consumer_type,
         {snap(f'sum({KWH})', 2, 'half_up')} AS total_kwh,
         {snap('avg(voltage_v)', 2, 'half_up')} AS avg_voltage,
         {snap('avg(power_factor)', 4, 'half_up')} AS avg_pf
  FROM clean GROUP BY "timestamp", consumer_type
)
SELECT * FROM g ORDER BY total_kwh DESC, "timestamp", consumer_type LIMIT 20
"""),
    "load_duration_curve": with_views(CLEAN_VIEW, f""",
t AS (SELECT "timestamp", {exact(f'sum({KWH})')} AS load FROM clean GROUP BY "timestamp")
SELECT row_number() OVER (ORDER BY load DESC, "timestamp") AS rank,
       load AS load_kwh,
       row_number() OVER (ORDER BY load DESC, "timestamp") / count(*) OVER () * 100 AS exceedance_pct,
       'All' AS consumer_type, "timestamp"
FROM t
"""),
}
