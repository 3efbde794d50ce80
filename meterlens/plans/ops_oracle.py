"""DuckDB oracle SQL for load semantics, quality, reports, dashboard feeds,
date dimension, tariff range join, payload decoding and streaming parity."""

from __future__ import annotations

from .sqlkit import (ANNUAL_VIEW, CLEAN_VIEW, METER_VIEW, MONTHLY_VIEW, PROVINCE_VIEW, exact,
                     fiscal_quarter, fiscal_year, renamed_view, season, snap, with_views)

KWH = "consumption_kwh"


def date_dim(bounds_sql: str, name: str = "dim") -> str:
    return f"""
{name}_b AS ({bounds_sql}),
{name} AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, strftime(d, '%B') AS month_name, isodow(d) IN (6, 7) AS is_weekend,
         false AS is_public_holiday, CAST(NULL AS VARCHAR) AS holiday_name,
         {fiscal_year('d')} AS fiscal_year, {fiscal_quarter('d')} AS fiscal_quarter,
         CAST(((month(d) - 7 + 12) % 12) + 1 AS INTEGER) AS fiscal_month,
         CAST(NULL AS INTEGER) AS bs_year, CAST(NULL AS INTEGER) AS bs_month, CAST(NULL AS INTEGER) AS bs_day,
         CAST(NULL AS VARCHAR) AS bs_month_name, {season('month(d)')} AS season,
         month(d) BETWEEN 6 AND 9 AS is_monsoon
  FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM {name}_b)
)"""


ORDERS_DIM = date_dim("SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders")
EVENTS_DIM = date_dim("SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events")

STORED = renamed_view(ANNUAL_VIEW, "annual", "stored", "orders", "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'")
BATCH = renamed_view(ANNUAL_VIEW, "annual", "batch", "orders", "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
_ANN = ["total_energy_gwh", "domestic_gwh", "industrial_gwh", "commercial_gwh", "irrigation_gwh",
        "other_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh", "system_loss_pct",
        "energy_imported_gwh", "energy_exported_gwh", "installed_capacity_mw", "net_energy_gwh",
        "self_sufficiency_ratio", "load_factor_pct"]
_UPD = {"total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh", "system_loss_pct"}


def _merge_col(c):
    if c in _UPD:
        return f"CASE WHEN b.fiscal_year IS NOT NULL THEN b.{c} ELSE s.{c} END AS {c}"
    return f"CASE WHEN s.fiscal_year IS NOT NULL THEN s.{c} ELSE b.{c} END AS {c}"


def _dq(name, table, valid):
    return (f"SELECT 'data_quality_pct' AS metric, CASE WHEN count(*) > 0 THEN "
            f"{snap(f'CAST(count(*) FILTER (WHERE COALESCE({valid}, false)) AS DOUBLE) * 100.0 / count(*)', 6)} "
            f"ELSE 0.0 END AS value, 'dataset={name}' AS label FROM {table}")


_BANDS = ("CASE WHEN value / threshold >= 1.0 THEN 'red' WHEN value / threshold >= 0.9 THEN 'orange' "
          "ELSE 'green' END")

ORACLE = {
    "date_dimension": with_views(ORDERS_DIM, "SELECT * FROM dim"),
    "daily_system_load": with_views(CLEAN_VIEW + "," + EVENTS_DIM, f"""
SELECT d.full_date, d.fiscal_year, d.season, d.is_monsoon, d.is_weekend, c.consumer_type,
  {exact(f'sum(c.{KWH})')} AS total_kwh, {exact('avg(c.voltage_v)')} AS avg_voltage,
  {exact('avg(c.power_factor)')} AS avg_power_factor, max(c.{KWH}) AS peak_kwh,
  count(DISTINCT c.meter_id) AS active_meters
FROM clean c JOIN dim d ON d.date_id = CAST(strftime(c."timestamp", '%Y%m%d') AS INTEGER)
GROUP BY d.full_date, d.fiscal_year, d.season, d.is_monsoon, d.is_weekend, c.consumer_type
"""),
    "dashboard_monthly_series": with_views(MONTHLY_VIEW + "," + ORDERS_DIM, """
SELECT CAST(date_trunc('month', d.full_date) AS TIMESTAMP) AS time, mc.total_gwh AS value, 'Total' AS metric
FROM monthly mc JOIN dim d ON d.date_id = CAST(strftime(mc.date, '%Y%m%d') AS INTEGER)
"""),
    "upsert_merge": with_views(STORED + "," + BATCH, f"""
SELECT COALESCE(s.fiscal_year, b.fiscal_year) AS fiscal_year,
  {', '.join(_merge_col(c) for c in _ANN)},
  CASE WHEN s.fiscal_year IS NOT NULL AND b.fiscal_year IS NOT NULL THEN 'updated'
       WHEN b.fiscal_year IS NOT NULL THEN 'inserted' ELSE 'kept' END AS merge_action
FROM stored s FULL OUTER JOIN batch b ON s.fiscal_year = b.fiscal_year
"""),
    "append_new_only": with_views(METER_VIEW, """,
stored AS (SELECT * FROM meter WHERE "timestamp" < TIMESTAMP '2024-01-20 00:00:00'),
batch AS (SELECT * FROM meter WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00'
          QUALIFY row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY reading_id) = 1)
SELECT b.* FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.meter_id = b.meter_id AND s."timestamp" = b."timestamp")
"""),
    "landed_weather_files": """
WITH p AS (SELECT *, CASE WHEN l_returnflag = 'R' AND l_tax >= 0.08 THEN 'not a JSON object'
                          WHEN l_linenumber >= 7 OR l_quantity IS NULL THEN 'no temperature' END AS reason FROM lineitem)
SELECT l_returnflag AS label, count(*) AS payloads, min(CAST(l_quantity AS DOUBLE)) AS low, max(CAST(l_quantity AS DOUBLE)) AS high,
       max(CAST(l_extendedprice AS DOUBLE)) AS humidity, sum(CAST(0 AS DOUBLE)) AS rain
FROM p WHERE reason IS NULL GROUP BY l_returnflag
UNION ALL
SELECT reason, count(*), NULL, NULL, NULL, NULL FROM p WHERE reason IS NOT NULL GROUP BY reason
""",
    "merge_by_file": with_views(METER_VIEW, """,
known AS (SELECT * FROM meter WHERE meter_id IS NOT NULL AND "timestamp" IS NOT NULL),
stored AS (SELECT * FROM known WHERE read_at < TIMESTAMP '2024-01-20 00:00:00'
           QUALIFY row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY reading_id) = 1),
batch AS (SELECT * FROM known WHERE read_at >= TIMESTAMP '2024-01-15 00:00:00'
          QUALIFY row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY reading_id DESC) = 1)
SELECT COALESCE(s.meter_id, b.meter_id) AS meter_id, COALESCE(s."timestamp", b."timestamp") AS "timestamp",
  CASE WHEN s.meter_id IS NULL THEN b.consumer_type ELSE s.consumer_type END AS consumer_type,
  CASE WHEN b.meter_id IS NULL THEN s.consumption_kwh ELSE b.consumption_kwh END AS consumption_kwh,
  CASE WHEN b.meter_id IS NULL THEN s.voltage_v ELSE b.voltage_v END AS voltage_v,
  CASE WHEN b.meter_id IS NULL THEN s.power_factor ELSE b.power_factor END AS power_factor,
  CASE WHEN s.meter_id IS NULL THEN b.read_at ELSE s.read_at END AS read_at,
  CASE WHEN s.meter_id IS NULL THEN b.reading_id ELSE s.reading_id END AS reading_id
FROM stored s FULL OUTER JOIN batch b ON s.meter_id = b.meter_id AND s."timestamp" = b."timestamp"
"""),
    "validation_checks": with_views(ANNUAL_VIEW + "," + CLEAN_VIEW + "," + PROVINCE_VIEW + "," + MONTHLY_VIEW.replace("\nmonthly_g", "\nmonthly_g", 1), f""",
d AS (SELECT total_energy_gwh - lag(total_energy_gwh) OVER (ORDER BY fiscal_year) AS dd FROM annual)
SELECT 'annual_growth' AS check_name, 'FAIL' AS severity,
  CASE WHEN count(*) <= 1 THEN true ELSE COALESCE(avg(CASE WHEN dd IS NOT NULL THEN CAST(dd > 0 AS DOUBLE) END) >= 0.7, false) END AS passed,
  {exact('avg(CASE WHEN dd IS NOT NULL THEN CAST(dd > 0 AS DOUBLE) END)')} AS value FROM d
UNION ALL
SELECT 'voltage_flag_rate', 'WARN', COALESCE(avg(CAST(voltage_flag AS DOUBLE)) < 0.05, false),
  {exact('avg(CAST(voltage_flag AS DOUBLE))')} FROM clean
UNION ALL
SELECT 'province_loss_range', 'WARN', COALESCE(bool_and(COALESCE(system_loss_pct BETWEEN 10 AND 35, false)), true),
  CAST(count(*) FILTER (WHERE NOT COALESCE(system_loss_pct BETWEEN 10 AND 35, false)) AS DOUBLE) FROM province
UNION ALL
SELECT 'monthly_totals_positive', 'FAIL', count(*) FILTER (WHERE NOT COALESCE(total_gwh > 0, false)) = 0,
  CAST(count(*) FILTER (WHERE NOT COALESCE(total_gwh > 0, false)) AS DOUBLE) FROM monthly
"""),
    "quality_and_alerts": with_views(METER_VIEW + "," + ANNUAL_VIEW + "," + PROVINCE_VIEW, f""",
dq AS (
  {_dq('meter_readings', 'meter', "voltage_v BETWEEN 180 AND 260 AND CASE WHEN consumer_type = 'click' THEN consumption_kwh BETWEEN 0 AND 15 WHEN consumer_type = 'view' THEN consumption_kwh BETWEEN 0 AND 100 WHEN consumer_type = 'purchase' THEN consumption_kwh BETWEEN 0 AND 800 ELSE true END")}
  UNION ALL {_dq('orders', 'orders', "o_totalprice > 0 AND o_orderstatus IN ('F', 'O', 'P')")}
  UNION ALL {_dq('lineitem', 'lineitem', 'l_discount BETWEEN 0 AND 0.08')}
),
m AS (
  SELECT metric, value, label FROM dq
  UNION ALL SELECT 'system_loss_pct', system_loss_pct, 'province=' || province_name FROM province
  UNION ALL SELECT 'peak_demand_mw', peak_demand_mw, 'fiscal_year=' || fiscal_year FROM annual
),
rules AS (SELECT * FROM (VALUES ('pipeline_duration_minutes', 120.0, 'WARNING'), ('system_loss_pct', 25.0, 'WARNING'),
                                ('peak_demand_mw', 2500.0, 'CRITICAL')) AS t(metric, threshold, severity)),
a AS (
  SELECT r.severity, m.metric, m.value, CAST(r.threshold AS DOUBLE) AS threshold, m.label
  FROM m JOIN rules r USING (metric) WHERE m.value > r.threshold
  UNION ALL
  SELECT 'WARNING', metric, value, 95.0, label FROM dq WHERE value < 95.0
)
SELECT *, {_BANDS} AS band FROM a
"""),
    "recent_runs": f"""
WITH r AS (
  SELECT event_type AS pipeline_name, CAST(ts AS DATE) AS d, min(ts) AS start_time, max(ts) AS end_time,
         count(*) AS records_loaded, count(*) FILTER (WHERE value < 1) AS records_failed
  FROM events GROUP BY 1, 2
),
runs AS (
  SELECT pipeline_name || '-' || strftime(d, '%Y%m%d') AS run_id, pipeline_name, start_time, end_time,
         CASE WHEN records_failed > 0 THEN 'partial' ELSE 'success' END AS status, records_loaded,
         CASE WHEN records_failed > 0 THEN CAST(records_failed AS VARCHAR) || ' readings below 1 kWh' END AS error_message
  FROM r
)
SELECT run_id, pipeline_name,
  CAST(timezone('Asia/Kathmandu', timezone('UTC', start_time)) AS TIMESTAMP) AS start_npt,
  CAST(timezone('Asia/Kathmandu', timezone('UTC', end_time)) AS TIMESTAMP) AS end_npt,
  date_diff('microsecond', start_time, end_time) / 60e6 AS duration_minutes,
  status, records_loaded, error_message
FROM runs ORDER BY start_npt DESC, run_id LIMIT 20
""",
    "daily_summary": with_views(CLEAN_VIEW, f""",
pc AS (SELECT date, consumer_type, sum({KWH}) AS daily_total_kwh, max({KWH}) AS peak_hour_kwh,
              avg({KWH}) AS avg_kwh, avg(power_factor) AS avg_pf
       FROM clean GROUP BY date, consumer_type),
day AS (SELECT * FROM pc WHERE date = DATE '2024-01-15')
SELECT DATE '2024-01-15' AS report_date, {exact('sum(daily_total_kwh)')} AS total_kwh,
  max(peak_hour_kwh) AS peak_kwh, {exact('avg(avg_kwh)')} AS avg_kwh, {snap('avg(avg_pf)', 3)} AS avg_pf,
  CASE WHEN count(*) = 0 THEN 'No smart meter data found for 2024-01-15' END AS note
FROM day
"""),
    "dashboard_export": with_views(ANNUAL_VIEW, """
SELECT 'Annual' AS metric_type, fiscal_year AS period, total_energy_gwh AS total_gwh, peak_demand_mw AS peak_mw,
  total_consumers AS consumers, per_capita_kwh, system_loss_pct, self_sufficiency_ratio AS self_sufficiency
FROM annual
"""),
    "dashboard_hourly_profile": with_views(CLEAN_VIEW, f"""
SELECT CAST(hour AS VARCHAR) AS time, consumer_type AS metric, {snap(f'avg({KWH})', 6)} AS value
FROM clean GROUP BY hour, consumer_type
"""),
    "dashboard_fiscal_years": with_views(ANNUAL_VIEW, "SELECT DISTINCT fiscal_year FROM annual ORDER BY fiscal_year DESC"),
    "dashboard_loss_by_province": with_views(PROVINCE_VIEW, """
SELECT n.n_name AS metric, pe.system_loss_pct AS value, pe.per_capita_kwh_2023 AS per_capita_kwh
FROM province pe JOIN nation n ON n.n_nationkey = pe.province_id WHERE pe.report_year = 2023
ORDER BY value DESC, metric
"""),
    "dashboard_import_export": with_views(ANNUAL_VIEW, """
SELECT fiscal_year, energy_imported_gwh AS Imported, energy_exported_gwh AS Exported FROM annual ORDER BY fiscal_year
"""),
    "tariff_asof": f"""
WITH g AS (
  SELECT o_orderpriority AS tariff_code,
         CASE WHEN month(o_orderdate) > 7 OR (month(o_orderdate) = 7 AND day(o_orderdate) >= 17)
              THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS y,
         {snap('avg(o_totalprice) / 1e4', 4)} AS rate
  FROM orders GROUP BY 1, 2
),
rates AS (
  SELECT tariff_code, rate, make_timestamp(CAST(y AS BIGINT), 7, 17, 0, 0, 0) AS effective_from,
         lead(make_timestamp(CAST(y AS BIGINT), 7, 17, 0, 0, 0)) OVER (PARTITION BY tariff_code ORDER BY y) AS effective_to
  FROM g
)
SELECT o.o_orderkey, o.o_orderpriority AS tariff_code, o.o_orderdate, r.rate, r.effective_from,
  {snap('o.o_totalprice / 1000 * r.rate', 2)} AS charge
FROM orders o LEFT JOIN rates r ON r.tariff_code = o.o_orderpriority AND o.o_orderdate >= r.effective_from
  AND (r.effective_to IS NULL OR o.o_orderdate < r.effective_to)
""",
    "json_payload_decode": """
SELECT event_id, ts, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  (json_valid(props) IS NOT TRUE) AS malformed
FROM events
""",
    "stream_ingest_parity": with_views(METER_VIEW, """
SELECT "timestamp", meter_id, consumer_type, consumption_kwh, voltage_v, power_factor, read_at, reading_id FROM meter
QUALIFY row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY reading_id) = 1"""),
    "stream_hourly_load": with_views(METER_VIEW, f"""
SELECT "timestamp" AS hour_start, consumer_type, {snap(f'sum({KWH})', 6)} AS total_kwh,
  {snap('avg(voltage_v)', 6)} AS avg_voltage, {snap('avg(power_factor)', 6)} AS avg_pf, count(*) AS readings
FROM meter GROUP BY 1, 2
"""),
    "stream_sessions": with_views(METER_VIEW, f""",
b AS (SELECT meter_id, "timestamp" FROM meter WHERE COALESCE({KWH} = 0 OR voltage_v < 180, false)),
l AS (SELECT *, lag("timestamp") OVER (PARTITION BY meter_id ORDER BY "timestamp") AS prev FROM b),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR "timestamp" > prev + INTERVAL 2 HOUR THEN 1 ELSE 0 END)
                 OVER (PARTITION BY meter_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS sid FROM l)
SELECT meter_id, min("timestamp") AS first_bad, max("timestamp") AS last_bad, count(*) AS bad_readings,
  max("timestamp") + INTERVAL 2 HOUR AS session_end
FROM s GROUP BY meter_id, sid
"""),
}

_PROFILE_COLS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
ORACLE["table_profiles"] = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, {len(cols)} AS columns, "
    f"CAST(COALESCE({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in cols)}, 0) AS BIGINT) AS total_nulls FROM {t}"
    for t, cols in _PROFILE_COLS.items())

# period report: long rows from the monthly and yearly report inputs
_MT = MONTHLY_VIEW + f""",
mt AS (SELECT *, {snap('total_gwh / avg(total_gwh) OVER (PARTITION BY year)', 4)} AS seasonal_index,
              {snap('avg(total_gwh) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS total_gwh_3m_avg,
              {fiscal_year('date')} AS fiscal_year FROM monthly)"""


def _rows(section, src, numeric, text, report):
    parts = [f"SELECT '{section}' AS section, '{c}' AS metric, CAST({c} AS DOUBLE) AS value_num, "
             f"CAST(NULL AS VARCHAR) AS value_text, '{report}' AS report FROM {src}" for c in numeric]
    parts += [f"SELECT '{section}', '{c}', CAST(NULL AS DOUBLE), CAST({c} AS VARCHAR), '{report}' FROM {src}"
              for c in text]
    return " UNION ALL ".join(parts)


_LOSSES = f""",
losses AS (
  SELECT province_name, system_loss_pct,
         {snap('annual_consumption_gwh_2023 * system_loss_pct / 100', 2)} AS estimated_loss_gwh,
         {snap('annual_consumption_gwh_2023 * ' + snap("CASE WHEN system_loss_pct - 15.0 < 0 THEN 0.0 ELSE system_loss_pct - 15.0 END", 2) + ' / 100', 2)} AS potential_saving_gwh
  FROM province),
lt AS (
  SELECT {exact('sum(estimated_loss_gwh)')} AS total_loss_gwh,
         {exact('sum(estimated_loss_gwh * 9.0)')} AS revenue_impact_npr_mn,
         {exact('sum(potential_saving_gwh)')} AS total_recoverable_gwh,
         arg_min(province_name, CASE WHEN system_loss_pct IS NOT NULL THEN (-system_loss_pct, province_name) END) AS highest_loss_province,
         max(system_loss_pct) AS highest_loss_pct,
         arg_min(province_name, CASE WHEN system_loss_pct IS NOT NULL THEN (system_loss_pct, province_name) END) AS lowest_loss_province,
         min(system_loss_pct) AS lowest_loss_pct
  FROM losses),
cur_m AS (SELECT * FROM mt WHERE year = 1998 AND month = 6),
cur_y AS (SELECT *, {exact('(total_energy_gwh / NULLIF(lag(total_energy_gwh) OVER (ORDER BY fiscal_year), 0) - 1) * 100')} AS total_energy_gwh_yoy_pct FROM annual),
cur_y1 AS (SELECT * FROM cur_y WHERE fiscal_year = '1998/99')"""

ORACLE["period_report"] = with_views(
    _MT + "," + ANNUAL_VIEW + "," + PROVINCE_VIEW + _LOSSES, "\n" + " UNION ALL ".join([
        _rows("current_month", "cur_m", ["total_gwh", "peak_demand_mw", "load_factor_pct", "growth_rate_pct",
                                         "seasonal_index", "total_gwh_3m_avg"],
              ["month_name", "season", "fiscal_year"], "monthly 1998-06"),
        _rows("system_losses", "lt", ["total_loss_gwh", "revenue_impact_npr_mn", "total_recoverable_gwh",
                                      "highest_loss_pct", "lowest_loss_pct"],
              ["highest_loss_province", "lowest_loss_province"], "monthly 1998-06"),
        _rows("fiscal_year", "cur_y1", ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh",
                                        "system_loss_pct", "total_energy_gwh_yoy_pct", "self_sufficiency_ratio",
                                        "load_factor_pct"], ["fiscal_year"], "yearly 1998/99"),
        _rows("system_losses", "lt", ["total_loss_gwh", "revenue_impact_npr_mn", "total_recoverable_gwh"],
              ["highest_loss_province", "lowest_loss_province"], "yearly 1998/99"),
    ]))


def _trends(prefix: str, where: str) -> str:
    v = renamed_view(MONTHLY_VIEW, "monthly", prefix, "orders", where)
    return v + f""",
{prefix}_t AS (SELECT *, {snap('total_gwh / avg(total_gwh) OVER (PARTITION BY year)', 4)} AS seasonal_index,
    {snap('avg(total_gwh) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS total_gwh_3m_avg,
    {fiscal_year('date')} AS fiscal_year, {fiscal_quarter('date')} AS fiscal_quarter FROM {prefix})"""


_MCOLS = ["month_name", "date", "domestic_gwh", "industrial_gwh", "commercial_gwh", "irrigation_gwh",
          "other_gwh", "total_gwh", "peak_demand_mw", "avg_daily_mwh", "load_factor_pct", "season",
          "growth_rate_pct", "seasonal_index", "total_gwh_3m_avg", "fiscal_year", "fiscal_quarter"]
_MUPD = {"total_gwh", "peak_demand_mw", "seasonal_index"}


def _mmerge(c):
    if c in _MUPD:
        return f"CASE WHEN b.year IS NOT NULL THEN b.{c} ELSE s.{c} END AS {c}"
    return f"CASE WHEN s.year IS NOT NULL THEN s.{c} ELSE b.{c} END AS {c}"


ORACLE["upsert_monthly"] = with_views(
    _trends("smon", "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'") + ","
    + _trends("bmon", "o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'"), f"""
SELECT COALESCE(s.year, b.year) AS year, COALESCE(s.month, b.month) AS month,
  {', '.join(_mmerge(c) for c in _MCOLS)},
  CASE WHEN s.year IS NOT NULL AND b.year IS NOT NULL THEN 'updated'
       WHEN b.year IS NOT NULL THEN 'inserted' ELSE 'kept' END AS merge_action
FROM smon_t s FULL OUTER JOIN bmon_t b ON s.year = b.year AND s.month = b.month
""")


ORACLE["daily_summary_fallback"] = with_views(MONTHLY_VIEW, f"""
SELECT {snap('arg_max(avg_daily_mwh, (year, month))', 1)} AS est_daily_mwh,
       {snap('arg_max(peak_demand_mw, (year, month))', 1)} AS est_peak_mw
FROM monthly
""")

_UNIQUE = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
           "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey, l_linenumber", "events": "event_id",
           "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id",
           "conversations": "conv_id, turn"}
_FOREIGN = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"), ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey")]
_RULES = [("meter_readings", "meter", "hour_between_0_23", 'hour("timestamp") BETWEEN 0 AND 23'),
          ("meter_readings", "meter", "meter_id_not_null", "meter_id IS NOT NULL"),
          ("meter_readings", "meter", "consumption_non_negative", "consumption_kwh >= 0"),
          ("meter_readings", "meter", "voltage_in_180_260", "voltage_v BETWEEN 180 AND 260"),
          ("meter_readings", "meter", "power_factor_in_0_1", "power_factor BETWEEN 0 AND 1"),
          ("lineitem", "lineitem", "discount_in_0_1", "l_discount BETWEEN 0 AND 1"),
          ("lineitem", "lineitem", "quantity_positive", "l_quantity > 0")]
ORACLE["constraint_audit"] = with_views(METER_VIEW, "\n" + "\nUNION ALL ".join(
    [f"SELECT '{t}' AS table_name, 'unique({k})' AS check_name, count(*) AS violations "
     f"FROM (SELECT {k} FROM {t} GROUP BY ALL HAVING count(*) > 1)" for t, k in _UNIQUE.items()]
    + ["SELECT 'meter_readings', 'unique(meter_id, timestamp)', count(*) "
       'FROM (SELECT meter_id, "timestamp" FROM meter GROUP BY ALL HAVING count(*) > 1)']
    + [f"SELECT '{c}', 'foreign_key({fk})', count(*) FROM {c} WHERE {fk} IS NOT NULL AND {fk} NOT IN "
       f"(SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)" for c, fk, p, pk in _FOREIGN]
    + [f"SELECT '{n}', '{rule}', count(*) FILTER (WHERE NOT COALESCE({test}, false)) FROM {t}" for n, t, rule, test in _RULES]))

ORACLE["weather_payload_decode"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity AS avg_temp_c, l_quantity + 5 AS max_temp_c, l_quantity - 5 AS min_temp_c,
  l_quantity - 1 AS feels_like_c, l_extendedprice AS humidity_pct,
  CAST(round_even(l_linenumber * CAST(0.5 AS DOUBLE) * 3.6, 1) AS DOUBLE) AS wind_speed_kmh, l_discount AS cloud_cover_pct,
  CASE WHEN l_linestatus = 'O' THEN l_tax ELSE 0.0 END AS rainfall_mm, l_returnflag AS weather_desc, false AS malformed
FROM lineitem
"""
ORACLE["worldbank_payload_decode"] = f"""
WITH g AS (SELECT o_orderpriority AS p, CAST(year(o_orderdate) AS INTEGER) AS year, {snap('avg(o_totalprice) / 1000', 4)} AS v
           FROM orders GROUP BY 1, 2)
SELECT year, v AS per_capita_kwh_wb, 'World Bank' AS source FROM g WHERE v IS NOT NULL AND NOT (p = '5-LOW' AND year % 2 = 0)
"""
ORACLE["load_stage"] = with_views(ANNUAL_VIEW + "," + MONTHLY_VIEW + "," + CLEAN_VIEW + "," + PROVINCE_VIEW, """,
n AS (SELECT 'annual' AS table_name, count(*) AS rows_loaded, true AS again FROM annual
  UNION ALL SELECT 'monthly', count(*), true FROM monthly UNION ALL SELECT 'smart_meter', count(*), false FROM clean
  UNION ALL SELECT 'province', count(*), true FROM province UNION ALL SELECT 'weather', count(*), true FROM lineitem),
r AS (SELECT 1 AS run, table_name, rows_loaded FROM n
  UNION ALL SELECT 2, table_name, CASE WHEN again THEN rows_loaded ELSE 0 END FROM n)
SELECT run, table_name, rows_loaded FROM r
UNION ALL SELECT run, 'total', sum(rows_loaded)::BIGINT FROM r GROUP BY run
UNION ALL SELECT 0, 'log:success', sum(rows_loaded)::BIGINT FROM r
""")
ORACLE["metric_state"] = with_views(ANNUAL_VIEW, f""",
e AS (SELECT * FROM events WHERE ts IS NOT NULL),
x AS (SELECT 'latest' AS kind, event_type AS name, arg_max(value, (ts, event_id)) AS value,
        'unit=' || CAST(user_id % 5 AS VARCHAR) AS label FROM e GROUP BY event_type, user_id % 5
  UNION ALL SELECT 'total', event_type, sum(value), '' FROM e GROUP BY event_type
  UNION ALL SELECT 'stage', 'extraction_rows', count(*), 'source=' || event_type FROM e GROUP BY event_type
  UNION ALL SELECT 'stage', 'extraction_duration', datesub('second', min(ts), max(ts)), 'source=' || event_type FROM e GROUP BY event_type
  UNION ALL SELECT 'stage', 'load_rows', count(*), 'table=' || event_type FROM e GROUP BY event_type
  UNION ALL SELECT 'stage', 'load_errors', count(*) FILTER (WHERE value < 1), 'table=' || event_type FROM e GROUP BY event_type
  UNION ALL (SELECT 'stage', 'peak_demand_mw', peak_demand_mw, '' FROM annual ORDER BY fiscal_year DESC LIMIT 1))
SELECT kind, name, {snap('value', 6)} AS value, label FROM x
""")


def _panel(bands) -> str:
    return "CASE " + " ".join(f"WHEN value >= {start} THEN '{colour}'" for start, colour in reversed(bands)) + f" ELSE '{bands[0][1]}' END"


ORACLE["panel_colours"] = (ORACLE["quality_and_alerts"].split(",\nrules AS")[0] + f""",
r AS (SELECT event_type || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS run_id, min(ts) AS a, max(ts) AS b, count(*) AS n
      FROM events GROUP BY event_type, CAST(ts AS DATE)),
runs AS (SELECT *, date_diff('microsecond', a, b) / 60e6 AS minutes FROM r ORDER BY a DESC, run_id LIMIT 20),
v AS (SELECT metric AS name, value, label FROM m UNION ALL SELECT 'pipeline_status', n, 'run=' || run_id FROM runs
      UNION ALL SELECT 'pipeline_duration_minutes', minutes, 'run=' || run_id FROM runs)
SELECT name, value, label, CASE name
  WHEN 'pipeline_status' THEN {_panel([(0.0, "red"), (1000.0, "yellow"), (10000.0, "green")])}
  WHEN 'peak_demand_mw' THEN {_panel([(0.0, "green"), (2000.0, "yellow"), (2500.0, "red")])}
  WHEN 'system_loss_pct' THEN {_panel([(0.0, "green"), (18.0, "yellow"), (22.0, "red")])}
  WHEN 'data_quality_pct' THEN {_panel([(0.0, "red"), (90.0, "yellow"), (95.0, "green")])}
  ELSE {_panel([(0.0, "green"), (60.0, "yellow"), (120.0, "red")])} END AS colour
FROM v
""")
