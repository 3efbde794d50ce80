"""DuckDB oracle SQL for the national-series, weather and province queries."""

from __future__ import annotations

from .sqlkit import (ANNUAL_VIEW, JOINED_VIEW, MONTHLY_VIEW, POPULATION_VIEW, PROVINCE_VIEW, PROVINCE_YEARS_VIEW,
                     WEATHER_VIEW, clip, exact, fiscal_quarter, fiscal_year, snap, with_views)

_TARIFF = [("domestic", 8.5), ("industrial", 8.0), ("commercial", 11.5), ("irrigation", 4.5),
           ("other", 10.5)]
_SECT = ["domestic", "industrial", "commercial", "irrigation", "other"]

_REV = ",\n".join(f"  {snap(f'{s}_gwh * 1e6 * {r}', 2)} AS {s}_revenue_npr" for s, r in _TARIFF)
MONTHLY_REV = MONTHLY_VIEW + f""",
mrev0 AS (SELECT *,
{_REV}
  FROM monthly),
mrev AS (SELECT *,
  {snap(' + '.join(f'{s}_revenue_npr' for s in _SECT), 2)} AS total_revenue_npr,
  {snap('(' + ' + '.join(f'{s}_revenue_npr' for s in _SECT) + ') / 1e6', 2)} AS total_revenue_nrs_mn
  FROM mrev0)"""



ANNUAL_SUMMARY = ANNUAL_VIEW + """,
asf AS (
  SELECT *, """ + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY fiscal_year ROWS UNBOUNDED PRECEDING) AS _f_{c}"
    for c in ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh"]) + """
  FROM annual
)"""

_ANN_COLS = ("fiscal_year, total_energy_gwh, domestic_gwh, industrial_gwh, commercial_gwh, irrigation_gwh, "
             "peak_demand_mw, total_consumers, per_capita_kwh, system_loss_pct, installed_capacity_mw, "
             "energy_imported_gwh, energy_exported_gwh, net_energy_gwh, self_sufficiency_ratio, load_factor_pct")


def _cagr(end, start, yrs):
    return f"(pow({end} / NULLIF({start}, 0), 1.0 / NULLIF({yrs}, 0)) - 1) * 100"


ORACLE = {
    "monthly_revenue": with_views(MONTHLY_REV, "SELECT * FROM mrev"),
    "monthly_sector_pivot": with_views(MONTHLY_REV, f""",
y AS (SELECT year, {', '.join(f'sum({s}_revenue_npr) AS {s}_revenue_npr' for s in _SECT)},
        {' + '.join(f'sum({s}_revenue_npr)' for s in _SECT)} AS _t
      FROM mrev GROUP BY year)
SELECT year, {', '.join(f"{snap(f'{s}_revenue_npr', 2)} AS {s}_revenue_npr" for s in _SECT)},
       {snap('_t', 2)} AS total_revenue_npr,
       {', '.join(f"{snap(f'{s}_revenue_npr / _t * 100', 2)} AS {s}_revenue_npr_pct" for s in _SECT)},
       {snap('_t / 1e9', 3)} AS total_revenue_nrs_bn
FROM y
"""),
    "sector_share": with_views(ANNUAL_VIEW, f"""
SELECT fiscal_year,
  {', '.join(f"{snap(f'{s}_gwh / NULLIF(total_energy_gwh, 0) * 100', 2, 'half_up')} AS {s}_pct" for s in _SECT)},
  {snap('domestic_gwh * 8.5', 2, 'half_up')} AS domestic_gwh_x_rate,
  {snap('industrial_gwh * 8.0', 2, 'half_up')} AS industrial_gwh_x_rate,
  {snap('commercial_gwh * 11.5', 2, 'half_up')} AS commercial_gwh_x_rate,
  {snap('irrigation_gwh * 4.5', 2, 'half_up')} AS irrigation_gwh_x_rate,
  {snap('domestic_gwh * 8.5 + industrial_gwh * 8.0 + commercial_gwh * 11.5 + irrigation_gwh * 4.5', 2, 'half_up')} AS total_est_revenue_gwh_x_rate
FROM annual
"""),
    "sector_breakdown": with_views(ANNUAL_VIEW, f"""
SELECT fiscal_year, {', '.join(f'{s}_gwh' for s in _SECT)},
  {', '.join(f"{snap(f'{s}_gwh / (' + ' + '.join(f'{t}_gwh' for t in _SECT) + ') * 100', 2)} AS {s}_share_pct" for s in _SECT)}
FROM annual
"""),
    "monthly_trends": with_views(MONTHLY_VIEW, f"""
SELECT *, {snap('total_gwh / avg(total_gwh) OVER (PARTITION BY year)', 4)} AS seasonal_index,
       {snap('avg(total_gwh) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS total_gwh_3m_avg,
       {fiscal_year('date')} AS fiscal_year, {fiscal_quarter('date')} AS fiscal_quarter
FROM monthly
"""),
    "monthly_revenue_view": with_views(MONTHLY_REV, f"""
SELECT year, month, month_name, {fiscal_year('date')} AS fiscal_year, season, total_gwh, peak_demand_mw,
       total_revenue_nrs_mn AS revenue_npr_mn, growth_rate_pct,
       {snap('total_gwh / avg(total_gwh) OVER (PARTITION BY year)', 4)} AS seasonal_index
FROM mrev ORDER BY year, month
"""),
    "annual_kpis": with_views(ANNUAL_SUMMARY, f"""
SELECT {_ANN_COLS},
  {', '.join(f"{exact(f'(_f_{c} / NULLIF(lag(_f_{c}) OVER (ORDER BY fiscal_year), 0) - 1) * 100')} AS {c}_yoy_pct" for c in ['total_energy_gwh', 'peak_demand_mw', 'total_consumers', 'per_capita_kwh'])},
  {exact('energy_exported_gwh - energy_imported_gwh')} AS trade_balance_gwh,
  CAST(substr(fiscal_year, 1, 4) || '-07-17' AS DATE) AS fiscal_year_start
FROM asf
"""),
    "annual_yoy_sql": with_views(ANNUAL_VIEW, f"""
SELECT fiscal_year, total_energy_gwh, peak_demand_mw, per_capita_kwh, system_loss_pct, total_consumers,
  {snap('(total_energy_gwh - lag(total_energy_gwh) OVER (ORDER BY fiscal_year)) / NULLIF(lag(total_energy_gwh) OVER (ORDER BY fiscal_year), 0) * 100', 2, 'half_up')} AS yoy_growth_pct,
  {snap('(peak_demand_mw - lag(peak_demand_mw) OVER (ORDER BY fiscal_year)) / NULLIF(lag(peak_demand_mw) OVER (ORDER BY fiscal_year), 0) * 100', 2, 'half_up')} AS peak_yoy_pct
FROM annual
"""),
    "national_growth": with_views(ANNUAL_VIEW, f""",
o AS (
  SELECT *, first_value(total_energy_gwh) OVER w AS f_tot, first_value(per_capita_kwh) OVER w AS f_pc,
         first_value(system_loss_pct) OVER w AS f_loss, first_value(peak_demand_mw) OVER w AS f_peak,
         first_value(total_consumers) OVER w AS f_cons, first_value(installed_capacity_mw) OVER w AS f_cap,
         first_value(fiscal_year) OVER w AS f_fy,
         lag(total_energy_gwh) OVER (ORDER BY fiscal_year) AS prev_total,
         count(*) OVER w AS n_years,
         row_number() OVER (ORDER BY fiscal_year DESC) AS rn
  FROM annual
  WINDOW w AS (ORDER BY fiscal_year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT f_fy || ' – ' || fiscal_year AS period,
  {snap(_cagr('total_energy_gwh', 'f_tot', 'n_years - 1'), 2)} AS consumption_cagr_pct,
  {snap(_cagr('per_capita_kwh', 'f_pc', 'n_years - 1'), 2)} AS per_capita_cagr_pct,
  CASE WHEN f_tot > 0 THEN {snap(_cagr('total_energy_gwh', 'f_tot', 'n_years - 1'), 2)} ELSE 0.0 END AS consumption_cagr_guarded_pct,
  CASE WHEN f_pc > 0 THEN {snap(_cagr('per_capita_kwh', 'f_pc', 'n_years - 1'), 2)} ELSE 0.0 END AS per_capita_cagr_guarded_pct,
  f_loss AS system_loss_start_pct,
  fiscal_year AS latest_fiscal_year, total_energy_gwh AS latest_total_gwh,
  {snap('(total_energy_gwh / NULLIF(prev_total, 0) - 1) * 100', 2)} AS yoy_growth_pct,
  per_capita_kwh AS latest_per_capita_kwh, peak_demand_mw AS latest_peak_mw,
  total_consumers AS latest_consumers, system_loss_pct AS latest_system_loss_pct,
  {snap('f_loss - system_loss_pct', 2)} AS total_loss_reduction_pp,
  f_tot AS total_gwh_start, f_pc AS per_capita_start_kwh, f_peak AS peak_demand_start_mw,
  f_cons AS consumers_start, f_cap AS capacity_start_mw, installed_capacity_mw AS capacity_end_mw,
  {snap('installed_capacity_mw - f_cap', 1)} AS capacity_added_mw, n_years
FROM o WHERE rn = 1
"""),
    "latest_kpi": with_views(ANNUAL_VIEW, "SELECT * FROM annual ORDER BY fiscal_year DESC LIMIT 1"),
    "demand_forecast": with_views(ANNUAL_VIEW, f""",
s AS (
  SELECT 'National' AS series, fiscal_year, total_energy_gwh FROM annual
  UNION ALL
  SELECT o_orderpriority AS series, {fiscal_year('o_orderdate')} AS fiscal_year,
         sum(o_totalprice) / 1e6 AS total_energy_gwh
  FROM orders GROUP BY 1, 2
),
t AS (SELECT series, fiscal_year, ln(total_energy_gwh) AS ly,
             CAST(row_number() OVER (PARTITION BY series ORDER BY fiscal_year) - 1 AS DOUBLE) AS t FROM s),
fit AS (SELECT series, regr_slope(ly, t) AS b, regr_intercept(ly, t) AS a, max(t) AS tlast,
               max(fiscal_year) AS fy FROM t GROUP BY series),
steps AS (SELECT *, unnest(range(1, 6)) AS i FROM fit)
SELECT series,
  CAST(CAST(substr(fy, 1, 4) AS INTEGER) + i AS VARCHAR) || '/' ||
    lpad(CAST((CAST(substr(fy, 1, 4) AS INTEGER) + i + 1) % 100 AS VARCHAR), 2, '0') AS fiscal_year,
  {snap('exp(a + b * (tlast + i))', 1)} AS forecast_gwh,
  {snap('(exp(b) - 1) * 100', 2)} AS growth_assumption_pct,
  'Log-linear trend' AS method
FROM steps
"""),
    "seasonality": with_views(MONTHLY_VIEW, f""",
bm AS (SELECT month, avg(total_gwh) AS a, sum(total_gwh) AS s FROM monthly GROUP BY month),
g AS (SELECT arg_min(month, (-a, month)) AS pk, arg_min(month, (a, month)) AS tr, max(a) AS mx, min(a) AS mn,
             sum(CASE WHEN month BETWEEN 6 AND 9 THEN s ELSE 0.0 END) / sum(s) * 100 AS share FROM bm)
SELECT strftime(make_date(2000, pk, 1), '%b') AS peak_month, {snap('mx', 2)} AS peak_avg_gwh,
       strftime(make_date(2000, tr, 1), '%b') AS trough_month, {snap('mn', 2)} AS trough_avg_gwh,
       {snap('mx / mn', 3)} AS seasonal_ratio, {snap('share', 2)} AS monsoon_share_pct
FROM g
"""),
    "monthly_profile": with_views(MONTHLY_VIEW, f"""
SELECT month, max(month_name) AS month_name,
  {snap('avg(total_gwh)', 3, 'half_up')} AS avg_gwh, {snap('max(total_gwh)', 3, 'half_up')} AS max_gwh,
  {snap('min(total_gwh)', 3, 'half_up')} AS min_gwh, {snap('avg(peak_demand_mw)', 2, 'half_up')} AS avg_peak_mw,
  {snap('avg(load_factor_pct)', 2, 'half_up')} AS avg_load_factor_pct
FROM monthly GROUP BY month
"""),
    "monsoon_vs_dry": with_views(MONTHLY_VIEW, f"""
SELECT CASE WHEN month BETWEEN 6 AND 9 THEN 'Monsoon (Jun-Sep)' ELSE 'Dry Season' END AS period,
  count(*) AS months_count, {snap('avg(total_gwh)', 3, 'half_up')} AS avg_monthly_gwh,
  {snap('sum(total_gwh)', 3, 'half_up')} AS total_gwh, {snap('avg(peak_demand_mw)', 2, 'half_up')} AS avg_peak_mw
FROM monthly GROUP BY 1
"""),
    "seasonal_profile": with_views(MONTHLY_VIEW, f""",
dim AS (SELECT * FROM (VALUES (0, 'Winter'), (1, 'Pre-Monsoon'), (2, 'Monsoon'), (3, 'Post-Monsoon'))
        AS t(season_order, season)),
g AS (SELECT season, {snap('avg(total_gwh)', 3)} AS avg_gwh, {snap('max(total_gwh)', 3)} AS max_gwh,
             {snap('min(total_gwh)', 3)} AS min_gwh, count(total_gwh) AS months_count
      FROM monthly GROUP BY season)
SELECT CAST(season_order AS INTEGER) AS season_order, dim.season, avg_gwh, max_gwh, min_gwh, months_count
FROM dim LEFT JOIN g USING (season)
"""),
    "consumption_weather": with_views(JOINED_VIEW, "SELECT * FROM joined"),
    "consumption_weather_sql": with_views(MONTHLY_VIEW + "," + WEATHER_VIEW, f"""
SELECT mc.year, mc.month, mc.month_name, mc.total_gwh, mc.peak_demand_mw,
  {snap('avg(wd.avg_temp_c)', 2, 'half_up')} AS avg_temp_c,
  {snap('sum(wd.rainfall_mm)', 1, 'half_up')} AS total_rainfall_mm,
  {snap('avg(wd.humidity_pct)', 1, 'half_up')} AS avg_humidity_pct,
  {snap('sum(wd.hdd)', 2, 'half_up')} AS total_hdd,
  {snap('sum(wd.cdd)', 2, 'half_up')} AS total_cdd
FROM monthly mc
LEFT JOIN weather wd ON wd.station_id = 'ST-N' AND year(wd.date) = mc.year AND month(wd.date) = mc.month
GROUP BY mc.year, mc.month, mc.month_name, mc.total_gwh, mc.peak_demand_mw
"""),
    "degree_days": with_views(WEATHER_VIEW, "SELECT * FROM weather"),
    "correlations": with_views(JOINED_VIEW, f""",
c AS (SELECT covar_pop(CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_temp_c END, CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_temp_c END) * var_pop(CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_temp_c END) * var_pop(CASE WHEN (avg_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS avg_temp_c,
  covar_pop(CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN max_temp_c END, CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN max_temp_c END) * var_pop(CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN max_temp_c END) * var_pop(CASE WHEN (max_temp_c IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS max_temp_c,
  covar_pop(CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_humidity_pct END, CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_humidity_pct END) * var_pop(CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN avg_humidity_pct END) * var_pop(CASE WHEN (avg_humidity_pct IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS avg_humidity_pct,
  covar_pop(CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_rainfall_mm END, CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_rainfall_mm END) * var_pop(CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_rainfall_mm END) * var_pop(CASE WHEN (total_rainfall_mm IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS total_rainfall_mm,
  covar_pop(CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_hdd END, CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_hdd END) * var_pop(CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_hdd END) * var_pop(CASE WHEN (total_hdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS total_hdd,
  covar_pop(CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_cdd END, CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_cdd END) * var_pop(CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_cdd END) * var_pop(CASE WHEN (total_cdd IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS total_cdd,
  covar_pop(CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN temp_demand_index END, CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END) / CASE WHEN sqrt(var_pop(CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN temp_demand_index END) * var_pop(CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) > 0 THEN sqrt(var_pop(CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN temp_demand_index END) * var_pop(CASE WHEN (temp_demand_index IS NOT NULL AND total_gwh IS NOT NULL) THEN total_gwh END)) END AS temp_demand_index FROM joined),
u AS (SELECT * FROM c UNPIVOT INCLUDE NULLS (r FOR weather_variable IN (avg_temp_c, max_temp_c, avg_humidity_pct,
      total_rainfall_mm, total_hdd, total_cdd, temp_demand_index)))
SELECT weather_variable, {snap('r', 4)} AS correlation_r,
  CASE WHEN r > 0 THEN 'Positive' ELSE 'Negative' END AS direction,
  CASE WHEN abs(r) > 0.7 THEN 'Strong' WHEN abs(r) > 0.4 THEN 'Moderate' ELSE 'Weak' END AS strength,
  {exact('abs(r)')} AS abs_r
FROM u
"""),
    "monsoon_impact": with_views(JOINED_VIEW, f""",
g AS (SELECT avg(total_gwh) FILTER (WHERE month BETWEEN 6 AND 9) AS mon,
             avg(total_gwh) FILTER (WHERE NOT (month BETWEEN 6 AND 9)) AS dry,
             avg(total_rainfall_mm) FILTER (WHERE month BETWEEN 6 AND 9) AS rain FROM joined)
SELECT {snap('mon', 3)} AS monsoon_avg_gwh, {snap('dry', 3)} AS dry_season_avg_gwh,
       {snap('(mon / NULLIF(dry, 0) - 1) * 100', 2)} AS monsoon_premium_pct,
       {snap('rain', 1)} AS monsoon_avg_rainfall_mm
FROM g
"""),
    "trade_balance": with_views(ANNUAL_VIEW, f"""
SELECT fiscal_year, energy_imported_gwh, energy_exported_gwh,
  {exact('COALESCE(energy_exported_gwh, 0.0) - COALESCE(energy_imported_gwh, 0.0)')} AS trade_balance_gwh,
  CASE WHEN COALESCE(energy_exported_gwh, 0.0) - COALESCE(energy_imported_gwh, 0.0) > 0
       THEN 'Net Exporter' ELSE 'Net Importer' END AS trade_status,
  {snap('COALESCE(energy_imported_gwh, 0.0) / NULLIF(total_energy_gwh, 0) * 100', 2)} AS import_dependency_pct
FROM annual
"""),
    "trade_balance_sql": with_views(ANNUAL_VIEW, f"""
SELECT fiscal_year, energy_imported_gwh, energy_exported_gwh,
  {exact('energy_exported_gwh - energy_imported_gwh')} AS trade_balance_gwh,
  CASE WHEN energy_exported_gwh > energy_imported_gwh THEN 'Net Exporter' ELSE 'Net Importer' END AS trade_status,
  {snap('energy_imported_gwh / NULLIF(total_energy_gwh, 0) * 100', 2, 'half_up')} AS import_dependency_pct
FROM annual
"""),
    "province_clean": with_views(PROVINCE_VIEW, "SELECT * FROM province"),
    "province_enriched": with_views(PROVINCE_VIEW + "," + POPULATION_VIEW, f"""
SELECT p.*, pop.per_capita_income_usd, pop.urban_pct, pop.literacy_rate_pct,
  {snap('annual_consumption_gwh_2023 * 1e6 / NULLIF(households_2021, 0)', 2)} AS kwh_per_household,
  {snap('100 - electrification_pct_2021', 2)} AS electrification_gap_pct,
  {snap('electricity_consumers_2023 / NULLIF(area_sq_km, 0)', 4)} AS consumers_per_km2,
  {snap('annual_consumption_gwh_2023 * 1e6 * 8.5 / 1e6', 2)} AS estimated_revenue_npr_mn
FROM province p LEFT JOIN population pop USING (province_id)
"""),
    "province_ranking": with_views(PROVINCE_VIEW, """
SELECT *, rank() OVER (ORDER BY per_capita_kwh_2023 DESC NULLS LAST) AS rank_per_capita,
  rank() OVER (ORDER BY annual_consumption_gwh_2023 DESC NULLS LAST) AS rank_consumption,
  rank() OVER (ORDER BY electrification_pct_2021 DESC NULLS LAST) AS rank_electrification,
  rank() OVER (ORDER BY system_loss_pct ASC NULLS LAST) AS rank_system_loss
FROM province
"""),
    "ols_regression": with_views(JOINED_VIEW, f""",
d AS (SELECT total_gwh AS y, avg_temp_c AS a, total_hdd AS b, total_cdd AS c, total_rainfall_mm AS r FROM joined
      WHERE total_gwh IS NOT NULL AND avg_temp_c IS NOT NULL AND total_hdd IS NOT NULL AND total_cdd IS NOT NULL
        AND total_rainfall_mm IS NOT NULL),
m AS (SELECT *, y - avg(y) OVER () AS yc, a - avg(a) OVER () AS e1, b - avg(b) OVER () AS bc, c - avg(c) OVER () AS cc,
             r - avg(r) OVER () AS rc FROM d),
-- each feature less its projection on the ones before it
g2 AS (SELECT *, bc - (SELECT regr_slope(bc, e1) FROM m) * e1 AS e2 FROM m),
g3 AS (SELECT *, cc - (SELECT regr_slope(cc, e1) FROM g2) * e1 - (SELECT regr_slope(cc, e2) FROM g2) * e2 AS e3 FROM g2),
g4 AS (SELECT *, rc - (SELECT regr_slope(rc, e1) FROM g3) * e1 - (SELECT regr_slope(rc, e2) FROM g3) * e2
               - (SELECT regr_slope(rc, e3) FROM g3) * e3 AS e4 FROM g3),
-- coefficients from the last feature back
k4 AS (SELECT regr_slope(yc, e4) AS v FROM g4),
k3 AS (SELECT regr_slope(yc - (SELECT v FROM k4) * rc, e3) AS v FROM g4),
k2 AS (SELECT regr_slope(yc - (SELECT v FROM k4) * rc - (SELECT v FROM k3) * cc, e2) AS v FROM g4),
k1 AS (SELECT regr_slope(yc - (SELECT v FROM k4) * rc - (SELECT v FROM k3) * cc - (SELECT v FROM k2) * bc, e1) AS v FROM g4),
f AS (SELECT *, (SELECT v FROM k1) * e1 + (SELECT v FROM k2) * bc + (SELECT v FROM k3) * cc + (SELECT v FROM k4) * rc AS fit FROM g4)
SELECT {snap('1 - sum((yc - fit) * (yc - fit)) / sum(yc * yc)', 4)} AS r_squared,
  {snap('avg(y) - (SELECT v FROM k1) * avg(a) - (SELECT v FROM k2) * avg(b) - (SELECT v FROM k3) * avg(c) - (SELECT v FROM k4) * avg(r)', 4)} AS intercept,
  count(*) AS n_observations, CAST(NULL AS VARCHAR) AS error,
  {snap('(SELECT v FROM k1)', 6)} AS coeff_avg_temp_c, {snap('(SELECT v FROM k2)', 6)} AS coeff_total_hdd,
  {snap('(SELECT v FROM k3)', 6)} AS coeff_total_cdd, {snap('(SELECT v FROM k4)', 6)} AS coeff_total_rainfall_mm
FROM f
"""),
    "province_performance_view": with_views(PROVINCE_YEARS_VIEW, f"""
SELECT n.n_name AS province_name_en, r.r_name AS headquarter, pe.report_year,
  pe.annual_consumption_gwh_2023 AS annual_consumption_gwh, pe.per_capita_kwh_2023 AS per_capita_kwh,
  pe.electrification_pct_2021 AS electrification_pct, pe.system_loss_pct,
  rank() OVER (PARTITION BY report_year ORDER BY pe.per_capita_kwh_2023 DESC NULLS LAST) AS rank_per_capita,
  rank() OVER (PARTITION BY report_year ORDER BY pe.electrification_pct_2021 DESC NULLS LAST) AS rank_electrification,
  {snap('pe.annual_consumption_gwh_2023 * 1e6 * 8.5 / 1e6', 2)} AS estimated_revenue_npr_mn
FROM province_years pe JOIN nation n ON n.n_nationkey = pe.province_id JOIN region r ON r.r_regionkey = n.n_regionkey
"""),
    "province_performance": with_views(PROVINCE_YEARS_VIEW, f"""
SELECT n.n_name AS province_name_en, pe.electrification_pct_2021 AS electrification_pct,
  pe.per_capita_kwh_2023 AS per_capita_kwh, pe.annual_consumption_gwh_2023 AS annual_consumption_gwh,
  pe.system_loss_pct, {snap('pe.annual_consumption_gwh_2023 * pe.system_loss_pct / 100', 2)} AS estimated_loss_gwh,
  {snap('pe.annual_consumption_gwh_2023 * 1e6 * 8.5 / 1e6', 2)} AS estimated_revenue_npr_mn,
  rank() OVER (ORDER BY pe.per_capita_kwh_2023 DESC NULLS FIRST) AS rank_per_capita,
  rank() OVER (ORDER BY pe.electrification_pct_2021 DESC NULLS FIRST) AS rank_electrification,
  rank() OVER (ORDER BY pe.system_loss_pct ASC NULLS LAST) AS rank_efficiency
FROM province_years pe JOIN nation n ON n.n_nationkey = pe.province_id
WHERE pe.report_year = 2023
"""),
    "composite_rank": with_views(PROVINCE_VIEW, f""",
r AS (SELECT province_name,
  rank() OVER (ORDER BY per_capita_kwh_2023 DESC NULLS LAST) AS rank_per_capita_kwh_2023,
  rank() OVER (ORDER BY electrification_pct_2021 DESC NULLS LAST) AS rank_electrification_pct_2021,
  rank() OVER (ORDER BY system_loss_pct ASC NULLS LAST) AS rank_system_loss_pct,
  rank() OVER (ORDER BY installed_capacity_mw_2023 DESC NULLS LAST) AS rank_installed_capacity_mw_2023
  FROM province),
s AS (SELECT *, {snap('(rank_per_capita_kwh_2023 + rank_electrification_pct_2021 + rank_system_loss_pct + rank_installed_capacity_mw_2023) / 4', 2)} AS composite_score FROM r)
SELECT province_name, rank() OVER (ORDER BY composite_score ASC NULLS LAST) AS overall_rank, composite_score,
  rank_per_capita_kwh_2023, rank_electrification_pct_2021, rank_system_loss_pct, rank_installed_capacity_mw_2023
FROM s
"""),
    "electrification_gap": with_views(PROVINCE_VIEW, f"""
SELECT province_name, province_id, electrification_pct_2021,
  CAST(round_even(households_2021 * (1 - electrification_pct_2021 / 100), 0) AS BIGINT) AS unelectrified_households,
  {snap('CAST(round_even(households_2021 * (1 - electrification_pct_2021 / 100), 0) AS BIGINT) * 25000 / 1000000', 2)} AS est_connection_cost_npr_mn,
  {snap('electrification_pct_2021 - avg(electrification_pct_2021) OVER ()', 2)} AS gap_vs_national_avg_pp
FROM province
"""),
    "electrification_gap_sql": with_views(PROVINCE_YEARS_VIEW, f"""
SELECT n_name AS province_name_en, electrification_pct_2021 AS electrification_pct, households_2021 AS households,
  CAST({snap('households_2021 * (1 - electrification_pct_2021 / 100)', 0, 'half_up')} AS INTEGER) AS unelectrified_hh,
  {snap('households_2021 * (1 - electrification_pct_2021 / 100) * 25000 / 1000000', 2, 'half_up')} AS est_connection_cost_npr_mn
FROM province_years JOIN nation ON n_nationkey = province_id WHERE report_year = 2023
"""),
    "system_losses": with_views(PROVINCE_VIEW, f""",
a AS (SELECT province_id, province_name, annual_consumption_gwh_2023, system_loss_pct, transmission_lines_km,
             distribution_lines_km, {snap('annual_consumption_gwh_2023 * system_loss_pct / 100', 2)} AS estimated_loss_gwh,
             {snap(clip('system_loss_pct - 15.0', 0.0), 2)} AS loss_reduction_target_pct
      FROM province)
SELECT *, {snap('estimated_loss_gwh * 1000 / NULLIF(transmission_lines_km + distribution_lines_km, 0)', 2)} AS loss_per_km_mwh,
       {snap('annual_consumption_gwh_2023 * loss_reduction_target_pct / 100', 2)} AS potential_saving_gwh
FROM a
"""),
    "system_losses_analysis": with_views(PROVINCE_VIEW, f""",
a AS (SELECT province_name, system_loss_pct,
             {snap('annual_consumption_gwh_2023 * system_loss_pct / 100', 3)} AS energy_lost_gwh,
             {snap('annual_consumption_gwh_2023 * ' + clip('system_loss_pct - 15.0', 0.0) + ' / 100', 3)} AS recoverable_gwh
      FROM province)
SELECT *, {snap('energy_lost_gwh * 1e6 * 9.0 / 1e6', 2)} AS revenue_lost_npr_mn,
       {snap('recoverable_gwh * 1e6 * 9.0 / 1e6', 2)} AS recoverable_revenue_npr_mn
FROM a
"""),
    "loss_opportunity": with_views(PROVINCE_YEARS_VIEW, f"""
SELECT n_name AS province_name_en, system_loss_pct,
  {snap('annual_consumption_gwh_2023 * system_loss_pct / 100', 2)} AS estimated_loss_gwh,
  {snap(snap('annual_consumption_gwh_2023 * system_loss_pct / 100', 3) + ' * 1e6 * 9.0 / 1e6', 2)} AS revenue_lost_npr_mn,
  {exact('greatest(0.0, system_loss_pct - 15.0)')} AS excess_loss_pp,
  {snap('annual_consumption_gwh_2023 * greatest(0.0, system_loss_pct - 15.0) / 100', 3, 'half_up')} AS recoverable_gwh,
  {snap('annual_consumption_gwh_2023 * greatest(0.0, system_loss_pct - 15.0) / 100 * 9', 2, 'half_up')} AS recoverable_npr_mn
FROM province_years JOIN nation ON n_nationkey = province_id WHERE report_year = 2023
"""),
    "inequality_gini": f"""
WITH x AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS group_key, c_acctbal AS v, c_name AS lab FROM customer WHERE c_acctbal IS NOT NULL
  UNION ALL
  SELECT 'All' AS group_key, c_acctbal AS v, c_name AS lab FROM customer WHERE c_acctbal IS NOT NULL
),
r AS (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY v, lab) AS i,
             count(*) OVER (PARTITION BY group_key) AS n FROM x),
g AS (SELECT group_key, sum((2 * i - n - 1) * v) AS num, sum(v) AS s, first(n) AS n,
             max(v) AS max_value, min(v) AS min_value, avg(v) AS a,
             arg_min(lab, (-v, lab)) AS max_label, arg_min(lab, (v, lab)) AS min_label
      FROM r GROUP BY group_key)
SELECT group_key, n, max_label, max_value, min_label, min_value,
  {snap('max_value / NULLIF(min_value, 0)', 2)} AS ratio_max_to_min,
  {snap('num / NULLIF(n * s, 0)', 4)} AS gini_coefficient,
  {snap('a', 1)} AS mean_value
FROM g
""",
}
