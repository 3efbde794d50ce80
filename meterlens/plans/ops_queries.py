"""Driver queries for load semantics, quality, reports, dashboard feeds,
date dimension, effective-dated tariffs, payload decoding and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.exprs import snap
from ..operators import dates as D
from ..operators import load_stage as LS
from ..operators import loads as L
from ..operators import meters as M
from ..operators import quality as Q
from ..operators import regions as R
from ..operators import series as S
from ..operators import summary as U
from ..session import checkpoint_folder
from ..sources.keyed_table import KeyedTable
from ..sources.landed import read_payloads, split_bad, weather_files
from ..sources.payloads import decode_props, decode_weather, decode_worldbank
from ..sources.tables import EVENT_TYPE_BOUNDS, TABLES, national_annual, read_table, weather_observations
from ..streaming import ingest as ST
from .meter_queries import clean as clean_meters
from .meter_queries import raw_meters
from .national_queries import annual, monthly, provinces

ANNUAL_UPDATE = ["total_energy_gwh", "peak_demand_mw", "total_consumers", "per_capita_kwh",
                 "system_loss_pct"]


def q_date_dimension(spark, sf):
    orders = read_table(spark, sf, "orders")
    return D.date_dimension(D.date_bounds(orders, "o_orderdate"))


def q_daily_system_load(spark, sf):
    ev = read_table(spark, sf, "events")
    dim = D.date_dimension(D.date_bounds(ev, "ts"))
    return D.daily_system_load_view(clean_meters(spark, sf), dim)


def q_dashboard_monthly_series(spark, sf):
    dim = D.date_dimension(D.date_bounds(read_table(spark, sf, "orders"), "o_orderdate"))
    return D.monthly_series_panel(monthly(spark, sf), dim)


def q_upsert_merge(spark, sf):
    orders = read_table(spark, sf, "orders")
    stored = S.clean_annual(national_annual(orders.filter(F.col("o_orderdate") < "1999-01-01")))
    batch = S.clean_annual(national_annual(orders.filter(F.col("o_orderdate") >= "1998-01-01")))
    merged = L.upsert(stored, batch, ["fiscal_year"], ANNUAL_UPDATE, [F.col("fiscal_year")])
    return merged.drop("loaded_at")


MONTHLY_UPDATE = ["total_gwh", "peak_demand_mw", "seasonal_index"]


def q_upsert_monthly(spark, sf):
    from ..sources.tables import national_monthly
    orders = read_table(spark, sf, "orders")
    def trends(o):
        return S.monthly_trends(S.clean_monthly(national_monthly(o)))
    stored = trends(orders.filter(F.col("o_orderdate") < "1999-01-01"))
    batch = trends(orders.filter(F.col("o_orderdate") >= "1998-06-01"))
    return L.upsert(stored, batch, ["year", "month"], MONTHLY_UPDATE, [F.col("date")]).drop("loaded_at")


def q_append_new_only(spark, sf):
    m = raw_meters(spark, sf)
    # hour-aligned bounds: the same predicate on the stored event time reaches the scan
    stored = m.filter(F.col("read_at") < F.to_timestamp_ntz(F.lit("2024-01-20")))
    batch = m.filter(F.col("read_at") >= F.to_timestamp_ntz(F.lit("2024-01-15")))
    return L.append_new_only(stored, batch, ["meter_id", "timestamp"], [F.col("reading_id")])


def q_merge_by_file(spark, sf):
    """Readings stored in a keyed table by day, then the last days' readings
    merged into the files that hold them; the whole merged table."""
    m = raw_meters(spark, sf).filter(F.col("meter_id").isNotNull() & F.col("timestamp").isNotNull())
    stored = M.dedupe_first(m.filter(F.col("read_at") < F.to_timestamp_ntz(F.lit("2024-01-20"))),
                            ["meter_id", "timestamp"], ["reading_id"])
    batch = m.filter(F.col("read_at") >= F.to_timestamp_ntz(F.lit("2024-01-15")))
    table = KeyedTable(ST.run_dir(_stream_base(spark), "keyed"), ("meter_id", "timestamp"), "to_date(timestamp)")
    table.create(stored)
    table.merge(batch, ["consumption_kwh", "voltage_v", "power_factor"], [F.col("reading_id")])
    return table.read(spark).drop("loaded_at")


KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
        "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
        "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
        "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}


def q_constraint_audit(spark, sf):
    t = lambda n: read_table(spark, sf, n)
    meters = raw_meters(spark, sf)
    checks = [Q.duplicate_keys(t(n), n, keys) for n, keys in KEYS.items()]
    checks += [
        Q.duplicate_keys(meters, "meter_readings", ["meter_id", "timestamp"]),
        Q.table_audit(t("lineitem"), "lineitem", {
            "l_orderkey": (t("orders"), "o_orderkey"), "l_suppkey": (t("supplier"), "s_suppkey"),
            "l_partkey": (t("part"), "p_partkey")}, {
            "discount_in_0_1": F.col("l_discount").between(0, 1),
            "quantity_positive": F.col("l_quantity") > 0}),
        Q.table_audit(t("orders"), "orders", {"o_custkey": (t("customer"), "c_custkey")}),
        Q.table_audit(t("customer"), "customer", {"c_nationkey": (t("nation"), "n_nationkey")}),
        Q.table_audit(t("supplier"), "supplier", {"s_nationkey": (t("nation"), "n_nationkey")}),
        Q.table_audit(t("nation"), "nation", {"n_regionkey": (t("region"), "r_regionkey")}),
        Q.table_audit(meters, "meter_readings", rules={
            "hour_between_0_23": F.hour("timestamp").between(0, 23),
            "meter_id_not_null": F.col("meter_id").isNotNull(),
            "consumption_non_negative": F.col("consumption_kwh") >= 0,
            "voltage_in_180_260": F.col("voltage_v").between(180, 260),
            "power_factor_in_0_1": F.col("power_factor").between(0, 1)}),
    ]
    return Q.constraint_audit(checks)


def q_table_profiles(spark, sf):
    frames = [Q.profile(read_table(spark, sf, n), n) for n in TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_validation_checks(spark, sf):
    return Q.validation_checks(annual(spark, sf), clean_meters(spark, sf), provinces(spark, sf),
                               monthly(spark, sf))


def _metrics(spark, sf):
    raw = raw_meters(spark, sf)
    lo = {t: b[0] for t, b in EVENT_TYPE_BOUNDS.items()}
    hi = {t: b[1] for t, b in EVENT_TYPE_BOUNDS.items()}
    typ, kwh = F.col("consumer_type"), F.col("consumption_kwh")
    in_bounds = F.lit(True)
    for t in EVENT_TYPE_BOUNDS:
        in_bounds = F.when(typ == t, kwh.between(lo[t], hi[t])).otherwise(in_bounds)
    meter_valid = F.col("voltage_v").between(180, 260) & in_bounds
    orders = read_table(spark, sf, "orders")
    lineitem = read_table(spark, sf, "lineitem")
    dq = (Q.data_quality("meter_readings", raw, meter_valid)
          .unionByName(Q.data_quality("orders", orders, (F.col("o_totalprice") > 0)
                                      & F.col("o_orderstatus").isin("F", "O", "P")))
          .unionByName(Q.data_quality("lineitem", lineitem, F.col("l_discount").between(0, 0.08))))
    prov = provinces(spark, sf)
    loss = Q.metric_rows(prov, "system_loss_pct", F.col("system_loss_pct"),
                         {"province": F.col("province_name")})
    peak = Q.metric_rows(annual(spark, sf), "peak_demand_mw", F.col("peak_demand_mw"),
                         {"fiscal_year": F.col("fiscal_year")})
    return dq, loss.unionByName(peak)


def q_quality_and_alerts(spark, sf):
    dq, other = _metrics(spark, sf)
    alerts = Q.check_alerts(dq.unionByName(other), min_quality=95.0)
    return alerts.select("severity", "metric", "value", "threshold", label_text().alias("label"),
                         Q.panel_band(F.col("value") / F.col("threshold"),
                                      [(0.9, "orange"), (1.0, "red")]).alias("band"))


def q_recent_runs(spark, sf):
    return U.recent_runs(U.pipeline_runs_from_events(read_table(spark, sf, "events")), 20)


def q_daily_summary(spark, sf):
    return U.daily_summary(M.peak_calendar(clean_meters(spark, sf)), "2024-01-15")


def q_daily_summary_fallback(spark, sf):
    return U.monthly_fallback(monthly(spark, sf))


def q_period_report(spark, sf):
    return U.period_reports(S.monthly_trends(monthly(spark, sf)), S.annual_summary(annual(spark, sf)),
                            R.system_losses_by_province(provinces(spark, sf)), 1998, 6, "1998/99")


def q_panel_colours(spark, sf):
    dq, other = _metrics(spark, sf)
    runs = U.recent_runs(U.pipeline_runs_from_events(read_table(spark, sf, "events")), 20)
    run = {"run": F.col("run_id")}
    metrics = (dq.unionByName(other).unionByName(Q.metric_rows(runs, "pipeline_status", F.col("records_loaded"), run))
               .unionByName(Q.metric_rows(runs, "pipeline_duration_minutes", F.col("duration_minutes"), run)))
    return Q.panel_colours(metrics).select("name", "value", label_text().alias("label"), "colour")


def label_text():
    return F.array_join(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def q_load_stage(spark, sf):
    """Two runs of the load stage on the same batch; the second finds all
    readings stored.  Rows per table and run, and the run log's totals."""
    base = ST.run_dir(_stream_base(spark), "load")
    frames = {"annual": annual(spark, sf), "monthly": S.monthly_trends(monthly(spark, sf)),
              "smart_meter": clean_meters(spark, sf), "province": provinces(spark, sf),
              "weather": weather_observations(read_table(spark, sf, "lineitem"))}
    out = None
    for run in (1, 2):
        part = LS.load_totals(spark, LS.run_load(spark, frames, base)).withColumn("run", F.lit(run))
        out = part if out is None else out.unionByName(part)
    log = spark.read.parquet(f"{base}/pipeline_runs").groupBy("status").agg(F.sum("records_loaded").alias("rows_loaded"))
    return out.select("run", "table_name", "rows_loaded").unionByName(
        log.select(F.lit(0).alias("run"), F.concat(F.lit("log:"), F.col("status")).alias("table_name"), "rows_loaded"))


def q_metric_state(spark, sf):
    """Q4 and Q5: extraction, load and peak metrics of the tables; the last value
    by labels and the running total of metric events."""
    events = read_table(spark, sf, "events").filter(F.col("ts").isNotNull())
    stream = events.select(F.col("event_type").alias("name"), "value", F.create_map(
        F.lit("unit"), (F.col("user_id") % 5).cast("string")).alias("labels"), "ts", "event_id")
    latest = Q.latest_metrics(stream, "event_id").select(F.lit("latest").alias("kind"), "name", "value", "labels")
    total = Q.increment_totals(stream).select(F.lit("total").alias("kind"), "name", "value",
                                              F.create_map().cast("map<string,string>").alias("labels"))
    extracted = events.groupBy(F.col("event_type").alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("seconds"))
    loaded = events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count_if(F.col("value") < 1).alias("errors"))
    stage = LS.stage_metrics(extracted, loaded, annual(spark, sf)).select(F.lit("stage").alias("kind"), "name", "value", "labels")
    return latest.unionByName(total).unionByName(stage).select(
        "kind", "name", snap("value", 6).alias("value"), label_text().alias("label"))


def q_weather_payload_decode(spark, sf):
    """S11 over payloads built from line items: rain only where the line is open."""
    li = read_table(spark, sf, "lineitem")
    rain = F.when(F.col("l_linestatus") == "O", F.struct(F.col("l_tax").alias("1h")))
    payload = F.to_json(F.struct(
        F.struct(F.col("l_quantity").alias("temp"), (F.col("l_quantity") + 5).alias("temp_max"),
                 (F.col("l_quantity") - 5).alias("temp_min"), (F.col("l_quantity") - 1).alias("feels_like"),
                 F.col("l_extendedprice").alias("humidity")).alias("main"),
        F.struct((F.col("l_linenumber") * 0.5).alias("speed")).alias("wind"),
        F.struct(F.col("l_discount").alias("all")).alias("clouds"), rain.alias("rain"),
        F.array(F.struct(F.col("l_returnflag").alias("description"))).alias("weather")))
    return decode_weather(li.select("l_orderkey", "l_linenumber", payload.alias("payload")))


def q_landed_weather_files(spark, sf):
    """S11 from a folder: payloads of the line items are landed as text, a line
    each, those of fully taxed returns cut short and those of the last line
    number without a temperature; good and bad ones by description."""
    li = read_table(spark, sf, "lineitem")
    temp = F.when(F.col("l_linenumber") < 7, F.col("l_quantity"))
    whole = F.to_json(F.struct(
        F.struct(temp.alias("temp"), F.col("l_extendedprice").alias("humidity")).alias("main"),
        F.array(F.struct(F.col("l_returnflag").alias("description"))).alias("weather")))
    cut = (F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.08)
    folder = ST.run_dir(_stream_base(spark), "landed")
    li.select(F.when(cut, F.substring(whole, 1, 12)).otherwise(whole).alias("value")).write.text(folder)
    good, bad = split_bad(weather_files(read_payloads(spark, folder, lines=True)))
    bounds = [F.count(F.lit(1)).alias("payloads"), F.min("avg_temp_c").alias("low"), F.max("avg_temp_c").alias("high"),
              F.max("humidity_pct").alias("humidity"), F.sum("rainfall_mm").alias("rain")]
    return good.groupBy(F.col("weather_desc").alias("label")).agg(*bounds).unionByName(
        bad.groupBy(F.col("reason").alias("label")).agg(F.count(F.lit(1)).alias("payloads")), allowMissingColumns=True)


def q_worldbank_payload_decode(spark, sf):
    """S10 over one ``[meta, rows]`` payload an order priority: a row a year, no
    value where the year is even and the priority low."""
    orders = read_table(spark, sf, "orders")
    g = orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(
        snap(F.avg("o_totalprice") / 1000, 4).alias("v"))
    value = F.when(~((F.col("o_orderpriority") == "5-LOW") & (F.col("y") % 2 == 0)), F.col("v"))
    rows = g.groupBy("o_orderpriority").agg(F.collect_list(F.struct(  # a row a year: bounded by the calendar
        F.col("y").cast("string").alias("date"), value.alias("value"))).alias("r"))
    payload = F.concat(F.lit('[{"page": 1}, '), F.to_json("r"), F.lit("]"))
    return decode_worldbank(rows.select(payload.alias("payload")))


def q_dashboard_export(spark, sf):
    return U.dashboard_export(S.annual_summary(annual(spark, sf)))


def q_dashboard_hourly_profile(spark, sf):
    g = clean_meters(spark, sf).groupBy("hour", "consumer_type").agg(
        F.avg("consumption_kwh").alias("_v"))
    return g.select(F.col("hour").cast("string").alias("time"),
                    F.col("consumer_type").alias("metric"), snap("_v", 6).alias("value"))


def q_dashboard_fiscal_years(spark, sf):
    return annual(spark, sf).select("fiscal_year").distinct().orderBy(F.col("fiscal_year").desc())


def q_dashboard_loss_by_province(spark, sf):
    dim = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("province_id"),
                                                 F.col("n_name").alias("province_name_en"))
    p = provinces(spark, sf).filter(F.col("report_year") == 2023).join(dim, "province_id")
    return p.select(F.col("province_name_en").alias("metric"),
                    F.col("system_loss_pct").alias("value"),
                    F.col("per_capita_kwh_2023").alias("per_capita_kwh")) \
        .orderBy(F.col("value").desc(), "metric")


def q_dashboard_import_export(spark, sf):
    return annual(spark, sf).select("fiscal_year", F.col("energy_imported_gwh").alias("Imported"),
                                    F.col("energy_exported_gwh").alias("Exported")) \
        .orderBy("fiscal_year")


def q_tariff_asof(spark, sf):
    orders = read_table(spark, sf, "orders")
    from ..functions import calendar as cal
    start = cal.fiscal_year_start("o_orderdate")
    rates = (orders.groupBy(F.col("o_orderpriority").alias("tariff_code"), start.alias("_y"))
             .agg(snap(F.avg("o_totalprice") / 1e4, 4).alias("rate")))
    w = Window.partitionBy("tariff_code").orderBy("effective_from")
    frm = F.make_timestamp_ntz(F.col("_y"), F.lit(7), F.lit(17), F.lit(0), F.lit(0), F.lit(0))
    rates = rates.select("tariff_code", "rate", frm.alias("effective_from")) \
        .withColumn("effective_to", F.lead("effective_from").over(w))
    facts = orders.select("o_orderkey", F.col("o_orderpriority").alias("tariff_code"),
                          "o_orderdate", "o_totalprice")
    j = L.range_join(facts, rates, "tariff_code", "o_orderdate")
    return j.select("o_orderkey", "tariff_code", "o_orderdate", "rate", "effective_from",
                    snap(F.col("o_totalprice") / 1000 * F.col("rate"), 2).alias("charge"))


def q_json_payload_decode(spark, sf):
    return decode_props(read_table(spark, sf, "events"))


def _stream_base(spark):
    return checkpoint_folder(spark)


def q_stream_ingest_parity(spark, sf):
    """Two triggers of one job: the newer half of the events arrives first, the
    older half afterwards."""
    job = ST.run_dir(_stream_base(spark), "ingest")
    events, cut = read_table(spark, sf, "events"), F.to_timestamp_ntz(F.lit("2024-01-15"))
    for late in (False, True):
        part = events.filter(F.col("ts") < cut if late else (F.col("ts") >= cut) | F.col("ts").isNull())
        part.write.mode("append").parquet(f"{job}/landed")
        out = ST.ingest_deduplicated(spark, f"{job}/landed", job, pattern="part-*.parquet")
    return out


def q_stream_hourly_load(spark, sf):
    out = ST.run_dir(_stream_base(spark), "hourly")
    df = ST.hourly_load_stream(spark, sf, out)
    return df.select("hour_start", "consumer_type", snap("total_kwh", 6).alias("total_kwh"),
                     snap("avg_voltage", 6).alias("avg_voltage"), snap("avg_pf", 6).alias("avg_pf"),
                     "readings")


def q_stream_sessions(spark, sf):
    return ST.low_consumption_sessions(raw_meters(spark, sf), "2 hours")


QUERIES = {
    "date_dimension": q_date_dimension,
    "daily_system_load": q_daily_system_load,
    "dashboard_monthly_series": q_dashboard_monthly_series,
    "upsert_merge": q_upsert_merge,
    "upsert_monthly": q_upsert_monthly,
    "append_new_only": q_append_new_only,
    "merge_by_file": q_merge_by_file,
    "constraint_audit": q_constraint_audit,
    "table_profiles": q_table_profiles,
    "validation_checks": q_validation_checks,
    "quality_and_alerts": q_quality_and_alerts,
    "recent_runs": q_recent_runs,
    "daily_summary": q_daily_summary,
    "daily_summary_fallback": q_daily_summary_fallback,
    "period_report": q_period_report,
    "dashboard_export": q_dashboard_export,
    "dashboard_hourly_profile": q_dashboard_hourly_profile,
    "dashboard_fiscal_years": q_dashboard_fiscal_years,
    "dashboard_loss_by_province": q_dashboard_loss_by_province,
    "dashboard_import_export": q_dashboard_import_export,
    "tariff_asof": q_tariff_asof,
    "json_payload_decode": q_json_payload_decode,
    "weather_payload_decode": q_weather_payload_decode,
    "worldbank_payload_decode": q_worldbank_payload_decode,
    "landed_weather_files": q_landed_weather_files,
    "load_stage": q_load_stage,
    "metric_state": q_metric_state,
    "panel_colours": q_panel_colours,
    "stream_ingest_parity": q_stream_ingest_parity,
    "stream_hourly_load": q_stream_hourly_load,
    "stream_sessions": q_stream_sessions,
}
