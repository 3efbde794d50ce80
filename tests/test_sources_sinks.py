import os
import tempfile

import pytest
from pyspark.sql import functions as F

from meterlens.operators import series as S
from meterlens.sources import raw
from meterlens.sources.sinks import export_csv, load_dataframe, read_current, write_version

ANNUAL_CSV = """fiscal_year,fiscal_year_bs,total_energy_gwh,domestic_gwh,industrial_gwh,commercial_gwh,irrigation_gwh,other_gwh,peak_demand_mw,total_consumers,per_capita_kwh,system_loss_pct,energy_imported_gwh,energy_exported_gwh,installed_capacity_mw
 2016/17 ,x,4770,1860,1580,870,230,230,1265,3350000,165,22.8,1620,480,1112
2015/16,x,3720,1450,1230,680,180,180,1170,3150000,131,24.5,1850,320,897
"""
PROVINCE_CSV = """province_id,province_name,province_name_np,headquarter,area_sq_km,population_2021,households_2021,electrification_pct_2021,electricity_consumers_2023,annual_consumption_gwh_2023,per_capita_kwh_2023,peak_demand_mw_2023,installed_capacity_mw_2023,transmission_lines_km,distribution_lines_km,system_loss_pct,major_projects
1,East,पूर्व,Town A,25905,4972521,1202457,94.8,612450,1480,297,425,842,1240,8650,16.2,"Plant A, Plant B, Plant C"
2,South,दक्षिण,Town B,not-a-number,6126288,1306480,89.2,545820,1210,197,312,185,680,7840,18.9,"Solar, Corridor"
"""


def _write(folder, name, text):
    p = os.path.join(folder, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_raw_csv_declared_schema_and_annual_derivations(spark):
    d = tempfile.mkdtemp(prefix="ml-raw-")
    paths = {"annual": _write(d, "annual.csv", ANNUAL_CSV),
             "province_electricity": _write(d, "province.csv", PROVINCE_CSV),
             "weather": os.path.join(d, "missing.csv")}
    with pytest.raises(FileNotFoundError):
        raw.extract_bundle(spark, paths)
    bundle = raw.extract_bundle(spark, {k: f"file://{p}" for k, p in paths.items()}, optional={"weather"})
    assert set(bundle) == {"annual", "province_electricity"}
    s = S.annual_summary(S.clean_annual(bundle["annual"])).orderBy("fiscal_year").collect()
    assert [r.fiscal_year for r in s] == ["2015/16", "2016/17"]     # trimmed, sorted
    assert (s[0].net_energy_gwh, s[0].self_sufficiency_ratio, s[0].load_factor_pct) == (5250.0, 0.7086, 36.3)
    assert abs(s[1].total_energy_gwh_yoy_pct - 28.2258064516129) < 1e-9
    assert s[1].trade_balance_gwh == -1140.0
    p = {r.province_id: r for r in bundle["province_electricity"].collect()}
    assert p[1].major_projects == "Plant A, Plant B, Plant C" and p[1].province_name_np == "पूर्व"
    assert p[2].area_sq_km is None and "not-a-number" in p[2]._corrupt_record  # the bad row's text is kept
    assert p[1]._corrupt_record is None


def test_stored_or_and_weather_range(spark):
    d = tempfile.mkdtemp(prefix="ml-stored-")
    fallback = spark.range(2)
    assert raw.stored_or(spark, f"file://{d}/none", fallback).count() == 2
    spark.range(5).write.parquet(f"{d}/there")
    assert raw.stored_or(spark, f"file://{d}/there", fallback).count() == 5
    head = raw.WEATHER_SCHEMA.split(", ")
    names = [h.split()[0] for h in head]
    rows = [["2024-01-0%d" % k, "ST"] + ["x" if "string" in h else "1" for h in head[2:]] for k in (1, 2, 3)]
    path = _write(d, "w.csv", "\n".join([",".join(names), *[",".join(r) for r in rows]]) + "\n")
    got = raw.load_weather(spark, path, "2024-01-02", "2024-01-03")
    assert [str(r.date) for r in got.orderBy("date").collect()] == ["2024-01-02", "2024-01-03"]


def test_versioned_table_and_load_count(spark):
    base = tempfile.mkdtemp(prefix="ml-sink-")
    t = os.path.join(base, "annual")
    v1 = write_version(spark.createDataFrame([("2015/16", 1.0)], "fiscal_year string, v double"), t, 1)
    v2 = write_version(spark.createDataFrame([("2015/16", 2.0), ("2016/17", 3.0)],
                                             "fiscal_year string, v double"), t, 2)
    assert (v1, v2) == (1, 2)
    assert sorted(tuple(r) for r in read_current(spark, t).collect()) == [("2015/16", 2.0), ("2016/17", 3.0)]
    write_version(spark.createDataFrame([("2015/16", 4.0)], "fiscal_year string, v double"), t, 2)  # a retry replaces
    assert [tuple(r) for r in read_current(spark, t).collect()] == [("2015/16", 4.0)]
    spark.range(3).write.parquet(f"{t}/version=9")                                                # unfinished: no pointer
    assert read_current(spark, t).columns == ["fiscal_year", "v"]
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.0, "y")], "id int, v double, cleaned_at string")
    n = load_dataframe(df, os.path.join(base, "facts"), "replace")
    back = spark.read.parquet(os.path.join(base, "facts"))
    assert load_dataframe(df.limit(0), os.path.join(base, "facts"), "replace") == 0   # empty input replaces nothing
    assert n == 2 and "cleaned_at" not in back.columns
    assert back.filter(F.col("v").isNull()).count() == 1
    export_csv(back, os.path.join(base, "export"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(base, "export")) if f.endswith(".csv")]) == 1


def test_analysis_bundles_run(spark):
    from meterlens.pipeline import analysis_bundles
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    b = analysis_bundles(spark, sf)
    assert set(b) == {"consumption", "peak_demand", "weather", "province"}
    for group in b.values():
        for df in group.values():
            assert df.count() >= 1


def test_pipeline_writes_every_output(spark):
    from meterlens import pipeline
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = tempfile.mkdtemp(prefix="ml-pipe-")
    timings = pipeline.run(spark, sf, out_dir=out, parallelism=2)
    assert len(timings) == 23
    for name in timings:
        assert spark.read.parquet(os.path.join(out, name)).count() >= 0
    assert spark.read.parquet(os.path.join(out, "dashboard_data")).count() >= 1
