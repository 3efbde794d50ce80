"""Landed payload folders: parity with the decoders, bad files aside, files read once."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from meterlens.sources import landed as L
from meterlens.sources.payloads import decode_weather, decode_worldbank

NAMES = {"name_pattern": r"^([A-Z]+\d+)_(\d{4}-\d{2}-\d{2})\.json$", "name_columns": ("station_id", "date")}


def observation(temp, rain=None):
    return {"main": {"temp": temp, "temp_max": temp + 5, "temp_min": temp - 5, "feels_like": temp, "humidity": 60.0},
            "wind": {"speed": 2.5}, "clouds": {"all": 40.0}, "weather": [{"description": "haze"}],
            **({"rain": {"1h": rain}} if rain is not None else {})}


def put(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def weather_folder():
    d = tempfile.mkdtemp(prefix="ml-landed-")
    put(d, "KTM001_2024-01-01.json", json.dumps(observation(12.0, 1.5), indent=2))
    put(d, "KTM001_2024-01-02.json", json.dumps(observation(13.0)))
    put(d, "PKR002_2024-01-01.json", '{"main": {"temp": 1')  # cut short
    put(d, "PKR002_2024-01-02.json", json.dumps({"cod": 404, "message": "city not found"}))
    put(d, "PKR002_2024-01-03.json", "<html>busy</html>")
    put(d, "empty_file.json", "")
    put(d, "notes.json", json.dumps(observation(9.0)))
    return d


def test_weather_files_decode_as_the_decoder_does(spark):
    files = L.read_payloads(spark, weather_folder(), **NAMES)
    good, bad = L.split_bad(L.weather_files(files))
    got = {r.file: r for r in good.collect()}
    assert set(got) == {"KTM001_2024-01-01.json", "KTM001_2024-01-02.json", "notes.json"}
    assert got["notes.json"].station_id is None and got["KTM001_2024-01-01.json"].date == "2024-01-01"
    texts = files.filter(F.col("file").isin(*got))
    want = {r.file: r for r in decode_weather(texts).drop("malformed").collect()}
    assert {k: v.asDict() for k, v in got.items()} == {k: v.asDict() for k, v in want.items()}
    aside = {r.file: (r.reason, r.payload) for r in bad.collect()}
    assert set(aside) == {f"PKR002_2024-01-0{i}.json" for i in (1, 2, 3)}  # an empty file gives no row
    assert aside["PKR002_2024-01-02.json"][0] == "no temperature"
    assert aside["PKR002_2024-01-03.json"] == ("not a JSON object", "<html>busy</html>")


def test_worldbank_files(spark):
    d = tempfile.mkdtemp(prefix="ml-landed-")
    text = json.dumps([{"page": 1}, [{"date": "2015", "value": 131.5}, {"date": "2014", "value": None},
                                     {"date": "2013", "value": 119.0}, {"date": "n/a", "value": 1.0}]])
    put(d, "a.json", text)
    put(d, "b.json", json.dumps([{"message": [{"id": "120"}]}]))
    put(d, "c.json", "[1, [")
    good, bad = L.split_bad(L.worldbank_files(L.read_payloads(spark, d)))
    rows = {(r.year, r.per_capita_kwh_wb) for r in good.collect()}
    assert rows == {(2015, 131.5), (2013, 119.0), (None, 1.0)}
    only = text.replace(', {"date": "n/a", "value": 1.0}', "")
    want = {(r.year, r.per_capita_kwh_wb) for r in decode_worldbank(spark.createDataFrame([(only,)], "payload string")).collect()}
    assert want <= rows
    assert {r.file for r in bad.collect()} == {"b.json", "c.json"}


def test_ingest_reads_a_file_once_and_repeats_a_failed_batch(spark):
    d, job = weather_folder(), tempfile.mkdtemp(prefix="ml-landed-job-")

    def broken(df):
        raise OSError("lost")

    with pytest.raises(Exception):
        L.ingest(spark, d, job, broken, **NAMES)
    good, bad = L.ingest(spark, d, job, L.weather_files, files_per_trigger=2, **NAMES)
    batch_good, batch_bad = L.split_bad(L.weather_files(L.read_payloads(spark, d, **NAMES)))
    assert sorted(map(str, good.collect())) == sorted(map(str, batch_good.collect())) and good.count() == 3
    assert sorted(r.file for r in bad.collect()) == sorted(r.file for r in batch_bad.collect())
    put(d, "KTM001_2024-01-03.json", json.dumps(observation(20.0)))
    good, _ = L.ingest(spark, d, job, L.weather_files, **NAMES)
    assert sorted(r.avg_temp_c for r in good.collect()) == [9.0, 12.0, 13.0, 20.0]
    good, _ = L.ingest(spark, d, job, L.weather_files, **NAMES)
    assert good.count() == 4


def test_payloads_by_line_and_an_empty_folder(spark):
    d = tempfile.mkdtemp(prefix="ml-landed-")
    os.makedirs(f"{d}/sub")
    put(f"{d}/sub", "x.txt", "\n".join([json.dumps(observation(1.0)), "", "oops", json.dumps(observation(2.0))]))
    good, bad = L.split_bad(L.weather_files(L.read_payloads(spark, d, lines=True)))
    assert sorted(r.avg_temp_c for r in good.collect()) == [1.0, 2.0] and [r.payload for r in bad.collect()] == ["oops"]
    assert L.read_payloads(spark, tempfile.mkdtemp(prefix="ml-landed-")).isEmpty()
