"""Trained models: gradients, optimality, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterlens.llm import language_id, linear_svm, quality, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, y int, score double, letters boolean, h long"


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_dual_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(0)
    x = r.normal(size=(80, 5)) + 0.3
    s = np.where(x @ np.array([1, -2, 0.5, 0, 1]) + 0.2 * r.normal(size=80) > 0.3, 1.0, -1.0)
    rows = [np.arange(5)] * 80
    w, b = linear_svm.fit(rows, list(x), s, 5, cost=0.7, epochs=2000, tolerance=1e-9)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + 0.7 * np.maximum(0, 1 - s * (x @ w + b)).sum()

    best = loss(w, b)
    for _ in range(300):
        assert best <= loss(w + 0.01 * r.normal(size=5), b + 0.01 * r.normal()) + 1e-6


def test_calibration_rises_with_the_margin():
    m = np.r_[np.linspace(-3, 0.5, 50), np.linspace(-0.5, 3, 50)]
    a, c = linear_svm.calibrate(m, np.r_[np.zeros(50, bool), np.ones(50, bool)])
    assert a > 0 and abs(c) < 1


def test_network_gradients_equal_differences():
    net = toxicity.Network(hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x, mask = r.normal(size=(5, 7, toxicity.INPUTS)), np.arange(7) < np.array([7, 3, 5, 1, 6])[:, None]
    y, w = np.array([1, 0, 1, 0, 1.0]), np.array([1, 2, 1, 0.5, 1.0])
    _, g = net.gradients(x, mask, y, w)
    for k, v in net.p.items():
        flat = v.reshape(-1)
        for i in r.choice(len(flat), min(5, len(flat)), replace=False):
            old, e = flat[i], 1e-5
            flat[i] = old + e
            up, _ = net.gradients(x, mask, y, w)
            flat[i] = old - e
            down, _ = net.gradients(x, mask, y, w)
            flat[i] = old
            assert abs((up - down) / (2 * e) - g[k].reshape(-1)[i]) < 1e-6


def test_windows_overlap_and_cover_every_word():
    for n in (0, 1, 16, 31, 32, 33, 47, 48, 49, 1000):
        words = toxicity.Words(pa.array(["lead " * 3, " ".join(f"w{i}" for i in range(n)), ""]))
        index, row = toxicity.windows(words, 3)
        mine = index[row == 1]
        names = {int(i) for i in mine.ravel() if i < len(words.hash)}
        assert names == set(words.word[words.row == 1].tolist())
        assert len(mine) == (0 if n == 0 else 1 + max(0, -(-(n - 32) // 16)))


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.93), (toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, tables, module, label, least):
    docs, labels = tables
    got = module.score(docs, module.train_model(docs, labels)).join(labels, "doc_id").toPandas()
    assert got["score"].between(0, 1).all()
    assert (got["held_out"] == got["doc_id"].map(held_out)).all()
    mine = got[got["held_out"]]
    assert (mine["predicted"] == mine[label]).mean() >= least


def test_language_accuracy(spark, tables):
    docs = tables[0]
    got = language_id.predict(docs, language_id.train_model(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    mine = got[got["held_out"]]
    assert (mine["lang_pred"] == mine["lang"]).mean() >= 0.97
    assert got["score"].between(0, 1).all()


def odd_rows():
    good = "the quiet words of a plain and decent text about nothing in particular"
    rows = [(i, f"{good} number{i % 7}" if i % 2 else f"{good} you stupid number{i % 7}", "en" if i % 3 else "fr", i % 2, 0.1, True, 1)
            for i in range(60)]
    rows += [(100, None, None, 0, 0.1, None, 1), (101, "", "en", 1, 0.1, None, 1), (102, "123 *** !!", "en", 1, 0.1, None, 1),
             (103, "x" * 40_000, "en", 0, 0.1, None, 1), (104, "word " * 30_000 + "stupid", None, 0, 0.1, None, 1), (None, good, "en", 0, 0.1, None, 1),
             (1, f"{good} number1", "en", 1, 0.1, True, 1)]
    return rows


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_odd_rows(spark, module):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, DOCS)
    marks = [(r[0], None if r[0] == 3 else (r[0] or 0) % 2, None if r[0] == 4 else 1 - (r[0] or 0) % 2) for r in rows[:60]]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    label = "toxic" if module is toxicity else "quality"
    model = module.train_model(docs, labels, label)
    got = module.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.held_out == held_out(r.doc_id) for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    empty = {r.doc_id: r.score for r in got}
    assert empty[100] == empty[101]
    assert module.score(docs.filter("doc_id = -1"), model).count() == 0
    for some in (labels.filter("doc_id = -1"), labels.filter(f"{label} = 1")):  # nothing, or one class, to learn from
        flat = module.score(docs, module.train_model(docs, some, label)).select("score").distinct().collect()
        assert len(flat) == 1


def test_toxic_windows_far_into_a_text(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    labels = spark.createDataFrame([(r[0], 1 - r[0] % 2) for r in odd_rows()[:60]], "doc_id long, toxic int")
    model = toxicity.train_model(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[104] > 0.7 > got[103]
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert 104 not in {r.doc_id for r in kept.collect()} and kept.filter("doc_id IS NULL").count() == 1


def test_languages_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    model = language_id.train_model(docs)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(odd_rows())
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {100, 101, 102} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in language_id.keep_known(docs).collect()} == und
    nothing = language_id.train_model(docs.filter("lang = 'none'"))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    alone = language_id.train_model(docs.filter("lang = 'fr'"))
    assert {r.lang_pred for r in language_id.predict(docs, alone).collect()} == {"und", "fr"}


def test_pairs_decide_inside_a_family(spark):
    r = np.random.default_rng(1)
    stems = {"es": ["ción", "que", "los"], "fr": ["eau", "oi", "les"], "de": ["sch", "ung", "ein"], "nl": ["ij", "aan", "het"], "eo": ["oj", "kaj", "estas"]}
    rows = [(k * 100 + i, " ".join("".join(r.choice(s, 2)) for _ in range(30)), code) for k, (code, s) in enumerate(stems.items()) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train_model(docs)
    assert set(model.pairs) == {("es", "fr"), ("de", "nl")} and len(model.tops) == 3
    got = language_id.predict(docs, model).join(docs, "doc_id").collect()
    assert np.mean([x.lang == x.lang_pred for x in got]) > 0.98
