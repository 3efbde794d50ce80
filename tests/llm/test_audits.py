"""Collocations, fingerprints and the filter audit against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest

from meterlens.llm import collocations, filter_audit, fingerprints

DOCS = "doc_id long, text string, lang string, source string, n int"


def _random_docs(rng, n=60):
    vocabulary = ["alpha", "beta", "Gamma", "dé", "x", "long-word", "..", "A&B"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 3, 40, 300]))
        text = "".join(w + rng.choice([" ", " ", "\t", ". ", "\n", ", "]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None, ""]), 0))
    rows += [(n + i, rows[5][1], "en", "a", 0) for i in range(30)] + [(n + 40, None, None, None, None), (n + 41, "", "en", "b", 0)]
    return rows


def _plain_collocations(rows, min_count, top, longest=3):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cand.items():
        score, _, l, r = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        inside = any(g[0] == lang and len(g[1]) > len(w) and 100 * b >= 50 * a
                     and any(g[1][i:i + len(w)] == w for i in range(len(g[1]))) for g, b in cand.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    got = []
    for lang, group in itertools.groupby(sorted(out), key=lambda x: x[0]):
        got += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (_, s, a, p, l, r) in enumerate(list(group)[:top])]
    return got


@pytest.mark.parametrize("longest,every", [(3, 24), (2, 3), (4, 2)])
def test_collocations_equal_plain_counts(spark, monkeypatch, longest, every):
    monkeypatch.setattr(collocations, "EVERY", every)
    rows = _random_docs(random.Random(longest))
    docs = spark.createDataFrame(rows, DOCS)
    got = collocations.collocations(docs, max_words=longest, min_count=3, top=25).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == _plain_collocations(rows, 3, 25, longest)


def test_parse_owns_every_word_once_and_bounds_chunks(spark):
    text = "same " * 5000 + ". " + "other words here " * 700
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (2, text, "en", "s", 0)], DOCS)
    parse = collocations.chunk_dictionary(docs).collect()
    assert max(len(r.chunk.split()) for r in parse) <= collocations.MAX_TOKENS + 2
    words = sum(r.n * sum(t != "." for t in r.chunk.split()[:-2]) for r in parse)
    assert words == 2 * (5000 + 2100)
    assert all(r.n % 2 == 0 for r in parse)  # both copies parse alike


def test_collocation_score_is_exact_beyond_64_bits(spark):
    big = 4_000_000_011
    counts = spark.createDataFrame([("en", "", 3 * big, 0), ("en", "a", big + 2, 1), ("en", "b", big + 7, 1), ("en", "a b", big, 2)],
                                   "lang string, phrase string, f long, size int")
    r = collocations.score(counts, 3).first()
    assert r.score == 10**6 * big * big // ((big + 2) * (big + 7))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert collocations.collocations(docs).count() == 0
    assert fingerprints.versions(docs).count() == 0
    assert filter_audit.audit(filter_audit.document_cells(docs, labels)).count() == 0


def _paragraphs(text):
    return {p for p in re.split(r"[.!?\r\n]+[ \t\n\x0b\f\r]*", text) if p}


def _plain_versions(rows):
    ordered = sorted(rows, key=lambda r: r[0])
    texts = [r[1] or "" for r in ordered]
    for i, (row, text) in enumerate(zip(ordered, texts)):
        after = texts[(i + 1) % len(texts)]
        h = len(text) // 2
        edited = text[:len(text) - h] + after[:h]
        own, ed, nx = _paragraphs(text), _paragraphs(edited), _paragraphs(after)
        near = [1.0 if not own and not x else 2 * len(own & x) / (len(own) + len(x)) for x in (ed, nx)]
        yield row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), near, len(own ^ ed), len(own ^ nx)


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_fingerprints_equal_plain_sets(spark, monkeypatch, block_rows):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", block_rows)
    rng = random.Random(3)
    rows = []
    for i in range(90):
        n = rng.choice([0, 1, 2, 9, 40, 600])
        rows.append((3 * i, "".join(f"Sätze {rng.randrange(10**6)} hier{rng.choice(['. ', '!', chr(10)])}" for _ in range(n)), "en", "s", 0))
    rows += [(1000 + i, rows[4][1] or "one. two.", "en", "s", 0) for i in range(20)] + [(2000, None, None, None, None), (2001, "...\n", "en", "s", 0)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in fingerprints.versions(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    assert len(got) == len(rows)
    for doc_id, n_chars, sha, near, d_edited, d_next in _plain_versions(rows):
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n_chars, sha)
        assert [r.near_edited, r.near_next] == pytest.approx(near)
        assert (len(r.edited_diff), len(r.next_diff)) == (d_edited, d_next)
    by_text = {}
    for doc_id, text, *_ in rows:
        assert by_text.setdefault(text or "", got[doc_id].fingerprint) == got[doc_id].fingerprint


def test_fingerprint_recovers_the_differing_digests(spark):
    a = " ".join(f"Line {i}." for i in range(500))
    b = a.replace("Line 7.", "Line seven.").replace("Line 90.", "")
    df = spark.createDataFrame([(a, b)], "a string, b string").selectExpr("a", "b")
    df = df.withColumn("ka", fingerprints.digests(df.a)).withColumn("kb", fingerprints.digests(df.b))
    for k in ("a", "b"):
        df = df.selectExpr("*", f"{fingerprints.sketch_sql('k' + k, fingerprints.WIDTH)} AS s{k}")
    r = fingerprints.difference(df, "ka", "kb", "sa", "sb", "diff").selectExpr(
        "diff", "array_except(ka, kb) AS gone", "array_except(kb, ka) AS new").first()
    assert sorted((d.k, d.n) for d in r["diff"]) == sorted([(k, 1) for k in r.gone] + [(k, -1) for k in r.new])
    assert len(r.gone) == 2 and len(r.new) == 1


def test_fingerprints_of_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 5)
    rows = [(None, "n.", "en", "s", 0)] * 3 + [(7, f"text {i % 4}.", "en", "s", 0) for i in range(40)] + [(9, "z", "en", "s", 0)]
    got = fingerprints.versions(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(r.doc_id for r in got) == Counter({None: 3, 7: 40, 9: 1})
    assert all(0 <= r.near_next <= 1 for r in got)


def _plain_audit(rows, labels):
    good = {d for d, q, t in labels if q == 1 and d is not None}
    toxic = {d for d, q, t in labels if t == 1 and d is not None}
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    parts = {}
    for doc_id, text, _, source, _ in rows:
        t = text or ""
        w = re.findall(r"[^ \t-\r]+", t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search("[#$%&*|]", t)), doc_id is not None and smallest[t] < doc_id)) if f}
        parts.setdefault(source or "", []).append((doc_id, fails))
    out = {}
    for part, docs in parts.items():
        share = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                hit = [d for d in left if f in d[1]]
                stay = [d for d in left if f not in d[1]]
                share[f] += len(hit)
                out[part, order, step] = [len(stay), len(hit), sum(f in d[1] for d in docs) - len(hit), sum(d[1] == {f} for d in docs),
                                          sum(d[0] in good for d in hit), sum(d[0] in toxic for d in hit)]
                left = stay
        for (p, order, step), v in out.items():
            if p == part:
                v.append(share[order[step - 1]])
    return out


def test_audit_equals_plain_application(spark):
    rng = random.Random(8)
    rows = _random_docs(rng) + [(None, "x y", "en", "a", 0), (3, "x y", "en", "a", 0), (3, "x y", "en", "a", 0)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 90, 2)] + [(4, 1, 1), (None, 1, 1)]
    cells = filter_audit.document_cells(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(cells).collect()}
    assert got == _plain_audit(rows, labels)
