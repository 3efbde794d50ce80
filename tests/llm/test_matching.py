"""Pair, search and matching operators against brute force on small fixtures."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.llm import decontaminate, simhash_dedup, token_output, topk_search, url_filter
from meterlens.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, fp long, key string, score double, hash string, part int, items string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "k", 0.5, "h", 3, "x") for i, t in rows], DOCS)


def words_of(n, seed, vocabulary=400):
    r = np.random.default_rng(seed)
    return " ".join(f"w{x}é" if x % 7 == 0 else f"w{x}" for x in r.integers(0, vocabulary, n))


def awkward_texts():
    base = words_of(120, 1)
    rows = [(i, words_of(60 + i, 10 + i)) for i in range(30)]
    rows += [(100, base), (101, base), (102, base + " tail"), (103, base.upper()), (104, base.replace("w1 ", "w2 ", 1))]
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "one"), (204, "one two"), (205, "x" * 50_000), (206, words_of(30_000, 5))]
    rows += [(100, base), (None, base), (None, None), (300, "a a a a a a a a a a a a a a a a a a a a")]
    return rows


# ---- SimHash ------------------------------------------------------------------


def slow_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))) if w]
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_near_duplicates_equal_brute_force(spark):
    rows = awkward_texts()
    got = simhash_dedup.near_duplicates(docs_frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == slow_components(rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert simhash_dedup.near_duplicates(docs_frame(spark, [(1, "a")]).filter("doc_id = 2")).count() == 0


def test_keep_one_keeps_the_smallest_row_of_each_group(spark):
    rows = awkward_texts() + [(None, "lonely text without any id"), (None, "lonely text without any id")]
    kept = simhash_dedup.keep_one(docs_frame(spark, rows))
    assert kept.columns == docs_frame(spark, rows).columns
    want = {c for _, _, c in slow_components(rows)}
    got = sorted([r.doc_id for r in kept.collect()], key=str)
    assert len(got) == len(set(got)) == len(want)
    assert set(got) == want


def test_keep_one_keeps_a_row_of_every_component_of_a_repeated_id(spark):
    a, b, c = words_of(80, 41), words_of(80, 42), words_of(80, 43)
    rows = [(3, a), (7, b)] + [(7, a)] * 5 + [(9, c), (9, c), (None, b), (7, c)]
    for order in (rows, rows[::-1]):  # whichever row comes first
        kept = simhash_dedup.keep_one(docs_frame(spark, order).coalesce(1)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted([(3, a), (7, b), (7, c)])


def test_a_common_key_is_dealt_over_block_pairs(spark, monkeypatch):
    r = np.random.default_rng(6)
    low = int(r.integers(0, 1 << 46))  # all segments A and B alike: one group of keys
    prints = {(int(c) << 46) | low for c in r.choice(1 << 18, 900, replace=False)}
    fps = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in sorted(prints)], "fp long")

    def sets(edges):
        got = {}
        for row in simhash_dedup.components(edges).collect():
            got.setdefault(row.root, set()).add(row.node)
        return sorted(map(sorted, got.values()))

    want = sets(simhash_dedup.links(fps))
    monkeypatch.setattr(simhash_dedup, "GROUP_ROWS", 100)
    assert sets(simhash_dedup.links(fps)) == want and want
    keyed = fps.mapInArrow(simhash_dedup._key_batches, "key long, fp long")
    assert keyed.groupBy("key").count().agg(F.max("count")).first()[0] == 900
    assert simhash_dedup.spread(keyed).groupBy("key").count().agg(F.max("count")).first()[0] < 150


def test_golay_keys_meet_at_two_bits_and_prints_at_three():
    g = simhash_dedup.golay()
    r = np.random.default_rng(2)
    x = r.integers(0, 1 << 23, 500)
    kx, nx = g.keys(x)
    for a in range(23):
        for b in range(a, 23):
            y = x ^ (1 << a) ^ (0 if a == b else 1 << b)
            ky, ny = g.keys(y)
            for i in range(0, 500, 25):
                assert set(kx[i, :nx[i]]) & set(ky[i, :ny[i]])
    fp = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    row, key = simhash_dedup.block_keys(fp)
    have = set(zip(row.tolist(), key.tolist()))
    for trial in range(20):
        other = fp.copy()
        for b in r.choice(64, 3, replace=False):
            other ^= np.uint64(1 << int(b))
        row2, key2 = simhash_dedup.block_keys(other)
        assert {i for i, k in zip(row2.tolist(), key2.tolist()) if (i, k) in have} == set(range(300))


def test_linked_sets_of_a_tight_group_and_strangers():
    r = np.random.default_rng(3)
    base = np.uint64(0x1234567890ABCDEF)
    group = {int(base)}
    for _ in range(300):
        x = int(base)
        for b in r.choice(64, int(r.integers(0, 4)), replace=False):
            x ^= 1 << int(b)
        group.add(x)
    fp = np.array(sorted(group | set(r.integers(0, 1 << 63, 200).tolist())), np.uint64)
    a, b = simhash_dedup.linked_sets(fp)
    assert len(a) == len(group) - 1 and set(a.tolist() + b.tolist()) == group


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    got = simhash_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


# ---- decontamination ------------------------------------------------------------


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_judge(rows, items):
    out = []
    for d, t in rows:
        w = word_list(t)
        hit, found = set(), set()
        for name, text in items:
            iw = word_list(text)
            n = min(13, len(iw))
            for p in range(len(iw) - n + 1) if n else []:
                for q in range(len(w) - n + 1):
                    if w[q:q + n] == iw[p:p + n]:
                        hit |= set(range(q, q + n))
                        if name is not None:
                            found.add(str(name))
        names = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def contaminated_case():
    passage, other = words_of(40, 77), words_of(30, 78)
    items = [(5, passage), (6, other), (7, "Short Item Here"), (8, None), (9, "!!!"), (10, "rep " * 20), (5, words_of(20, 79)), (None, words_of(15, 80))]
    rows = [(1, words_of(50, 1) + " " + passage + " " + words_of(50, 2)), (2, passage.upper()), (3, "no hits at all"),
            (4, words_of(2000, 3) + ". " + " ".join(passage.split()[5:20])), (5, "say: short, item-here! now"), (6, None), (7, ""),
            (8, "rep " * 45), (9, " ".join(passage.split()[:12])), (9, " ".join(passage.split()[:12])), (None, other),
            (10, "short item"), (11, words_of(15, 80)), (12, words_of(9000, 9) + " " + other), (13, other + " x " + passage + " " + other)]
    return rows, items


def test_judge_equals_brute_force(spark, monkeypatch):
    rows, items = contaminated_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = slow_judge(rows, items)
    for block in (decontaminate.BLOCK_BYTES, 150):  # one block of test items, and several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.digest(decontaminate.judge(docs_frame(spark, rows), bench)).collect()
        assert sorted(map(tuple, got), key=str) == want
    kept = decontaminate.decontaminate(docs_frame(spark, rows), bench)
    assert sorted([str(r.doc_id) for r in kept.collect()]) == sorted(str(w[0]) for w in want if not w[5])
    assert kept.columns == docs_frame(spark, rows).columns


def test_judge_with_empty_tables(spark):
    rows, items = contaminated_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = bench.filter("item_id = -1")
    assert decontaminate.judge(docs_frame(spark, rows), none).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.judge(docs_frame(spark, rows).filter("doc_id = -1"), bench).count() == 0


def test_longest_matches_equal_brute_force(spark):
    rows, items = contaminated_case()
    items = [x for x in items if x[0] not in (None, 5)] + [(5, words_of(40, 77))]
    got = decontaminate.longest_matches(docs_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for name, text in items:
        iw = word_list(text)
        for p in range(len(iw)):
            best = 0
            for _, t in rows:
                w = word_list(t)
                for q in range(len(w)):
                    n = 0
                    while n < len(iw) - p and q + n < len(w) and w[q + n] == iw[p + n]:
                        n += 1
                    best = max(best, n)
            if best >= min(13, len(iw)):
                want[str(name), p] = best
    assert {(r.item_id, r.item_start): r.n_words for r in got} == want
    texts = dict((d, word_list(t)) for d, t in rows)
    for r in got:
        iw = word_list(dict((str(n), t) for n, t in items)[r.item_id])
        assert texts[r.doc_id][r.doc_start:r.doc_start + r.n_words] == iw[r.item_start:r.item_start + r.n_words]


# ---- top-k ------------------------------------------------------------------------


def vectors_case(seed, scale=1.0, n=400, dim=6):
    r = np.random.default_rng(seed)
    rows = [(int(i), (np.round(r.normal(size=dim) * 4) / 8 * scale).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]  # one common vector
    rows += [(2000, None), (2020, [1.0, None, 0.0]), (2040, [float("nan")] * dim), (2060, [float("inf")] * dim), (None, [1.0] * dim),
             (2080, [0.5, 0.25]), (2100, []), (40, [0.1] * dim), (40, rows[40][1])]
    return rows


def slow_top(rows, k=20):
    ok = [(i, [int(np.floor(64 * np.float64(c))) for c in v]) for i, v in rows
          if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = set()
    for q, x in ok:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_top_k_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk_search, "SMALL_SHARD", 100)
    monkeypatch.setattr(topk_search, "LEAF_ROWS", 16)
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", 10)
    rows = [x for x in vectors_case(4, scale) if x[0] != 40]  # one query id, one vector
    frame = spark.createDataFrame([(i, v, 7, 1) for i, v in rows], "vec_id long, embedding array<double>, query_id int, rank int")
    got = topk_search.top_k(frame, F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == slow_top(rows)


def test_top_k_of_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (0, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_search.top_k(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2048)]
    assert topk_search.top_k(frame.filter("vec_id = 9"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_with_one_id_on_more_rows_than_a_shard_holds(spark):
    hot = spark.range(200_000).select(F.when(F.col("id") < 199_000, 7).otherwise(F.col("id")).cast("long").alias("vec_id"), F.array(
        *[F.pmod(F.xxhash64("id", F.lit(j)), F.lit(2001)) / 64.0 - 15 for j in range(3)]).alias("embedding"))
    rows = hot.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.floor(64 * np.array([r.embedding for r in rows])).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        best = np.lexsort((ids, -score))
        best = best[ids[best] != ids[q]][:20]
        want |= {(int(ids[q]), r + 1, int(ids[b]), int(score[b])) for r, b in enumerate(best)}
    got = topk_search.top_k(hot, F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_of_one_query_id_with_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SMALL_SHARD", 100)
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", 10)
    rows = [(20, [float(i), float(-i)]) for i in range(90)] + [(i, [1.0 / i, 2.0]) for i in range(1, 200) if i % 20]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i != 20}
    scored = sorted((-int(np.floor(64 * np.array(v)).astype(int) @ y), i) for q, v in rows if q == 20 for i, y in x.items())[:20]
    got = topk_search.top_k(frame, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(20, r + 1, i, -s) for r, (s, i) in enumerate(scored)]


def test_top_k_of_the_largest_finite_components(spark):
    rows = [(0, [1.0, 1.0]), (1, [-1e30, 1.0]), (2, [-64.0, -64.0]), (3, [1e30, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    lowest, highest = -(1 << 63) + 1, (1 << 63) - 1  # scores beyond 64 bits are saturated
    assert [tuple(r) for r in got] == [(0, 1, 3, highest), (0, 2, 2, -2 * 64 * 4096), (0, 3, 1, lowest)]


def test_search_refuses_a_shard_beyond_its_row_numbers(monkeypatch):
    monkeypatch.setattr(topk_search, "_ID_BITS", 6)
    x = np.arange(130, dtype=np.int64).reshape(65, 2)
    low = np.full(1, topk_search._LOWEST)
    ask = (np.array([-1]), np.ones((1, 2), np.int64), low, np.zeros(1, np.int64))
    row, ids, score = topk_search.search(np.arange(64), x[:64], *ask, k=3)
    assert sorted(zip(score.tolist(), ids.tolist())) == [(245, 61), (249, 62), (253, 63)]
    with pytest.raises(ValueError):
        topk_search.search(np.arange(65), x, *ask, k=3)


# ---- token files --------------------------------------------------------------------


@pytest.mark.parametrize("high", [1, 2, 200, 50_000, 1 << 32])
def test_segment_round_trip(high):
    r = np.random.default_rng(high)
    for n in (0, 1, 127, 128, 129, 3000):
        x = r.integers(0, high, n, dtype=np.uint64)
        x[r.random(n) < 0.8] %= 9  # a few outliers above a narrow width
        image = token_output.write_segment(x, np.array([n // 2, n - n // 2]))
        ids, sizes = token_output.read_segment(image)
        assert ids.tolist() == x.tolist() and sizes.tolist() == [n // 2, n - n // 2]
        for a, b in ((0, n), (n // 3, n // 2), (100, 140), (n, n + 5)):
            assert token_output.read_range(image, a, b).tolist() == x[a:b].tolist()


def test_token_files_equal_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_output, "SEGMENT_IDS", 500)
    rows = awkward_texts() + [(400, "It's <|endoftext|> Mixed CASE\u00a0and\tΣΑΣ e\u0301 ﬁ 漢字 don't!!"), (-5, "first")]
    rows = [(i, t) for i, t in rows if i is not None]
    path = tokenizer_file("word_bpe_49k.json")
    got = token_output.round_trip(docs_frame(spark, rows), path).orderBy("start").collect()
    library = Tokenizer.from_file(path)
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    at = 0
    for r, d in zip(got, sorted(d for d, _ in rows)):
        one = ids[d][0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(one), zlib.crc32(np.array(one, "<u4").tobytes()))
        at += len(one)
    assert len(got) == len(rows)
    empty = docs_frame(spark, rows).filter("doc_id = 12345")
    assert token_output.round_trip(empty, path).count() == 0


def test_piecewise_encoding_needs_a_fitting_tokenizer():
    import json

    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        assert token_output.pieces_are_independent(json.load(f))
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not token_output.pieces_are_independent(json.load(f))


# ---- urls ---------------------------------------------------------------------------


def slow_verdict(url, rules, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    bad = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, None, "block" if bad else "allow"


URLS = [None, "", "no scheme.com/", "http://", "http:///x", "HTTP://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "http://example.com/enx",
        "http://b.net/es/1", "http://net/fr/", "http://b.net/fr", "http://com/", "http://x.com", "http://x.com?q=/", "https://spam-farm.example.org",
        "https://a.b.c.spam-farm.example.org/en/", "https://notspam-farm.example.org/", "http://u:p@example.com:80/en/", "ftp://.com/", "x://y://example.com/",
        "http://deep.a.b.c.d.e.f.example.com/en/ü", "http://www.example.com/en/?a", "http://www.example.com/en/"]


def pages_frame(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "r", "k") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string, key string")


@pytest.mark.parametrize("joins", [False, True])
def test_url_verdicts_equal_brute_force(spark, monkeypatch, joins):
    if joins:
        monkeypatch.setattr(url_filter, "MAX_LISTED", 0)
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    blocked = spark.createDataFrame([(h,) for h in url_filter.BLOCKED_HOSTS], "host string")
    got = url_filter.judge(pages_frame(spark, URLS), rules, blocked).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [slow_verdict(u, url_filter.RULES, url_filter.BLOCKED_HOSTS) for u in URLS]
    assert url_filter.judge(pages_frame(spark, URLS).filter("page_id < 0"), rules, blocked).count() == 0


@pytest.mark.parametrize("joins", [False, True])
def test_url_rules_of_equal_length_take_the_longer_host(spark, monkeypatch, joins):
    if joins:
        monkeypatch.setattr(url_filter, "MAX_LISTED", 0)
    rules = [("ab.example.com", "/", "allow"), ("example.com", "/xyz", "block"),
             ("cd.example.org", "", "allow"), ("example.org", "/xy", "block")]
    urls = ["http://ab.example.com/xyz", "http://cd.example.org/xy", "http://b.example.com/xyz", "http://cd.example.org"]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge(pages_frame(spark, urls), frame, spark.createDataFrame([], "host string")).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [("ab.example.com/", "allow"), ("cd.example.org", "allow"),
                                                  ("example.com/xyz", "block"), ("cd.example.org", "allow")]


def test_cascade_counts_false_positives_before_making_literals(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)
    monkeypatch.setattr(url_filter, "MAX_LISTED", 300)
    listed = spark.range(200).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert url_filter.cascade(listed, universe) is None
    assert url_filter.cascade(listed, listed) is not None


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)  # many false positives: several levels
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 6000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    member = url_filter.cascade(listed, universe)
    got = {r.key for r in universe.filter(member(F.col("key"))).collect()}
    assert got == {f"k{i}" for i in range(0, 3000, 7)}
    assert universe.filter(url_filter.cascade(listed.filter("key = 'none'"), universe)(F.col("key"))).count() == 0
