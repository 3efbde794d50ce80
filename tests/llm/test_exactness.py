"""Words of equal hash, repeated ids and models fitted in a task."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterlens.llm import decontaminate
from meterlens.llm.common import fit_in_task, one_text_each, smallest_hashes, span_hashes
from meterlens.llm.token_output import PieceEncoder

#: Two words of 1,024 letters whose polynomial hashes are equal modulo 2^64 for every base.
WORD = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = WORD.translate(str.maketrans("ab", "ba"))


def test_the_two_words_collide():
    data = np.frombuffer((WORD + OTHER).encode(), np.uint8)
    h = span_hashes(data, np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] == h[1]


def test_pieces_of_equal_hash_keep_their_own_ids():
    number = {WORD: 1, OTHER: 2}

    def encode(pieces):
        return np.array([number.get(p, 3) for p in pieces], np.int32), np.ones(len(pieces), np.int64)

    enc = PieceEncoder(encode, lambda t: pa.ListArray.from_arrays(np.arange(len(t) + 1, dtype=np.int32), t))
    for texts in ([WORD, "x"], [OTHER], [WORD], [OTHER, WORD, "x"]):
        assert enc(pa.array(texts))[0].tolist() == [number.get(t, 3) for t in texts]


def test_words_of_equal_hash_are_no_matches(spark):
    docs = spark.createDataFrame([(1, OTHER), (2, f"{WORD} {OTHER}"), (3, WORD), (4, "q")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", WORD), ("j", f"{OTHER} tail")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.judge(docs, bench).collect()}
    assert got == {1: (1, 0, [], False), 2: (2, 1, ["i"], True), 3: (1, 1, ["i"], True), 4: (1, 0, [], False)}


def test_samples_keep_every_group_however_often_its_ids_repeat(spark):
    rows = spark.range(20_000).select((F.col("id") % 10).alias("doc_id"), F.lit("xx").alias("lang"))
    rows = rows.unionByName(spark.range(100, 3000).select(F.col("id").alias("doc_id"), F.lit("yy").alias("lang")))
    got = {r[0]: r[1] for r in smallest_hashes(rows, "lang", 40).groupBy("lang").count().collect()}
    assert got == {"xx": 10, "yy": 40}
    texts = rows.withColumn("text", F.concat("lang", (F.col("doc_id") % 3).cast("string")))
    assert one_text_each(texts, "doc_id").count() == 2910


def test_models_come_back_from_a_task(spark):
    rows = spark.range(50).select("id")
    assert fit_in_task(rows, lambda frame: int(frame["id"].sum())) == 1225
    assert fit_in_task(rows.limit(0), lambda frame: len(frame)) == 0
