"""Quality classifier: naive-Bayes support vectors.

N-grams: a text's tokens are runs of word bytes (letters, digits, non-ASCII)
and runs of other visible bytes, case kept; features are the indicators of its
token unigrams and bigrams and of the unigrams, bigrams and trigrams of token
shapes (kind, case, length, whether the token repeats one of the two before),
hashed to ``BUCKETS``.  Class counts of every feature come from all labelled
training documents (one Spark aggregation); the indicators are scaled by the
class log-count ratios and the document by its number of features, and a
linear hinge-loss model is fitted by dual coordinate descent on a bounded
sample (``SAMPLE_PER_CLASS`` documents a label, those of smallest doc_id hash).
Every whole text is then scored; the margin becomes a probability by a logistic
curve fitted on the sample.

Cases: a null or empty text has no features and gets the bias's score;
documents with null labels, or labelled in the held-out fold, teach nothing;
repeated label rows count each; with no training rows, or one class only, the
score is the share of label 1 among them (0.5 without any); extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear_svm
from .common import held_out, mix, one_text_each, runs, ship, slices, smallest_hashes, span_hashes, text_rows, utf8

BUCKETS = 1 << 18
SAMPLE_PER_CLASS = 2000
BROADCAST_ROWS = 1_000_000  # labels beyond this many rows are joined by shuffle
SLICE_BYTES = 2 << 20

_KIND = np.zeros(256, np.uint8)  # 0 space, 1 word, 2 other
_KIND[33:] = 2
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = 1
_KIND[127] = 0
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _gram(parts: list[np.ndarray], row: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of consecutive tokens of the same row, and their rows."""
    n = len(parts)
    size = len(row) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(size, salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for k in range(n):
        h = (h ^ parts[k][k:k + size]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
    same = row[:size] == row[n - 1:]
    return (mix(h[same]) % np.uint64(BUCKETS)).astype(np.int64), row[:size][same]


def features(part: pa.RecordBatch) -> list[np.ndarray]:
    """The distinct feature numbers of each row's text."""
    data, offsets = utf8(part.column("text"))
    base = int(offsets[0])
    data, offsets = data[base:int(offsets[-1])], offsets - base
    kind = _KIND[data]
    change = np.flatnonzero(np.diff(kind)) + 1
    starts, ends = runs(kind > 0, np.union1d(change, offsets))
    if not len(starts):
        return [np.zeros(0, np.int64)] * part.num_rows
    row = np.searchsorted(offsets, starts, side="right") - 1
    h = span_hashes(data, starts, ends)
    length = ends - starts
    upper = np.add.reduceat(_UPPER[data], starts, dtype=np.int64)
    digit = np.add.reduceat(_DIGIT[data], starts, dtype=np.int64)
    before1 = np.r_[False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])]
    before2 = np.r_[[False] * min(2, len(h)), (h[2:] == h[:-2]) & (row[2:] == row[:-2])]
    first = data[starts]
    case = np.where(upper == 0, 0, np.where(upper >= np.maximum(length - 2, 1), 2, 1))
    shape = np.where(kind[starts] == 1, case * 4 + (digit > 0) * 2, 16 + first.astype(np.int64) * 16)
    shape = (shape * 8 + np.minimum(length, 7)) * 4 + before1 * 2 + before2
    shape = mix(shape.astype(np.uint64) + np.uint64(1))
    got = [_gram([h], row, 1), _gram([h, h], row, 2), _gram([shape], row, 3), _gram([shape] * 2, row, 4),
           _gram([shape] * 3, row, 5)]
    seen = np.full(BUCKETS, -1, np.int64)
    cuts = [np.searchsorted(r, np.arange(part.num_rows + 1)) for _, r in got]
    out, stamp = [], 0
    for i in range(part.num_rows):
        f = np.concatenate([g[c[i]:c[i + 1]] for (g, _), c in zip(got, cuts)])
        at = np.arange(stamp, stamp + len(f))
        seen[f] = at
        out.append(f[seen[f] == at])
        stamp += len(f)
    return out


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text, y of the training fold's labelled documents."""
    y = training_ids(labels, label)
    y = F.broadcast(y) if y.count() <= BROADCAST_ROWS else y
    return text_rows(docs, "doc_id").join(y, "doc_id")


def training_ids(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and y (0 or 1) of the labels outside the held-out fold."""
    ids = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    return ids.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def sample(train: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """The rows of ``train`` of the ``per_class`` smallest doc_id hashes a label."""
    chosen = smallest_hashes(training_ids(labels, label), "y", per_class).select("doc_id").distinct()
    return train.join(F.broadcast(chosen), "doc_id")


def class_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 0 and 1 with each feature: added up inside a task,
    then by feature over the tasks; at most ``BUCKETS`` rows come back."""
    def add(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            y = part.column("y").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                f = [x for x, k in zip(features(part), y) if k == c]
                if f:
                    total[c] += np.bincount(np.concatenate(f), minlength=BUCKETS)
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["f", "n0", "n1"])

    found = (train.select("text", "y").mapInArrow(add, "f long, n0 long, n1 long")
             .groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())
    out = np.zeros((2, BUCKETS))
    out[0, found["f"]], out[1, found["f"]] = found["n0"], found["n1"]
    return out[0], out[1]


class Model:
    """``weight`` a feature, ``bias``, and the curve from margin to score."""

    def __init__(self, weight: np.ndarray, bias: float, curve: tuple[float, float]) -> None:
        self.weight, self.bias, self.curve = weight, bias, curve

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weight[f].sum() / np.sqrt(max(1, len(f))) for f in rows]) + self.bias

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        a, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * self.margin(rows) + c, -30, 30)))


def train_model(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS,
                cost: float = 1.0) -> Model:
    ship(docs.sparkSession)
    train = labelled(docs, labels, label)

    def rows(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            f = [x.astype(np.int32) for x in features(part)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(f, pa.list_(pa.int32()))],
                                             ["doc_id", "y", "f"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = one_text_each(sample(train, labels, label, per_class).select("doc_id", "y", "text"), "doc_id", "y")
    got: pd.DataFrame = picked.mapInArrow(rows, f"doc_id {kind}, y int, f array<int>").toPandas().sort_values(["doc_id", "y"], kind="stable")
    y = got["y"].to_numpy() == 1
    if not len(y) or y.all() or not y.any():
        p = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(BUCKETS), 0.0, (1.0, float(np.log((p + 1e-6) / (1 - p + 1e-6)))))
    n0, n1 = class_counts(train)
    ratio = np.log((n1 + 1) / (n1 + 1).sum()) - np.log((n0 + 1) / (n0 + 1).sum())
    ratio[(n0 + n1) == 0] = 0.0
    at = [np.asarray(f, np.int32) for f in got["f"]]
    x = [(ratio[f] / np.sqrt(max(1, len(f)))).astype(np.float32) for f in at]
    w, bias = linear_svm.fit(at, x, np.where(y, 1.0, -1.0), BUCKETS, cost)
    model = Model(w * ratio, bias, (1.0, 0.0))
    model.curve = linear_svm.calibrate(model.margin(at), y)
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(features(part)))],
                                             ["doc_id", "score"])

    out = text_rows(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
