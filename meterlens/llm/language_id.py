"""Language identification by hierarchical discrimination.

A text's profile is its bag of hashed byte bigrams and trigrams (A-Z
lower-cased, every run of non-letters one space), scaled to length one.  First
one-against-rest linear support vector machines choose the language family;
then, inside the family, one linear support vector machine for each pair of
its languages votes, and the language with the largest summed win probability
is taken.  Families are fixed values (``FAMILIES``); a learned language outside
them is a family of its own.  All machines are fitted by dual coordinate
descent on a bounded sample: at most ``SAMPLE_ROWS`` documents in all, equally
many of each language, those of smallest doc_id hash.

Cases: a null text or one without any letter is ``und`` with score 0; rows with
null lang teach nothing; without any training row every text is ``und``; ties
take the language that sorts first; repeated rows give repeated results; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear_svm
from .common import fit_in_task, held_out, one_text_each, ship, slices, smallest_hashes, text_rows, utf8

BUCKETS = 1 << 15
SAMPLE_ROWS = 2400
SLICE_BYTES = 2 << 20
UNDETERMINED = "und"
MIN_SCORE = 0.2  # of a kept document

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["am", "ar", "he", "mt"],
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_CODES = np.random.default_rng(11).integers(0, BUCKETS, (5, 256)).astype(np.uint16)


def profiles(part: pa.RecordBatch) -> np.ndarray:
    """(rows, BUCKETS) unit profiles of the texts."""
    data, offsets = utf8(part.column("text"))
    out = np.zeros((part.num_rows, BUCKETS), np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        x = _FOLD[data[a:b]]
        if len(x):
            x = x[~((x == 32) & np.r_[False, x[:-1] == 32])]
        x = np.concatenate([[32], x, [32]]).astype(np.uint8)
        two = _CODES[0][x[:-1]] ^ _CODES[1][x[1:]]
        three = _CODES[2][x[:-2]] ^ _CODES[3][x[1:-1]] ^ _CODES[4][x[2:]]
        n = np.bincount(two, minlength=BUCKETS) + np.bincount(three, minlength=BUCKETS)
        out[i] = np.sqrt(n) / np.sqrt(n.sum())
    return out


class Model:
    """Weight columns: one a family (none for a single family), then one for
    each pair of languages of a family."""

    def __init__(self, languages: list[str]) -> None:
        self.languages = languages
        self.families: dict[str, list[str]] = {}
        for code in languages:
            self.families.setdefault(_FAMILY_OF.get(code, f"own:{code}"), []).append(code)
        self.tops = list(self.families) if len(self.families) > 1 else []
        self.pairs = [(a, b) for codes in self.families.values() for i, a in enumerate(codes) for b in codes[i + 1:]]
        self.weight = np.zeros((BUCKETS, len(self.tops) + len(self.pairs)), np.float32)
        self.bias = np.zeros(self.weight.shape[1], np.float32)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        if not self.languages:
            return np.full(n, UNDETERMINED, object), np.zeros(n)
        p = 1 / (1 + np.exp(-3.0 * (x @ self.weight + self.bias)))
        if self.tops:
            top = p[:, :len(self.tops)]
            best = top.argmax(axis=1)
            family_score = top.max(axis=1) / np.maximum(top.sum(axis=1), 1e-9)
        else:
            best, family_score = np.zeros(n, int), np.ones(n)
        lang, score = np.empty(n, object), np.zeros(n)
        for k, codes in enumerate(self.families.values()):
            here = best == k
            votes = np.zeros((here.sum(), len(codes)))
            for j, (a, b) in enumerate(self.pairs):
                if a in codes:
                    win = p[here, len(self.tops) + j]
                    votes[:, codes.index(a)] += win
                    votes[:, codes.index(b)] += 1 - win
            share = votes / (len(codes) - 1) if len(codes) > 1 else np.ones_like(votes)
            lang[here] = np.array(codes, object)[share.argmax(axis=1)]
            score[here] = family_score[here] * share.max(axis=1)
        return lang, np.clip(score, 0.0, 1.0)


def train_model(docs: DataFrame, rows: int = SAMPLE_ROWS, cost: float = 4.0) -> Model:
    ship(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = known.select("doc_id", "lang")
    languages = sorted(r[0] for r in ids.select("lang").distinct().collect())
    if not languages:
        return Model([])
    chosen = smallest_hashes(ids, "lang", max(1, rows // len(languages))).distinct()

    def sparse(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            for at in range(0, part.num_rows, 64):
                x = profiles(part.slice(at, 64))
                f = [np.flatnonzero(r).astype(np.int32) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(at, 64), part.column("lang").slice(at, 64), pa.array(f, pa.list_(pa.int32())),
                     pa.array([r[i] for r, i in zip(x, f)], pa.list_(pa.float32()))], ["doc_id", "lang", "f", "v"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = known.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    rows = one_text_each(text.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "text"), "doc_id", "lang")
    rows = rows.mapInArrow(sparse, f"doc_id {kind}, lang string, f array<int>, v array<float>")

    def learn(got: pd.DataFrame) -> Model:
        got = got.sort_values(["doc_id", "lang"], kind="stable")
        model = Model(languages)
        at = [np.asarray(f, np.int32) for f in got["f"]]
        x = [np.asarray(v, np.float32) for v in got["v"]]
        lang = got["lang"].to_numpy()
        family = np.array([_FAMILY_OF.get(c, f"own:{c}") for c in lang], object)
        tasks = [(family == t, np.ones(len(lang), bool)) for t in model.tops]
        tasks += [(lang == a, (lang == a) | (lang == b)) for a, b in model.pairs]
        for j, (positive, used) in enumerate(tasks):
            n = np.flatnonzero(used)
            w, b = linear_svm.fit([at[i] for i in n], [x[i] for i in n], np.where(positive[n], 1.0, -1.0), BUCKETS, cost)
            model.weight[:, j], model.bias[j] = w, b
        return model

    return fit_in_task(rows, learn)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            for at in range(0, part.num_rows, 64):
                lang, score = shared.value.predict(profiles(part.slice(at, 64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(at, 64), part.column("letters").slice(at, 64),
                     pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "letters", "lang", "score"])

    rows = text_rows(docs, "doc_id").select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("letters"))
    out = rows.mapInArrow(run, f"doc_id {kind}, letters boolean, lang string, score double")
    sure = F.col("letters") & (F.col("lang") != UNDETERMINED)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      F.when(sure, F.col("lang")).otherwise(UNDETERMINED).alias("lang_pred"),
                      F.when(sure, F.col("score")).otherwise(0.0).alias("score"))


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` (all columns) without the rows whose language is undetermined
    or predicted with less than ``min_score``."""
    model = train_model(docs)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            for at in range(0, part.num_rows, 64):
                rows = part.slice(at, 64)
                lang, score = shared.value.predict(profiles(rows))
                letters = pc.fill_null(pc.match_substring_regex(rows.column("text"), r"\p{L}"), False)
                yield rows.filter(pc.and_(letters, pa.array((lang != UNDETERMINED) & (score >= min_score))))

    return docs.mapInArrow(run, docs.schema)
