"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Inputs of each word (A-Z lower-cased run of letters, digits, non-ASCII):
* word input: the evidence that toxic documents hold the word, from the
  training sample: its log-odds, drawn toward zero by ``CAUTION`` standard
  deviations, so words seen once say little;
* character inputs: largest and mean evidence over the word's byte 4-grams and
  5-grams, its leading boundary included, so unseen inflections of a known stem
  still count; and the word's length.
Evidence lives in hashed tables, read at two places each, the weaker taken.
While training, a document's own contribution is left out of its evidence.

A window is ``WINDOW`` words; windows start every ``STEP`` words, so all of a
text's words lie in overlapping windows, and every window of every text is
scored: two gated recurrent layers (forward and backward), softmax attention
over their states, one logit.  A document's score is that of its highest
window.  Training is in numpy, on a bounded sample (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` documents, smallest doc_id hash first): each round scores all
windows of the sample, takes the highest of each toxic document as positive and
the highest and some random ones of each clean document as negative, and takes
Adam steps on them.

Cases: a null or wordless text scores the share of toxic documents in the
sample; documents with null labels or of the held-out fold teach nothing; with
one class only, every text gets that share; repeated rows get equal scores;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_in_task, held_out, mix, one_text_each, runs, ship, slices, smallest_hashes, span_hashes, text_rows, utf8
from .quality import labelled, training_ids

WINDOW, STEP, HIDDEN, ATTEND = 32, 16, 8, 8
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000
BUCKETS = 1 << 18
GRAMS = (4, 5)
INPUTS = 2 + 2 * len(GRAMS)
BLOCK = 1024  # windows scored at once
LEAST_STEPS = 50  # Adam steps a round
CAUTION = 1.64  # standard deviations taken off every log-odds
SLICE_BYTES = 2 << 20
THRESHOLD = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _WORD[_a:_b] = True


class Words:
    """The words of a slice of texts: the distinct ones' hashes and n-grams,
    and for each occurrence its row and which distinct word it is."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = utf8(column)
        base = int(offsets[0])
        data, offsets = _LOWER[data[base:int(offsets[-1])]], offsets - base
        starts, ends = runs(_WORD[data], offsets)
        self.row = np.searchsorted(offsets, starts, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(column) + 1))
        h = span_hashes(data, starts, ends)
        self.hash, at, self.word = np.unique(h, return_index=True, return_inverse=True)
        starts, ends = starts[at], ends[at]
        self.length = ends - starts
        padded = np.r_[np.uint8(32), data, np.zeros(max(GRAMS), np.uint8)].astype(np.uint64)
        self.grams = []
        for n in GRAMS:  # over the boundary and the word: positions starts .. ends in padded
            count = np.maximum(self.length + 1 - n + 1, 1)
            first = np.cumsum(count) - count
            place = np.arange(int(count.sum())) - np.repeat(first, count) + np.repeat(starts, count)
            inner = place > np.repeat(starts, count)
            code = np.where(inner, padded[place], np.uint64(32))
            for k in range(1, n):
                beyond = place + k > np.repeat(ends, count)
                code = (code << np.uint64(8)) | np.where(beyond, np.uint64(0), padded[np.minimum(place + k, len(padded) - 1)])
            code = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            self.grams.append((code ^ (code >> np.uint64(31)), first, count))


def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Evidence:
    """Numbers of toxic and clean sample documents by bucket: two tables of
    words and two of each n-gram size."""

    def __init__(self) -> None:
        self.docs = np.zeros(2)
        self.count = np.zeros((1 + len(GRAMS), 2, 2, BUCKETS), np.float32)  # kind, place, class, bucket

    def add(self, words: Words, y: np.ndarray) -> None:
        """Count every document once for each word and each n-gram it has."""
        self.docs += [(y == 0).sum(), (y == 1).sum()]
        n = max(1, len(words.hash))
        row, word = np.divmod(np.unique(words.row.astype(np.int64) * n + words.word), n)
        for k in range(1 + len(GRAMS)):
            if k:
                h, first, count = words.grams[k - 1]
                each = count[word]
                at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first[word], each)
                doc, h = np.repeat(row, each), h[at]
            else:
                doc, h = row, words.hash[word]
            _, once = np.unique(mix(h + mix(doc.astype(np.uint64))), return_index=True)
            for c in (0, 1):
                mine = once[y[doc[once]] == c]
                for j, at in enumerate(places(h[mine])):
                    self.count[k, j, c] += np.bincount(at, minlength=BUCKETS).astype(np.float32)

    def tables(self, left_out: int | None = None) -> np.ndarray:
        """Evidence by kind, place, bucket; ``left_out``: as a document of that
        class sees it without its own contribution."""
        n0, n1 = self.count[:, :, 0], self.count[:, :, 1]
        n0 = np.maximum(n0 - 1, 0) if left_out == 0 else n0
        n1 = np.maximum(n1 - 1, 0) if left_out == 1 else n1
        d0, d1 = max(self.docs[0], 1.0), max(self.docs[1], 1.0)
        odds = np.log((n1 + 0.5) / (d1 + 1)) - np.log((n0 + 0.5) / (d0 + 1))
        sure = np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))
        out = np.sign(odds) * np.maximum(np.abs(odds) - CAUTION * sure, 0.0)
        return (out / 2.0).astype(np.float32)


def inputs(words: Words, tables: np.ndarray) -> np.ndarray:
    """(distinct words + 1, INPUTS); the last row is the padding word."""
    out = np.zeros((len(words.hash) + 1, INPUTS), np.float32)
    if not len(words.hash):
        return out
    a, b = places(words.hash)
    out[:-1, 0] = np.minimum(tables[0, 0][a], tables[0, 1][b])
    for k, (h, first, count) in enumerate(words.grams, 1):
        a, b = places(h)
        e = np.minimum(tables[k, 0][a], tables[k, 1][b])
        out[:-1, 2 * k - 1] = np.maximum.reduceat(e, first)
        out[:-1, 2 * k] = np.add.reduceat(e, first) / count
    out[:-1, -1] = np.minimum(words.length, 16) / 16
    return out


def windows(words: Words, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, WINDOW) of distinct-word numbers, padded, and each one's row."""
    size = np.diff(words.first)
    count = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STEP)), 0)
    row = np.repeat(np.arange(n_rows), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = (words.first[row] + nth * STEP)[:, None] + np.arange(WINDOW)
    inside = at < words.first[row + 1][:, None]
    return np.where(inside, words.word[np.minimum(at, max(0, len(words.word) - 1))] if len(words.word) else 0,
                    len(words.hash)), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters and passes.  Arrays of both directions are stacked first."""

    def __init__(self, seed: int = 5, hidden: int = HIDDEN) -> None:
        r = np.random.default_rng(seed)
        h, d = hidden, INPUTS
        self.p = {
            "wx": r.normal(0, 0.5, (2, d, 3 * h)), "b": np.zeros((2, 1, 3 * h)), "u": r.normal(0, 0.3, (2, h, 3 * h)),
            "wa": r.normal(0, 0.5, (2 * h, ATTEND)), "v": r.normal(0, 0.5, (ATTEND,)),
            "w": r.normal(0, 0.5, (2 * h,)), "c": np.zeros(1),
        }
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.h = h

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows ``x`` (n, WINDOW, INPUTS); ``mask`` is true on
        words.  Padding leaves a state as it was and gets no attention."""
        p, h = self.p, self.h
        n, steps = mask.shape
        xs = np.stack([x.swapaxes(0, 1), x.swapaxes(0, 1)[::-1]])  # direction, step, window, input
        m = mask.T.astype(np.float32)
        ms = np.stack([m, m[::-1]])[..., None]
        gates = xs.reshape(2, steps * n, -1) @ p["wx"] + p["b"]
        gates = gates.reshape(2, steps, n, 3 * h)
        state = np.zeros((2, n, h), x.dtype)
        states, kept = np.empty((2, steps, n, h), x.dtype), []
        for t in range(steps):
            g, r = gates[:, t], state @ p["u"]
            rz = _sigmoid(g[..., :2 * h] + r[..., :2 * h])
            new = np.tanh(g[..., 2 * h:] + rz[..., :h] * r[..., 2 * h:])
            take = (1 - rz[..., h:]) * ms[:, t]
            if keep:
                kept.append((state, rz, new, r[..., 2 * h:], take))
            state = state + take * (new - state)
            states[:, t] = state
        both = np.concatenate([states[0], states[1, ::-1]], axis=-1)  # step, window, 2h
        a = np.tanh(both @ p["wa"])
        e = np.where(mask.T, a @ p["v"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        share = e * m
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = (share[..., None] * both).sum(axis=0)
        logit = pooled @ p["w"] + p["c"][0]
        return (logit, (xs, ms, kept, both, a, share, pooled)) if keep else logit

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Mean weighted log loss and its gradients (backpropagation through time)."""
        p, h = self.p, self.h
        logit, (xs, ms, kept, both, a, share, pooled) = self.forward(x, mask, True)
        prob = _sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())
        d_logit = (weight * (prob - y) / weight.sum()).astype(x.dtype)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"], g["c"] = pooled.T @ d_logit, np.array([d_logit.sum()], x.dtype)
        d_pool = d_logit[:, None] * p["w"]
        d_both = share[..., None] * d_pool
        d_share = (both * d_pool).sum(axis=-1)
        d_e = share * (d_share - (share * d_share).sum(axis=0))
        g["v"] = (a * d_e[..., None]).sum(axis=(0, 1))
        d_a = d_e[..., None] * p["v"] * (1 - a * a)
        flat = both.reshape(-1, 2 * h)
        g["wa"] = flat.T @ d_a.reshape(-1, ATTEND)
        d_both = d_both + d_a @ p["wa"].T
        d_states = np.stack([d_both[..., :h], d_both[::-1, :, h:]])
        d_h = np.zeros_like(d_states[:, 0])
        for t in range(len(kept) - 1, -1, -1):
            state, rz, new, rn, take = kept[t]
            d_h = d_h + d_states[:, t]
            d_new = d_h * take
            d_z = -d_h * (new - state) * ms[:, t]
            d_pre = d_new * (1 - new * new)
            r, z = rz[..., :h], rz[..., h:]
            d_rpre = d_pre * rn * r * (1 - r)
            d_zpre = d_z * z * (1 - z)
            d_gate = np.concatenate([d_rpre, d_zpre, d_pre], axis=-1)
            d_rec = np.concatenate([d_rpre, d_zpre, d_pre * r], axis=-1)
            g["wx"] += xs[:, t].swapaxes(1, 2) @ d_gate
            g["b"] += d_gate.sum(axis=1, keepdims=True)
            g["u"] += state.swapaxes(1, 2) @ d_rec
            d_h = d_h * (1 - take) + d_rec @ p["u"].swapaxes(1, 2)
        return loss, g

    def fit(self, batches, rate: float = 0.01) -> None:
        """Adam over (x, mask, y, weight) batches; moments persist."""
        if not hasattr(self, "m"):
            self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
            self.s, self.t = {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for x, mask, y, weight in batches:
            _, g = self.gradients(x, mask, y, weight)
            self.t += 1
            for k in self.p:
                self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
                self.s[k] = 0.99 * self.s[k] + 0.01 * g[k] ** 2
                step = (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.s[k] / (1 - 0.99 ** self.t)) + 1e-8)
                self.p[k] = (self.p[k] - rate * step).astype(np.float32)

    def logits(self, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), BLOCK):
            i = index[at:at + BLOCK]
            out[at:at + BLOCK] = self.forward(table[i], i < len(table) - 1)
        return out


class Model:
    def __init__(self, network: Network | None, tables: np.ndarray | None, share: float) -> None:
        self.network, self.tables, self.share = network, tables, share

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.share)
        if self.network is None:
            return out
        words = Words(column)
        index, row = windows(words, len(column))
        if len(row):
            logit = self.network.logits(inputs(words, self.tables), index)
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.maximum.reduceat(logit, first).astype(np.float64)
            out[row[first]] = 1 / (1 + np.exp(-np.clip(best, -30, 30)))
        return out


def fit(texts: list[str], y: np.ndarray, rounds: int = 6, seed: int = 3) -> Model:
    """The model of a sample of texts and 0/1 labels."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or y.all() or not y.any():
        return Model(None, None, share)
    parts = range(0, len(y), 250)
    evidence = Evidence()
    for at in parts:
        evidence.add(Words(pa.array(texts[at:at + 250], pa.string())), y[at:at + 250])
    own = [evidence.tables(c) for c in (0, 1)]
    sets = []  # inputs of the distinct words as either class sees them, windows, their rows, labels
    for at in parts:
        words, yy = Words(pa.array(texts[at:at + 250], pa.string())), y[at:at + 250]
        index, row = windows(words, len(yy))
        sets.append((np.stack([inputs(words, t) for t in own]), index.astype(np.int32), row, yy))
    del own
    rng, net = np.random.default_rng(seed), Network()
    for r in range(rounds):
        xs, masks, ys = [], [], []
        for table, index, row, yy in sets:
            if not len(row):
                continue
            kind = yy[row].astype(int)
            if r:
                rank = np.empty(len(row), np.float32)
                for c in (0, 1):
                    rank[kind == c] = net.logits(table[c], index[kind == c])
            else:  # at first by the evidence alone
                rank = table[kind[:, None], index][..., [0, 1, 3]].max(axis=(1, 2))
            order = np.lexsort((-rank, row))
            nth = np.arange(len(row)) - np.repeat(np.searchsorted(row, np.unique(row)), np.unique(row, return_counts=True)[1])
            take = order[(nth == 0) | ((kind[order] == 0) & ((nth < 3) | (rng.random(len(row)) < 0.05)))]
            xs.append(table[kind[take][:, None], index[take]])
            masks.append(index[take] < table.shape[1] - 1)
            ys.append(kind[take])
        x, mask, t = np.concatenate(xs), np.concatenate(masks), np.concatenate(ys).astype(np.float32)
        weight = np.where(t == 1, 0.5 * len(t) / max(1, t.sum()), 0.5 * len(t) / max(1, (1 - t).sum())).astype(np.float32)
        weight = np.sqrt(weight)
        batches = max(1, len(t) // 256)
        for _ in range(max(1, -(-LEAST_STEPS // batches))):  # a small sample is gone over several times
            order = rng.permutation(len(t))
            net.fit(((x[i], mask[i], t[i], weight[i]) for i in np.array_split(order, batches)),
                    0.02 if r < rounds // 2 else 0.005)
    for extra in ("m", "s"):
        delattr(net, extra)
    return Model(net, evidence.tables(), share)


def train_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic: int = SAMPLE_TOXIC,
                clean: int = SAMPLE_CLEAN) -> Model:
    ids = training_ids(labels, label)
    parts = [smallest_hashes(ids.filter(F.col("y") == c), "y", n) for c, n in ((0, clean), (1, toxic))]
    chosen = parts[0].unionByName(parts[1]).select("doc_id").distinct()
    train = labelled(docs, labels, label).join(F.broadcast(chosen), "doc_id")
    train = one_text_each(train.select("doc_id", "y", "text"), "doc_id", "y")

    def learn(got: pd.DataFrame) -> Model:
        got = got.sort_values(["doc_id", "y"], kind="stable")
        order = np.random.default_rng(1).permutation(len(got))  # toxic and clean mixed in each part
        texts, y = got["text"].tolist(), got["y"].to_numpy(np.int64)[order]
        del got
        return fit([texts[i] for i in order], y)

    return fit_in_task(train, learn)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(part.column("text")))],
                                             ["doc_id", "score"])

    out = text_rows(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) without the rows that score ``threshold`` or more:
    scored and dropped where they are read, without a join."""
    model = train_model(docs, labels)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            yield part.filter(pa.array(shared.value.score(part.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)
