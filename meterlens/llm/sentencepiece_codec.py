"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf; its wire format is read here (pieces with scores
and types, trainer and normaliser settings), and an equal pipeline is built:

* normaliser: the precompiled character map, removal of extra spaces, the dummy
  space in front and the metaspace marker, as the model's flags say;
* model: ``Unigram`` with the pieces' scores, or ``BPE`` with merges ranked by
  the merged pieces' scores; byte fallback either way;
* decoder: marker to space, bytes to text, the dummy space removed.

Texts are encoded in batches, multithreaded.  No piece of such a model reaches
over a gap (a character other than the marker, then the marker): this is checked
on the vocabulary, and then a text may be cut at single spaces and its words be
looked up in a cache, the distinct new ones encoded as a batch.  Texts that a
normaliser would change, that hold the marker itself, runs of spaces or a space
at an end go whole.  A unigram lattice of the tokenizers library would also take the names of
control, unknown and byte pieces for those pieces when a text spells them out;
such texts are left to the sentencepiece library.  ``encode`` verifies parity with the sentencepiece library on every
text; where the ids differ, the library's ids are kept and ``parity`` is false.

Cases: a null or empty text has no ids and decodes to the empty string;
repeated rows are encoded alike; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, text_rows
from .token_output import PieceEncoder, encode_joined, encode_whole

MARK = "▁"
SLICE_BYTES = 2 << 20
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack_from("<f", data, at)[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, struct.unpack_from("<d", data, at)[0]
            at += 8
        else:
            raise ValueError(f"wire type {kind}")


class ModelFile:
    """What the protobuf holds."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        trainer, normaliser = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.character_map: bytes = normaliser.get(2, b"")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.single_spaces = bool(normaliser.get(4, 1))
        self.mark_spaces = bool(normaliser.get(5, 1))
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        if trainer.get(24, 0) or not self.mark_spaces or any(p[2] == USER_DEFINED for p in self.pieces):
            raise ValueError("models with suffix markers, unmarked spaces or user-defined pieces are not rebuilt")

    def cuts_at_spaces(self) -> bool:
        """Whether no piece goes on over a space after another character."""
        return not any(MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind == NORMAL)


def build(model: ModelFile):
    """The tokenizers pipeline equal to the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    names = [p for p, _, _ in model.pieces]
    if model.kind == UNIGRAM:
        inner = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        number = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        merges = []
        for p, score, kind in model.pieces:
            if kind == NORMAL:
                merges += [(-score, number[p], number[p[:k]], number[p[k:]], (p[:k], p[k:]))
                           for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        merges.sort(key=lambda m: m[:4])
        inner = models.BPE({p: i for i, p in enumerate(names)}, [m[4] for m in merges], unk_token=names[model.unknown],
                           fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind}")
    out = Tokenizer(inner)
    steps = [normalizers.Precompiled(model.character_map)] if model.character_map else []
    if model.single_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Replace(" ", MARK)]
    if model.dummy_prefix:
        steps += [normalizers.Prepend(MARK)]
    out.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return out


class Codec:
    """Encoding and decoding of text columns with one model file."""

    def __init__(self, data: bytes, threads: int = 2) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        self.model, self.threads = ModelFile(data), threads
        self.library = build(self.model)
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        plain = not self.model.character_map and not self.model.single_spaces
        self.by_words = plain and self.model.dummy_prefix and self.model.cuts_at_spaces()
        names = "|".join(re.escape(p) for p, _, kind in self.model.pieces if kind in (UNKNOWN, CONTROL))
        self.spelled = rf"{names}|<0x[0-9A-F]{{2}}>" if self.model.kind == UNIGRAM else None
        self.words = PieceEncoder(partial(encode_joined, self.library), lambda t: pc.split_pattern(t, " "), 700_000, 20)

    def restores(self, ids: np.ndarray, size: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Whether the built decoder turns the ids of each row into its text again."""
        return np.asarray(pc.equal(pa.array(self.decode(ids, size), texts.type), texts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each row) of texts without nulls."""
        if self.by_words:
            odd = np.asarray(pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))))
            odd = odd | np.asarray(pc.match_substring(texts, MARK)) | (np.asarray(pc.binary_length(texts)) == 0)
        else:
            odd = np.ones(len(texts), bool)
        left = np.zeros(len(texts), bool)
        if self.spelled:
            left = np.asarray(pc.match_substring_regex(texts, self.spelled))
            odd = odd | left
        rows: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        even = np.flatnonzero(~odd)
        if len(even) == len(texts):
            return self.words(texts)
        if len(even):
            ids, size = self.words(texts.take(pa.array(even)))
            for i, part in zip(even, np.split(ids, np.cumsum(size)[:-1])):
                rows[i] = part
        for i in np.flatnonzero(left):
            rows[i] = np.array(self.judge.encode(texts[int(i)].as_py()), np.int32)
        whole = [int(i) for i in np.flatnonzero(odd & ~left) if texts[int(i)].as_py()]
        ids, size = encode_whole(self.library, [texts[i].as_py() for i in whole])
        for i, part in zip(whole, np.split(ids, np.cumsum(size)[:-1]) if whole else []):
            rows[i] = part
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)

    def checked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` held against the sentencepiece library on every text:
        ids, ids of each row, whether they were equal."""
        ids, size = self.encode(texts)
        wanted = self.judge.encode(texts.to_pylist(), num_threads=self.threads)
        length = np.fromiter(map(len, wanted), np.int64, len(wanted))
        flat = np.fromiter(chain.from_iterable(wanted), np.int32, int(length.sum()))
        if len(ids) == len(flat) and (size == length).all() and (ids == flat).all():
            return ids, size, np.ones(len(texts), bool)
        mine, theirs = np.split(ids, np.cumsum(size)[:-1]), np.split(flat, np.cumsum(length)[:-1])
        return flat, length, np.array([np.array_equal(a, b) for a, b in zip(mine, theirs)])

    def decode(self, ids: np.ndarray, size: np.ndarray) -> list[str]:
        rows = [r.tolist() for r in np.split(ids, np.cumsum(size)[:-1])] if len(size) else []
        return self.library.decode_batch(rows, skip_special_tokens=False)


_CODECS: dict[bytes, Codec] = {}


def codec_of(data: bytes) -> Codec:
    """The model's codec; one is kept in each worker process."""
    if data not in _CODECS:
        _CODECS.clear()
        _CODECS[data] = Codec(data)
    return _CODECS[data]


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, n_tokens, parity (equal to the sentencepiece library),
    decoded (whether the ids decode to the text again)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = codec_of(shared.value)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = part.column("text")
            ids, size, same = codec.checked(texts)
            back = pa.array(codec.restores(ids, size, texts))
            rows = pa.ListArray.from_arrays(np.cumsum(np.r_[0, size]).astype(np.int32), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows, pa.array(size, pa.int64()), pa.array(same), back],
                                             ["doc_id", "ids", "n_tokens", "parity", "decoded"])

    return text_rows(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_tokens long, parity boolean, decoded boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of rows with ``ids``; null ids decode to the empty string."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = codec_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                text = codec.decode(np.asarray(lists.flatten()).astype(np.int64), np.asarray(lists.value_lengths()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {kind}, text string")


def digest(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), parity, decoded of every document; the ids stay in the task."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = codec_of(shared.value)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = part.column("text")
            ids, size, same = codec.checked(texts)
            back = pa.array(codec.restores(ids, size, texts))
            raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(size)
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - size).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(same), back],
                ["doc_id", "n_tokens", "ids_crc32", "parity", "decoded"])

    return text_rows(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_crc32 long, parity boolean, decoded boolean")
