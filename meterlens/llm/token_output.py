"""Token-ID files: patched frame-of-reference (PFOR) blocks.

Texts are encoded with the tokenizers library, an end id closes every document,
and the ids are written in ascending doc_id order.  The output folder is a
table of segments; a segment is a self-contained binary image of whole
documents (about ``SEGMENT_IDS`` ids, or one longer document):

    header     magic "PFR1", then u32 version, u64 ids, u32 documents,
               u32 blocks, u32 ids a block
    documents  u32 number of ids of each document
    index      u32 byte offset of each block from the first block
    blocks     u32 minimum, u8 width, u8 exceptions, u16 zero; the ids less the
               minimum in ``width`` bits each (little-endian 64-bit words);
               the exceptions' places (u8 each), then their high parts (u32)

A block holds ``BLOCK_IDS`` ids (the last one repeats its minimum).  Its width
is the smallest that holds the ``PERCENTILE`` share of its differences; the
others are exceptions.  The index gives random access (``read_range``).

Encoding splits a text at ASCII white space and looks the pieces up in a cache
of ids (new distinct pieces are encoded in batches by the library).  This equals
encoding the whole text only for a tokenizer that drops white space and treats
what lies between it independently, so the tokenizer's own description is
checked first; any other tokenizer gets the whole texts.

Cases: a null or empty text has only the end id; rows without doc_id come
first; equal doc_ids are ordered by the hash of their text; extra columns are
ignored; an empty table gives no segments and no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gather, same_spans, shared_folder, ship, slices, span_hashes, text_rows, utf8

END_ID, BLOCK_IDS, SEGMENT_IDS, PERCENTILE = 2, 128, 1 << 18, 0.9
CACHE_PIECES, TABLE_BITS, LONGEST_KNOWN, JOINED = 1_200_000, 21, 1024, 200
SLICE_BYTES = 4 << 20
MAGIC, VERSION = b"PFR1", 1
HEADER = struct.Struct("<4sIQIII")


class _Growing:
    """An array that doubles its room when it is full."""

    def __init__(self, start: np.ndarray) -> None:
        self.room, self.size = start, len(start)

    def add(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.room):
            room = np.empty(max(need, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:need] = more
        self.size = need

    @property
    def held(self) -> np.ndarray:
        return self.room[:self.size]


class PieceEncoder:
    """Ids of texts whose pieces between separators encode independently.

    Distinct pieces of a batch are looked up in a table by 64-bit hash (one
    place a hash, the last piece wins it) and compared with the bytes of the
    entry found; only the others are encoded.  The table of 2^``bits`` places and
    its ids start anew after ``most`` pieces.  Pieces over ``LONGEST_KNOWN``
    bytes are never looked up."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], split: Callable[[pa.Array], pa.Array],
                 most: int = CACHE_PIECES, bits: int = TABLE_BITS) -> None:
        self.encode, self.split, self.most, self.bits = encode, split, most, bits
        self._clear()

    def _clear(self) -> None:
        self.key, self.number = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.flat, self.start = _Growing(np.zeros(0, np.int32)), _Growing(np.zeros(1, np.int64))
        self.spelled, self.spelled_at = _Growing(np.zeros(0, np.uint8)), _Growing(np.zeros(1, np.int64))  # bytes of the short entries

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The entry of each distinct piece."""
        data, offsets = utf8(pieces)
        base = int(offsets[0])
        data, offsets = data[base:int(offsets[-1])], offsets - base
        sizes = np.diff(offsets)
        h = span_hashes(data, offsets[:-1], offsets[1:])
        slot = (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        short = sizes <= LONGEST_KNOWN
        known = (self.key[slot] == h) & short & (h != 0)
        entry = self.number[slot].astype(np.int64)
        at, spelled_at = np.flatnonzero(known), self.spelled_at.held
        begin = spelled_at[entry[at]]
        known[at] = spelled_at[entry[at] + 1] - begin == sizes[at]
        alike = known[at]
        at, begin = at[alike], begin[alike]
        known[at] = same_spans(data, offsets[at], self.spelled.held, begin, sizes[at])
        new = np.flatnonzero(~known)
        if not len(new):
            return entry
        if self.start.size + len(new) > self.most and self.start.size > 1:
            self._clear()
            new = np.arange(len(h))
        entry[new] = self.start.size - 1 + np.arange(len(new))
        ids, size = self.encode(pieces.take(pa.array(new)).to_pylist())
        self.flat.add(ids)
        self.start.add(self.start.held[-1] + np.cumsum(size))
        kept = new[short[new]]
        self.spelled.add(utf8(gather(data, offsets[kept], offsets[kept + 1]))[0])
        self.spelled_at.add(self.spelled_at.held[-1] + np.cumsum(np.where(short[new], sizes[new], 0)))
        self.key[slot[kept]], self.number[slot[kept]] = h[kept], entry[kept]
        return entry

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each row)."""
        lists = self.split(texts)
        pieces = lists.flatten()
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pieces.dictionary_encode()
        number = self._numbers(coded.dictionary)[np.asarray(coded.indices)]
        start = self.start.held
        size = start[number + 1] - start[number]
        ends = np.cumsum(size)
        ids = self.flat.held[np.arange(int(ends[-1])) + np.repeat(start[number] - (ends - size), size)]
        bounds = np.r_[0, ends][np.cumsum(np.r_[0, np.asarray(lists.value_lengths())])]
        return ids, np.diff(bounds)


def encode_whole(library, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each text), each text by itself."""
    rows = [e.ids for at in range(0, len(texts), 20_000)
            for e in library.encode_batch_fast(texts[at:at + 20_000], add_special_tokens=False)]
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((i for r in rows for i in r), np.int32, int(size.sum())), size


def encode_joined(library, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``encode_whole`` for independent pieces, many to a text: joined by
    spaces, and the ids given back to the pieces by their places."""
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    groups = [pieces[at:at + JOINED] for at in range(0, len(pieces), JOINED)]
    for at in range(0, len(groups), 100):
        some = groups[at:at + 100]
        for e, group in zip(library.encode_batch([" ".join(g) for g in some], add_special_tokens=False), some):
            begin = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1)
            begin = np.r_[-1, begin[:-1] - 1]  # a piece's ids may begin at the space before it
            got = np.array(e.ids, np.int32)
            place = np.fromiter((a for a, _ in e.offsets), np.int64, len(got))
            ids.append(got)
            sizes.append(np.bincount(np.searchsorted(begin, place, side="right") - 1, minlength=len(group)))
    return np.concatenate(ids), np.concatenate(sizes)


def pieces_are_independent(spec: dict) -> bool:
    """Whether a tokenizer's description drops white space and treats the
    pieces between it one by one."""
    normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    plain = all(s["type"] in ("NFC", "Lowercase") or s == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
                for s in steps)
    before = spec.get("pre_tokenizer") or {}
    first = (before.get("pretokenizers") or [before])[0]
    drops = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
             and first.get("pattern", {}).get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]))
                for t in spec.get("added_tokens", []))
    return plain and drops and added and spec.get("post_processor") is None


_ENCODERS: dict[str, PieceEncoder] = {}


def text_encoder(description: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """An encoder for a tokenizer given as the text of its JSON file; one is
    kept in each worker process, so its table serves later tasks too."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    from tokenizers import Tokenizer

    if description not in _ENCODERS:
        library = Tokenizer.from_str(description)
        if pieces_are_independent(json.loads(description)):
            made = PieceEncoder(partial(encode_joined, library), lambda t: _without_empty(pc.ascii_split_whitespace(t)))
        else:
            made = PieceEncoder(partial(encode_whole, library),
                                lambda t: pa.ListArray.from_arrays(np.arange(len(t) + 1, dtype=np.int32), t))
        _ENCODERS.clear()
        _ENCODERS[description] = made
    return _ENCODERS[description]


def _without_empty(lists: pa.Array) -> pa.ListArray:
    flat, size = lists.flatten(), np.asarray(lists.value_lengths())
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    if keep.all():
        ends = np.cumsum(np.r_[0, size])
        return pa.ListArray.from_arrays(ends.astype(np.int32), flat)
    ends = np.r_[0, np.cumsum(keep)][np.cumsum(np.r_[0, size])]
    return pa.ListArray.from_arrays(ends.astype(np.int32), flat.filter(pa.array(keep)))


# ---- the format -------------------------------------------------------------


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits needed for each non-negative value (0 for 0)."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK_IDS) values of ``width`` bits as (blocks, 2 * width) words."""
    out = np.zeros((len(values), BLOCK_IDS * width // 64), np.uint64)
    for j in range(BLOCK_IDS if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, word] |= values[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= values[:, j] >> np.uint64(64 - shift)
    return out


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK_IDS), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK_IDS if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return out & mask


def write_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """The image of documents of ``sizes`` ids each."""
    n, blocks = len(ids), -(-len(ids) // BLOCK_IDS)
    padded = np.zeros(blocks * BLOCK_IDS, np.uint64)
    padded[:n] = ids
    if n < len(padded):
        padded[n:] = padded[(blocks - 1) * BLOCK_IDS:n].min()
    x = padded.reshape(blocks, BLOCK_IDS)
    low = x.min(axis=1) if blocks else np.zeros(0, np.uint64)
    x = x - low[:, None]
    at = max(0, int(np.ceil(PERCENTILE * BLOCK_IDS)) - 1)
    width = _bits(np.partition(x, at, axis=1)[:, at]) if blocks else np.zeros(0, np.int64)
    high = x >> width[:, None].astype(np.uint64)
    out_of = high > 0
    count = out_of.sum(axis=1)
    size = 8 + 16 * width + 5 * count
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    head = np.zeros((blocks, 8), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, count
    body[start[:, None] + np.arange(8)] = head
    for w in np.unique(width):
        b = np.flatnonzero(width == w)
        kept = x[b] & np.uint64((1 << int(w)) - 1)
        raw = np.ascontiguousarray(_packed(kept, int(w))).view(np.uint8).reshape(len(b), -1)
        body[start[b][:, None] + 8 + np.arange(raw.shape[1])] = raw
    block, place = np.nonzero(out_of)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    first = start[block] + 8 + 16 * width[block]
    body[first + nth] = place
    value = high[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    body[(first + count[block] + 4 * nth)[:, None] + np.arange(4)] = value
    return b"".join([HEADER.pack(MAGIC, VERSION, n, len(sizes), blocks, BLOCK_IDS), np.asarray(sizes).astype("<u4").tobytes(),
                     start.astype("<u4").tobytes(), body.tobytes()])


def _parts(image: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    magic, version, n, docs, blocks, per = HEADER.unpack_from(image)
    if magic != MAGIC or version != VERSION or per != BLOCK_IDS:
        raise ValueError("not a segment of this format")
    at = HEADER.size
    sizes = np.frombuffer(image, "<u4", docs, at).astype(np.int64)
    start = np.frombuffer(image, "<u4", blocks, at + 4 * docs).astype(np.int64)
    return n, sizes, start, np.frombuffer(image, np.uint8, offset=at + 4 * docs + 4 * blocks)


def _blocks(body: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``start``."""
    out = np.zeros((len(start), BLOCK_IDS), np.uint64)
    if not len(start):
        return out.reshape(-1)
    head = body[start[:, None] + np.arange(8)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").reshape(-1).astype(np.uint64)
    width, count = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    for w in np.unique(width):
        b = np.flatnonzero(width == w)
        raw = np.ascontiguousarray(body[start[b][:, None] + 8 + np.arange(16 * w)])
        out[b] = _unpacked(raw.view(np.uint64).reshape(len(b), -1), int(w))
    block = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    first = start[block] + 8 + 16 * width[block]
    place = body[first + nth]
    value = np.ascontiguousarray(body[(first + count[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    out[block, place] |= value.astype(np.uint64) << width[block].astype(np.uint64)
    return (out + low[:, None]).reshape(-1)


def read_segment(image: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids as unsigned 32-bit, ids of each document)."""
    n, sizes, start, body = _parts(image)
    return _blocks(body, start)[:n].astype(np.uint32), sizes


def read_range(image: bytes, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a segment; only their blocks are unpacked."""
    n, _, start, body = _parts(image)
    end = min(end, n)
    if begin >= end:
        return np.zeros(0, np.uint32)
    first = begin // BLOCK_IDS
    got = _blocks(body, start[first:-(-end // BLOCK_IDS)])
    return got[begin - first * BLOCK_IDS:end - first * BLOCK_IDS].astype(np.uint32)


# ---- writing and reading a folder -------------------------------------------


def write(docs: DataFrame, description: str, path: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Encode ``docs`` and write the segments in ascending doc_id order."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(description)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = text_encoder(shared.value)
        part, seq, before = TaskContext.get().partitionId(), 0, 0

        def segment(doc_ids, ids, sizes):
            nonlocal seq, before
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(np.array([0, len(doc_ids)], np.int32), doc_ids), pa.array([write_segment(ids, sizes)], pa.binary())],
                ["part", "seq", "before", "n_tokens", "doc_ids", "image"])
            seq, before = seq + 1, before + len(ids)
            return out

        held = None  # doc_ids, ids and sizes that do not fill a segment yet
        for rows in slices(batches, "text", SLICE_BYTES):
            ids, size = encode(rows.column("text"))
            ids, size, doc_ids = np.insert(ids, np.cumsum(size), end_id), size + 1, rows.column("doc_id")
            if held is not None:
                doc_ids, ids, size = pa.concat_arrays([held[0], doc_ids]), np.concatenate([held[1], ids]), np.concatenate([held[2], size])
            ends, at = np.cumsum(size), 0
            while at < len(size) and ends[-1] - (ends[at] - size[at]) >= SEGMENT_IDS:
                first = ends[at] - size[at]
                to = int(np.searchsorted(ends, first + SEGMENT_IDS)) + 1
                yield segment(doc_ids.slice(at, to - at), ids[first:ends[to - 1]], size[at:to])
                at = to
            first = ends[at] - size[at] if at < len(size) else len(ids)
            held = (doc_ids.slice(at), ids[first:], size[at:])
        if held is not None and len(held[2]):
            yield segment(*held)

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = text_rows(docs, "doc_id")
    order = ["doc_id", F.xxhash64("text")]  # the hash spreads a doc_id of many rows over partitions
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, f"part int, seq int, before long, n_tokens long, doc_ids array<{kind}>, image binary").write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    ship(spark)
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes = read_segment(batch.column("image")[i].as_py())
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes)
                begin = ends - sizes
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[i].as_py()] * len(sizes), pa.int32()), batch.column("doc_ids")[i].values,
                     pa.array(begin + batch.column("before")[i].as_py(), pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(crc, pa.int64())], ["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    docs = segments.select("part", "before", "doc_ids", "image").mapInArrow(
        run, f"part int, doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    total = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each written partition
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = total.select(F.col("part").alias("_part"), F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    return docs.join(offset, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("start") + F.col("_ahead")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the table's ids to a new folder and read them back."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        description = f.read()
    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, description, path)
    return read(spark, path)
