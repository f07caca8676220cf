"""Token-id files of patched frame-of-reference blocks.

A segment holds the ids of some whole documents, in ascending ``doc_id`` order.  Its
ids are cut into blocks.  From each the minimum is subtracted; the rest is packed at
the width that a chosen share of the block fits in.  Larger values leave their high
bits in the block's exception list.  An index gives the start of every block, so that
any id can be read without decoding what is before it.

Layout, little-endian: header ``<4sIQQQ`` (magic, block size, documents, ids, blocks);
doc_id int64 and its validity uint8 for each document, ids of each document uint64;
blocks + 1 byte offsets uint64; then the blocks: minimum uint32, width uint8,
exceptions uint16, packed low bits, exception positions uint16, high parts uint32.

Segments are values of a Parquet table, because only Spark's writers reach every store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import partitions_for, slices, small_batches
from stratiform.llm.textbits import ragged
from stratiform.llm.tokens import Encoder, with_end

MAGIC, HEADER = b"PFR1", struct.Struct("<4sIQQQ")
BLOCK = 128
FITTING = 0.9  # share of a block that its width must fit

_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("patches", "<u2")])


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2**width`` as rows of bytes."""
    kind, bits = (">u2", 16) if width <= 16 else (">u4", 32)
    n, k = values.shape
    flags = np.unpackbits(values.astype(kind).view(np.uint8).reshape(n * k, bits // 8), axis=1)
    return np.packbits(flags[:, bits - width :].reshape(n, k * width), axis=1)


def _unpack(packed: np.ndarray, width: int, k: int) -> np.ndarray:
    kind, bits = (">u2", 16) if width <= 16 else (">u4", 32)
    n = len(packed)
    flags = np.zeros((n * k, bits), np.uint8)
    flags[:, bits - width :] = np.unpackbits(packed, axis=1, count=k * width).reshape(n * k, width)
    return np.packbits(flags, axis=1).view(kind).reshape(n, k).astype(np.uint32)


def encode(doc_ids: np.ndarray, valid: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK, fitting: float = FITTING) -> bytes:
    """One segment."""
    n = len(ids)
    blocks = -(-n // block)
    rows = np.empty(blocks * block, np.uint32)
    rows[:n] = ids
    if n < len(rows):
        rows[n:] = ids[(blocks - 1) * block :].min()
    rows = rows.reshape(blocks, block)
    head = np.zeros(blocks, _HEAD)
    head["least"] = rows.min(axis=1) if blocks else 0
    rest = rows - head["least"][:, None]
    lengths = _bit_length(rest)
    at = max(0, int(np.ceil(fitting * block)) - 1)
    width = np.partition(lengths, at, axis=1)[:, at] if blocks else np.zeros(0, np.uint8)
    head["width"] = width
    patched = lengths > width[:, None]
    head["patches"] = patched.sum(axis=1)
    packed_size = -(-block * width.astype(np.int64) // 8)
    patches = head["patches"].astype(np.int64)
    sizes = _HEAD.itemsize + packed_size + 6 * patches
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    body = np.zeros(int(starts[-1]), np.uint8)
    put = starts[:-1]
    body[put[:, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, _HEAD.itemsize)
    put = put + _HEAD.itemsize
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            bits = _pack(rest[own] & np.uint32((1 << int(w)) - 1), int(w))
            body[put[own][:, None] + np.arange(bits.shape[1])] = bits
    put = put + packed_size
    row, col = np.nonzero(patched)
    high = rest[row, col] >> width[row].astype(np.uint32)
    body[ragged(put, 2 * patches)] = col.astype("<u2").view(np.uint8)
    body[ragged(put + 2 * patches, 4 * patches)] = high.astype("<u4").view(np.uint8)
    parts = (
        HEADER.pack(MAGIC, block, len(counts), n, blocks),
        doc_ids.astype("<i8").tobytes(),
        valid.astype("u1").tobytes(),
        counts.astype("<u8").tobytes(),
        starts.astype("<u8").tobytes(),
        body.tobytes(),
    )
    return b"".join(parts)


class Segment:
    """A segment as read; ``block(i)`` decodes one block, ``ids()`` all of them."""

    def __init__(self, raw: bytes):
        magic, self.block_size, docs, self.n_ids, blocks = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        at = HEADER.size
        self.doc_id = np.frombuffer(raw, "<i8", docs, at)
        self.valid = np.frombuffer(raw, "u1", docs, at + 8 * docs).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        self.starts = np.frombuffer(raw, "<u8", blocks + 1, at).astype(np.int64)
        self.body = np.frombuffer(raw, np.uint8, offset=at + 8 * (blocks + 1))

    def _decode(self, blocks: np.ndarray) -> np.ndarray:
        k = self.block_size
        at = self.starts[blocks]
        head = np.ascontiguousarray(self.body[at[:, None] + np.arange(_HEAD.itemsize)]).view(_HEAD)[:, 0]
        width = head["width"]
        out = np.zeros((len(blocks), k), np.uint32)
        at = at + _HEAD.itemsize
        for w in np.unique(width):
            if w:
                own = np.flatnonzero(width == w)
                size = -(-k * int(w) // 8)
                out[own] = _unpack(self.body[at[own][:, None] + np.arange(size)], int(w), k)
        at = at + -(-k * width.astype(np.int64) // 8)
        patches = head["patches"].astype(np.int64)
        row = np.repeat(np.arange(len(blocks)), patches)
        col = self.body[ragged(at, 2 * patches)].view("<u2")
        high = self.body[ragged(at + 2 * patches, 4 * patches)].view("<u4")
        out[row, col] += high << width[row].astype(np.uint32)
        out += head["least"][:, None]
        return out

    def block(self, i: int) -> np.ndarray:
        return self._decode(np.array([i]))[0][: self.n_ids - i * self.block_size]

    def ids(self) -> np.ndarray:
        return self._decode(np.arange(len(self.starts) - 1)).ravel()[: self.n_ids]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode ``docs(doc_id, text)`` and write segments in ascending ``doc_id`` order.

    Rows are dealt by ranges of ``doc_id``, sorted within, and encoded where they lie;
    each slice of a few MB of text becomes a segment, so a task holds one at a time.
    Null ``doc_id`` comes first; rows that repeat a ``doc_id`` follow each other, ordered
    by text.  A null text is an empty one: ``end_id`` alone.  Other columns are ignored.
    An empty table gives an empty file.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole):
                doc_id = batch.column("doc_id")
                ids, counts = with_end(*encoder.ids(batch.column("text")), end_id)
                blob = encode(doc_id.fill_null(0).to_numpy(), doc_id.is_valid().to_numpy(zero_copy_only=False), counts, ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                    ["part", "seq", "n_ids", "segment"],
                )
                seq += 1

    small_batches(docs.sparkSession)
    parts = partitions_for(docs, 64 * 1024 * 1024)
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(segments, "part int, seq int, n_ids long, segment binary").write.option(
        "compression", "uncompressed"
    ).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the segments alone.

    ``start`` adds the ids of earlier ranges (one row for each), of earlier segments
    of the range, and of earlier documents of the segment.
    """
    files = spark.read.parquet(path)
    sizes = files.select("part", "seq", "n_ids")
    per_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    before_seq = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    begins = sizes.withColumn("inner", before_seq).join(before_part, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("begin"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, raw in zip(*(batch.column(c) for c in ("part", "seq", "segment"))):
                s = Segment(raw.as_buffer().to_pybytes())
                ends = np.cumsum(s.counts)
                bytes_of = memoryview(s.ids().astype("<u4").tobytes())
                crc = [zlib.crc32(bytes_of[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), s.counts.tolist())]
                k = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, part.as_py(), np.int32)),
                        pa.array(np.full(k, seq.as_py(), np.int32)),
                        pa.array(s.doc_id.astype(np.int64), mask=~s.valid),
                        pa.array(ends - s.counts),
                        pa.array(s.counts),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    read = files.select("part", "seq", "segment").mapInArrow(decode, "part int, seq int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return read.join(begins, ["part", "seq"]).select("doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
