"""Packing documents into sequences: shortest pack first, over the histogram of lengths.

Documents are cut into pieces of at most one sequence.  The driver sees only how many
pieces have each length: it places the lengths from the longest down, each into the
pack that is shortest so far, and counts packs of one pattern instead of listing them.
Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import slices, small_batches, staged
from stratiform.llm.textbits import ragged
from stratiform.llm.tokens import Encoder, with_end
from stratiform.session import local_frame

CAPACITY = 2048

# Ranks are counted in cells of one length; a cell has about this many pieces.
CELL_ROWS = 50_000


@dataclass(frozen=True)
class Places:
    """Pieces of ``length`` ranked from ``first`` to ``last`` go to packs of one pattern."""

    length: int
    first: int
    last: int
    sequence: int  # the pattern's first pack
    each: int  # pieces of this length in a pack
    offset: int  # where they begin in it


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Places]:
    """Patterns and their counts, as places for every length.

    Packs are kept by the room they have left, with equal ones counted together.  One
    step gives a length to as many packs of one pattern as there are pieces for.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    most = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while most and not room.get(most):
                most -= 1
            if most >= length:
                pattern, count = room[most].pop()
                used = min(count, left)
                if used < count:
                    room[most].append((pattern, count - used))
                space = most - length
                room[space].append(((*pattern, length), used))
            else:
                # No pack has room: open new ones, each for as many pieces as fit (or are left).
                each = min(left, capacity // length)
                packs = left // each
                used, space = packs * each, capacity - each * length
                room[space].append(((length,) * each, packs))
                most = max(most, space)
            left -= used
    counts: dict[tuple[int, ...], int] = defaultdict(int)
    for packs in room.values():
        for pattern, count in packs:
            counts[pattern] += count
    places, taken, sequence = [], defaultdict(int), 0
    for pattern in sorted(counts, reverse=True):
        count, offset = counts[pattern], 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            first = taken[length]
            taken[length] += each * count
            places.append(Places(length, first, taken[length] - 1, sequence, each, offset))
            offset += each * length
        sequence += count
    return places


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens[, ids]).

    Ids are those of the whole text followed by ``end_id``; a null text is an empty
    one.  Pieces are cut every ``capacity`` ids.
    """
    small_batches(docs.sparkSession)
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for whole in batches:
            for batch in slices(whole):
                ids, counts = with_end(*encoder.ids(batch.column("text")), end_id)
                pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), pieces)
                start = capacity * ragged(np.zeros(len(counts), np.int64), pieces)
                length = np.minimum(capacity, counts[doc] - start)
                at = (np.cumsum(counts) - counts)[doc] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                bounds = list(zip((4 * at).tolist(), (4 * (at + length)).tolist()))
                out = [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in bounds], pa.int64()),
                    pa.array(counts[doc]),
                ]
                if with_ids:
                    out.append(pa.array([bytes(raw[a:b]) for a, b in bounds], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in columns.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(cut, columns)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces(doc_id, start, length, ..)``.

    ``pieces`` is read twice and must give the same rows each time, as a table does.
    Ranks are taken within cells of a length, so that a length that most pieces share
    is spread over many tasks.  Among equal lengths, doc_id and start decide within a
    cell (null first); rows that are equal in all columns are interchangeable.
    Sequences are numbered without gaps from 0, and offsets in them leave none.
    """
    spark = pieces.sparkSession
    cells = 1 + pieces.count() // CELL_ROWS
    celled = pieces.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "start"), F.lit(cells)))
    counts = celled.groupBy("length", "_cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("n")
    offsets = counts.select("length", "_cell", before.alias("_before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = [(p.length, p.first, p.last, p.sequence, p.each, p.offset) for p in shortest_pack_first(histogram, capacity)]
    # One row for each length of each pattern; their number follows from the capacity.
    places = local_frame(spark, rows, "_length long, _first long, _last long, _sequence long, _each long, _offset long")
    others = [c for c in ("doc_id", "start", *sorted(pieces.columns)) if c not in ("length", "ids")]
    in_cell = F.row_number().over(Window.partitionBy("length", "_cell").orderBy(*dict.fromkeys(others)))
    ranked = celled.withColumn("_in_cell", in_cell).join(offsets, ["length", "_cell"]).withColumn("_rank", F.col("_before") + F.col("_in_cell") - 1)
    fits = (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last"))
    k = F.col("_rank") - F.col("_first")
    return (
        ranked.join(F.broadcast(places), fits)
        .withColumn("sequence_id", F.col("_sequence") + F.floor(k / F.col("_each")))
        .withColumn("offset", F.col("_offset") + k % F.col("_each") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pack all of ``docs(doc_id, text)``; one row for each piece.  See ``pack``."""
    return pack(staged(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves, (sequence_id, ids, n_tokens), from pieces with their ids.

    A sequence whose tokens number a power of two stays as it is; others are padded.
    A group is one sequence, at most ``capacity`` pieces.
    """
    spot = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(spot.alias("parts"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    padding = F.expr(f"repeat(unhex('{pad_id.to_bytes(4, 'little').hex()}'), cast({capacity} - n_tokens as int))")
    power = F.bit_count("n_tokens") == 1
    return whole.select(
        "sequence_id", F.when(power, joined).otherwise(F.concat(joined, padding.cast("binary"))).alias("ids"), "n_tokens"
    )
