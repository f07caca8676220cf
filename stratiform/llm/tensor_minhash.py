"""MinHash near-duplicates with tensored banding.

A document's distinct word shingles are sketched by two small collections of band
hashes.  A table key is a pair, one band of each collection, so ``bands`` x ``bands``
tables cost only ``2 * bands * rows`` minhashes.  Documents that meet in a table are
candidates; every link is confirmed on the full shingle sets.

Two documents of similarity s meet unless one collection fails as a whole, which
happens with probability below ``2 * (1 - s**rows)**bands``: 1e-5 at s = 0.8 with the
defaults, 1e-9 at 0.9.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import components, partitions_for, slices, small_batches, staged
from stratiform.llm.textbits import LOWER, Prefix, U, Words, flat, mix, ragged


# Rows of a block of a table in the second round.
BLOCK_ROWS = 1024

# A filter of documents takes this many bits each, but no more than so many bytes.
FILTER_BITS, FILTER_BYTES = 16, 64 * 1024 * 1024
_FILTER_PROBES = 3
_BITMAP = 32768  # bits of a bitmap that Spark aggregates


@dataclass(frozen=True)
class Banding:
    shingle: int = 5  # words
    similarity: int = 80  # percent
    bands: int = 12  # in each of the two collections
    rows: int = 2  # minhashes in a band
    bits: int = 512  # parity bits that bound the size of a difference
    more_bits: int = 4096  # the same for the second round

    @property
    def entry(self) -> np.dtype:
        """What a table entry carries: the first band's hash, the document, the second bands."""
        return np.dtype(
            [("left", "u8"), ("doc", "i8"), ("n", "i4"), ("right", "u4", self.bands), ("parity", "u8", self.bits // 64)]
        )


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and the size of each set.

    A-Z are lowered.  A text of fewer words than a shingle has one, its whole
    sequence; a null text or one without words has none.  Hashes have 64 bits, so two
    shingles of one comparison are taken for equal wrongly once in 1e12 documents.
    """
    data, offsets = flat(texts)
    data = LOWER[data]
    words = Words(data, offsets, Prefix(data))
    at, h = words.windows(width)
    per_text = np.diff(np.searchsorted(at, words.first))
    pieces, ends = [], np.cumsum(per_text)
    sizes = np.zeros(len(per_text), np.int64)
    for i, (end, n, k) in enumerate(zip(ends, per_text, words.count)):
        if n:
            own = np.sort(h[end - n : end])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])] if n > 1 else own
        elif k:
            whole = U(int(k))
            for w in words.hash[words.first[i] : words.first[i] + k]:
                whole = mix(np.array([whole ^ w]))[0] + U(1)
            own = np.array([whole], U)
        else:
            continue
        pieces.append(own)
        sizes[i] = len(own)
    return (np.concatenate(pieces) if pieces else np.zeros(0, U)), sizes


def _minhashes(values: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """``count`` minhashes of every set that is not empty."""
    rng = np.random.default_rng(7)
    xors = rng.integers(0, 2**64, count, dtype=U)
    factors = rng.integers(0, 2**63, count, dtype=U) * U(2) + U(1)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.empty((len(sizes), count), U)
    work = np.empty_like(values)
    for j in range(count):
        np.bitwise_xor(values, xors[j], out=work)
        work *= factors[j]
        out[:, j] = np.minimum.reduceat(work, begins)
    return out


def _bands(minhashes: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each run of ``rows`` minhashes; the place of the band is part of it."""
    n, m = minhashes.shape
    h = np.broadcast_to(np.arange(m // rows, dtype=U) + U(1), (n, m // rows)).copy()
    for k in range(rows):
        h = mix(h ^ minhashes[:, k::rows])
    return h


def _parity(values: np.ndarray, sizes: np.ndarray, bits: int, at_once: int = 256) -> np.ndarray:
    """For every set, the parity of how many members fall on each bit.

    Counted for ``at_once`` sets at a time: a count takes far more room than its parity.
    """
    out = np.zeros((len(sizes), bits // 64), U)
    ends = np.cumsum(sizes)
    for a in range(0, len(sizes), at_once):
        n = sizes[a : a + at_once]
        own = values[ends[a] - n[0] : ends[a + len(n) - 1]]
        cells = np.repeat(np.arange(len(n)), n) * bits + ((own >> U(17)) % U(bits)).astype(np.int64)
        counts = np.bincount(cells, minlength=len(n) * bits) & 1
        packed = np.packbits(counts.astype(np.uint8).reshape(len(n), bits), axis=1)
        out[a : a + at_once] = np.ascontiguousarray(packed).view(U)
    return out


def sketches(docs: DataFrame, b: Banding) -> DataFrame:
    """(doc_id, n, h1, h2, sketch): size and identity of each set, and its table entries.

    ``sketch`` holds the first bands, the second bands and the parity bits; it is null
    for an empty set.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                values, sizes = shingle_sets(batch.column("text"), b.shingle)
                some = sizes > 0
                blobs: list[bytes | None] = [None] * len(sizes)
                h1, h2 = np.zeros(len(sizes), U), np.zeros(len(sizes), U)
                if some.any():
                    n = sizes[some]
                    begins = np.concatenate([[0], np.cumsum(n)[:-1]])
                    h1[some] = np.add.reduceat(values, begins)
                    h2[some] = np.add.reduceat(mix(values), begins)
                    left, right = np.hsplit(_minhashes(values, n, 2 * b.bands * b.rows), 2)
                    packed = np.concatenate([_bands(left, b.rows), _bands(right, b.rows), _parity(values, n, b.bits)], axis=1)
                    for i, row in zip(np.flatnonzero(some), packed):
                        blobs[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(blobs, pa.binary())],
                    ["doc_id", "n", "h1", "h2", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n long, h1 long, h2 long, sketch binary")


def _send(parts: int, b: Banding):
    """Table entries of a batch, packed into one value for each shuffle partition."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), U).reshape(batch.num_rows, -1)
            entries = np.empty((batch.num_rows, b.bands), b.entry)
            entries["left"] = raw[:, : b.bands]
            entries["doc"] = batch.column("doc_id").to_numpy()[:, None]
            entries["n"] = batch.column("n").to_numpy()[:, None]
            entries["right"] = (raw[:, b.bands : 2 * b.bands] >> U(32)).astype(np.uint32)[:, None, :]
            entries["parity"] = raw[:, None, 2 * b.bands :]
            flat_entries = entries.ravel()
            part = (mix(flat_entries["left"]) % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            flat_entries, part = flat_entries[order], part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[np.concatenate([[0], cuts])]), pa.array([x.tobytes() for x in np.split(flat_entries, cuts)], pa.binary())],
                ["part", "blob"],
            )

    return send


def may_link(na, nb, pa_, pb, similarity: int) -> np.ndarray:
    """False only where sizes or parities prove the similarity to be lower.

    Linked sets differ in at most (100 - t) / (100 + t) of the sum of their sizes, and
    every bit in which their parities differ stands for a member of the difference.
    """
    na, nb = na.astype(np.int64), nb.astype(np.int64)
    fits = 100 * np.minimum(na, nb) >= similarity * np.maximum(na, nb)
    differ = np.bitwise_count(pa_ ^ pb).sum(axis=1).astype(np.int64)
    return fits & (differ * (100 + similarity) <= (100 - similarity) * (na + nb))


def _runs(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where equal neighbours begin in sorted keys, and how many there are, if ``least``."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    length = np.diff(np.append(begins, len(keys)))
    return begins[length >= least], length[length >= least]


def _meet(b: Banding):
    """Candidate pairs of a shuffle partition, and the tables that pairs with one member don't settle.

    In every table the smallest set is paired with all others.  For the second round,
    members of tables of three and more are passed on under the first half of the key.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for batch in batches for x in batch.column("blob").to_pylist()]
        if not blobs:
            return
        e = np.frombuffer(b"".join(blobs), b.entry)
        del blobs
        order = np.argsort(e["left"], kind="stable")
        begins, length = _runs(e["left"][order], 2)
        e = e[order[ragged(begins, length)]]
        if not len(e):
            return
        pairs, tables = [], []
        for j in range(b.bands):
            key = mix(e["left"] ^ (e["right"][:, j].astype(U) * U(0xA24BAED4963EE407) + U(j + 1)))
            order = np.lexsort((e["doc"], e["n"], key))
            begins, length = _runs(key[order], 2)
            if not len(begins):
                continue
            members = order[ragged(begins, length)]
            centre = np.repeat(order[begins], length)
            other = members != centre
            x, y = centre[other], members[other]
            linked = may_link(e["n"][x], e["n"][y], e["parity"][x], e["parity"][y], b.similarity)
            x, y = e["doc"][x[linked]], e["doc"][y[linked]]
            pairs.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
            big = length >= 3
            tables.append(order[ragged(begins[big], length[big])])
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        own = np.unique(np.concatenate(tables)) if tables else np.zeros(0, np.int64)
        table, doc = e["left"][own].view(np.int64), e["doc"][own]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(len(found), np.int64), table])),
                pa.array(np.concatenate([found[:, 0], doc])),
                pa.array(np.concatenate([found[:, 1], np.full(len(doc), -1)])),
                pa.array(np.concatenate([np.ones(len(found), bool), np.zeros(len(doc), bool)])),
            ],
            ["tab", "a", "b", "is_pair"],
        )

    return meet


def _common(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def _cross(b: Banding, at_once: int = 2048):
    """Links across components that meet in a cell of a table of the second round.

    Sets are at hand, so that only links leave the task.  A link joins its components,
    whose members are not compared again.
    """

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, packed = ("tab", "lo", "hi", "side", "doc_id", "n", "component_id"), ("right", "parity")
        got = [
            (*(batch.column(c).to_numpy() for c in plain), *(b"".join(batch.column(c).to_pylist()) for c in packed), batch.column("members").to_pylist())
            for batch in batches
            if batch.num_rows
        ]
        if not got:
            return
        tab, lo, hi, side, doc, n, comp = (np.concatenate([g[i] for g in got]) for i in range(7))
        right, parity = (np.frombuffer(b"".join(g[i] for g in got), U).reshape(len(doc), -1) for i in (7, 8))
        members = [np.frombuffer(x, U) for g in got for x in g[9]]
        del got
        cell = mix(mix(tab.view(U)) ^ (lo.astype(U) << U(32)) ^ hi.astype(U))
        order = np.lexsort((n, cell))
        cell, side, doc, n, comp = cell[order], side[order], doc[order], n[order], comp[order]
        across = (lo != hi)[order]
        for begin, length in zip(*_runs(cell, 2)):
            end = begin + length
            for i in range(begin, end - 1):
                # Sorted by size: partners end where sets become too large.
                stop = begin + np.searchsorted(n[begin:end], n[i] * 100 // b.similarity, "right")
                for k in range(i + 1, stop, at_once):
                    s = np.arange(k, min(k + at_once, stop))
                    # Between two blocks, rows of one are left to that block's own cell.
                    s = s[(comp[s] != comp[i]) & (~across[s] | (side[s] != side[i]))]
                    s = s[(right[order[s]] == right[order[i]]).any(axis=1)]
                    one = order[i : i + 1]
                    s = s[may_link(n[i : i + 1], n[s], parity[one], parity[order[s]], b.similarity)]
                    for j in s.tolist():
                        if comp[i] == comp[j]:
                            continue
                        both = _common(members[order[i]], members[order[j]])
                        if 100 * both >= b.similarity * (n[i] + n[j] - both):
                            comp[begin:end][comp[begin:end] == comp[j]] = comp[i]
                            yield pa.RecordBatch.from_arrays([pa.array([min(doc[i], doc[j])]), pa.array([max(doc[i], doc[j])])], ["a", "b"])

    return cross


def _cells(tables: DataFrame) -> DataFrame:
    """(tab, lo, hi, side, ..): rows of tables, in cells of two blocks of a table each.

    A table of more than ``BLOCK_ROWS`` rows is cut into blocks by a hash of the
    document, and each row goes to the cells of its block with every other one, so that
    a table that many documents share is compared by many tasks.
    """
    side = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    block = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    spread = tables.withColumn("side", side).withColumn("other", block)
    return spread.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")).drop("other", "blocks")


def _verify(pairs: DataFrame, sets: DataFrame, b: Banding) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = _common(x, y)
                keep.append(100 * both >= b.similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("sa"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("sb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long")


class IdFilter:
    """A Bloom filter of documents: never false for one of them, seldom true for another.

    Built from bitmaps that Spark aggregates; its size is bounded, and beyond the bound
    it lets more of the others through.
    """

    def __init__(self, ids: DataFrame, count: int):
        self.bits = int(min(FILTER_BYTES * 8, max(_BITMAP, FILTER_BITS * count)) // _BITMAP * _BITMAP)
        at = ids.select(F.explode(self.probes("doc_id")).alias("at"))
        maps = at.groupBy(F.floor(F.col("at") / _BITMAP).alias("map")).agg(F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("bits"))
        packed = np.zeros(self.bits // 8, np.uint8)
        for row in maps.collect():
            packed[row["map"] * _BITMAP // 8 :][: _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
        self.packed = ids.sparkSession.sparkContext.broadcast(packed)

    def probes(self, column: str) -> Column:
        return F.array(*(F.pmod(F.xxhash64(F.lit(i), F.col(column)), F.lit(self.bits)) for i in range(_FILTER_PROBES)))

    def holds(self, probes: pa.Array) -> np.ndarray:
        at = probes.flatten().to_numpy().reshape(-1, _FILTER_PROBES)
        return (self.packed.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)


def near_duplicates(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs(doc_id, text)``.

    Links are followed to whole components; the smallest ``doc_id`` of each is kept.
    Texts with equal sets are one class and stand for each other, so groups of exact
    copies of any size cost one aggregate.  A null or wordless text has an empty set
    and is linked with nothing.  Rows that repeat a ``doc_id`` form one document each
    in the counts; they share the component if their sets are linked.  A row without
    ``doc_id`` is its own component, null, and kept.  Other columns are ignored.

    Within a table the first round pairs one member with all others.  Only tables
    whose members still lie in several components are compared further, and only
    across components, so that a table adds links and never all of its pairs.
    """
    b = banding or Banding()
    small_batches(docs.sparkSession)
    parts = partitions_for(docs, 8 * 1024 * 1024)
    known = docs.where("doc_id is not null")
    every = staged(sketches(known, b), "sketches")
    # Written before it is joined: adaptive execution can split a class of many rows only
    # where both sides come straight from a shuffle.
    rep = staged(every.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    classes = every.where("n > 0").join(rep, ["h1", "h2", "n"])
    # One row for each class, also where its smallest doc_id repeats.
    reps = staged(
        every.where("n > 0").join(rep.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "n", "doc_id"], "left_semi")
        .groupBy("doc_id", "h1", "h2", "n").agg(F.min("sketch").alias("sketch")).select("doc_id", "n", "sketch"),
        "class-sketches",
    )
    met = staged(
        reps.mapInArrow(_send(parts, b), "part long, blob binary")
        .repartitionById(parts, F.col("part").cast("int"))
        .mapInArrow(_meet(b), "tab long, a long, b long, is_pair boolean"),
        "met",
    )
    pairs = met.where("is_pair").select("a", "b").distinct()
    tables = met.where("not is_pair").select("tab", F.col("a").alias("doc_id")).distinct()
    candidates = staged(
        pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionAll(tables.select("doc_id")).distinct(), "candidates"
    )
    chosen = IdFilter(candidates, candidates.count())

    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unfiltered in batches:
            whole = unfiltered.filter(pa.array(chosen.holds(unfiltered.column("probes"))))
            for batch in slices(whole):
                values, sizes = shingle_sets(batch.column("text"), b.shingle)
                ends = np.cumsum(sizes)
                members = [values[e - n : e].tobytes() for e, n in zip(ends, sizes)]
                parity = [x.tobytes() for x in _parity(values, sizes, b.more_bits)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(members, pa.binary()), pa.array(parity, pa.binary())], ["doc_id", "members", "parity"]
                )

    # Texts are not shuffled: the few sets of other documents that the filter lets through
    # find no partner in the joins below.
    texts = known.select("doc_id", "text", chosen.probes("doc_id").alias("probes"))
    sets = staged(texts.mapInArrow(collect_sets, "doc_id long, members binary, parity binary"), "sets")
    links = staged(_verify(pairs, sets, b), "links")
    labels = components(links)
    # Second round: tables that still hold more than one component.
    labelled = staged(
        tables.join(labels, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id")), "labelled"
    )
    mixed = (
        labelled.groupBy("tab")
        .agg(F.min("component_id").alias("x"), F.max("component_id").alias("y"), F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        .where("x <> y").select("tab", "blocks")
    )
    rights = reps.select("doc_id", "n", F.substring("sketch", 8 * b.bands + 1, 8 * b.bands).alias("right"))
    open_tables = (
        _cells(labelled.join(mixed, "tab"))
        .join(rights, "doc_id")
        .join(sets.select("doc_id", "parity", "members"), "doc_id")
    )
    more = open_tables.repartition(parts, "tab", "lo", "hi").mapInArrow(_cross(b), "a long, b long")
    links = links.unionAll(staged(more.distinct(), "links"))
    # Rows of one doc_id with different texts are different classes of one document.
    same_id = classes.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.unionAll(same_id))
    out = every.select("doc_id", F.col("n").alias("n_shingles")).join(final, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    lost = docs.where("doc_id is null").select("doc_id", "text")
    nothing = sketches(lost, b).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionAll(nothing).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
