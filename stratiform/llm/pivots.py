"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) are drawn from the table and thinned until no two are close.
A vector is described by its ``prefix`` nearest pivots; close vectors rank the pivots
alike, so those that share at least ``shared`` of them are candidates.  Inverted lists,
one for each pivot, bring candidates together: within a list the pivots that pairs share
are counted, and the cosines of those that reach the count are computed.

A pair that shares several pivots meets in several lists; it belongs to the rarest pivot
it shares.  As a pair shares ``shared`` of them, a vector need not enter the lists of its
``shared - 1`` most frequent pivots.  Long lists are cut into blocks, and each pair of
blocks is a group of its own, so no task holds more than two blocks.  Groups return how
many links every vector has and a spanning forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import components, size_in_bytes, small_batches, staged


@dataclass(frozen=True)
class PivotIndex:
    similarity: float = 0.95  # cosine
    prefix: int = 8  # nearest pivots that describe a vector
    shared: int = 2  # of them that candidates share
    per_root: float = 8.0  # pivots for each square root of the number of vectors
    least: int = 64  # pivots
    most_bytes: int = 32 * 1024 * 1024  # of all pivots; bounds the sample and the broadcast
    apart: float = 0.8  # greatest cosine of two pivots
    block: int = 2048  # vectors


def valid(vector: Column) -> Column:
    """Whether a vector has a direction: components, none null or not finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1 in double precision; scaled first, so that squares stay finite."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of a matrix, filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), values.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def choose_pivots(classes: DataFrame, count: int, width: int, index: PivotIndex) -> np.ndarray:
    """At most as many unit vectors as the square root rule and the bound in bytes allow.

    They are the vectors with the smallest hashes.  One that is closer than ``apart`` to
    an earlier one goes: near copies of one vector rank pivots among them by chance.
    """
    wanted = int(min(max(index.least, index.per_root * count**0.5), index.most_bytes // (8 * width)))
    rows = classes.select("v", "h1", "h2").orderBy("h1", "h2").limit(wanted).collect()
    found = unit(np.array([list(r["v"]) + [0.0] * (width - len(r["v"])) for r in rows], np.float64))
    kept = np.zeros_like(found)
    n = 0
    for x in found:
        if not n or (kept[:n] @ x).max() <= index.apart:
            kept[n] = x
            n += 1
    return kept[:n]


def _nearest(pivots: np.ndarray, width: int, index: PivotIndex, at_once: int = 512):
    """(cls, n, v, near): the vector's values as bytes and its nearest pivots."""
    k = min(index.prefix, len(pivots))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, at_once):
                batch = whole.slice(a, at_once)
                raw = _matrix(batch.column("v"), width)
                cosine = unit(raw) @ pivots.T
                near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(k), (len(raw), 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("cls"),
                        batch.column("n"),
                        pa.array([x.tobytes() for x in raw], pa.binary()),
                        pa.array([x.tobytes() for x in near.astype("<i4")], pa.binary()),
                    ],
                    ["cls", "n", "v", "near"],
                )

    return nearest


def _count_lists(total: int, ranks: np.ndarray | None, sent: int):
    """Length of every pivot's list: of all that have it near, or of those that enter it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.zeros(total, np.int64)
        for batch in batches:
            if batch.num_rows:
                near = np.frombuffer(b"".join(batch.column("near").to_pylist()), "<i4").reshape(batch.num_rows, -1)
                own = near if ranks is None else np.sort(ranks[near], axis=1)[:, :sent]
                lengths += np.bincount(own.ravel(), minlength=total)
        some = np.flatnonzero(lengths)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(lengths[some])], ["pivot", "n"])

    return count


def _lengths(described: DataFrame, total: int, ranks: np.ndarray | None = None, sent: int = 0) -> np.ndarray:
    counted = described.select("near").mapInArrow(_count_lists(total, ranks, sent), "pivot long, n long")
    out = np.zeros(total, np.int64)
    for r in counted.groupBy("pivot").agg(F.sum("n").alias("n")).collect():
        out[r["pivot"]] = r["n"]
    return out


_ENTRY = "pivot int, lo int, hi int, side int, cls long, n long, v binary, near binary"


def _enter(ranks: np.ndarray, blocks: np.ndarray, sent: int):
    """Entries of every vector in its lists, one for each pair of blocks it takes part in.

    Pivots go by their ranks from here on, the rarest being 0.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.frombuffer(b"".join(batch.column("near").to_pylist()), "<i4").reshape(batch.num_rows, -1)
            near = np.sort(ranks[near], axis=1).astype("<i4")
            cls = batch.column("cls").to_numpy()
            pivot = near[:, :sent].ravel()
            row = np.repeat(np.arange(len(near)), min(sent, near.shape[1]))
            own = (cls[row] * 0x9E3779B1 >> 13) % blocks[pivot]
            times = blocks[pivot]
            other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            pivot, row, own = (np.repeat(x, times) for x in (pivot, row, own))
            for a in range(0, len(row), 4096):
                s = slice(a, a + 4096)
                lo, hi = np.minimum(own[s], other[s]), np.maximum(own[s], other[s])
                take = pa.array(row[s])
                packed = pa.array([x.tobytes() for x in near[row[s]]], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pivot[s], pa.int32()), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(own[s].astype(np.int32)),
                        *(batch.column(c).take(take) for c in ("cls", "n", "v")), packed,
                    ],
                    ["pivot", "lo", "hi", "side", "cls", "n", "v", "near"],
                )

    return enter


def shared_pivots(a: np.ndarray, b: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of rows, how many pivots they share, and whether one is rarer than ``pivot``."""
    count = np.zeros((len(a), len(b)), np.int8)
    rarer = np.zeros((len(a), len(b)), bool)
    for x in a.T:
        low = (x < pivot)[:, None]
        for y in b.T:
            same = x[:, None] == y[None, :]
            count += same
            if low.any():
                rarer |= same & low
    return count, rarer


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every vertex but one to another of its component, given all its links."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _verify(index: PivotIndex, kind: str, tile: int = 512):
    """Links of one group: (cls, null, links) for vectors, (a, b, null) for the forest.

    ``links`` counts the vectors that the other class stands for.
    """

    def verify(table: pa.Table) -> pa.Table:
        pivot, lo, hi = (table.column(c)[0].as_py() for c in ("pivot", "lo", "hi"))
        side, cls, n = (table.column(c).to_numpy() for c in ("side", "cls", "n"))
        rows = len(cls)
        x = unit(np.frombuffer(b"".join(table.column("v").to_pylist()), kind).reshape(rows, -1))
        near = np.frombuffer(b"".join(table.column("near").to_pylist()), "<i4").reshape(rows, -1)
        links = np.zeros(rows, np.int64)
        first, second = [], []
        left = np.flatnonzero(side == lo)
        right = left if lo == hi else np.flatnonzero(side == hi)
        for a in range(0, len(left), tile):
            for b in range(a if lo == hi else 0, len(right), tile):
                p, q = left[a : a + tile], right[b : b + tile]
                count, rarer = shared_pivots(near[p], near[q], pivot)
                candidate = (count >= min(index.shared, near.shape[1])) & ~rarer
                if lo == hi and a == b:
                    candidate &= np.arange(len(p))[:, None] < np.arange(len(q))[None, :]
                if not candidate.any():
                    continue
                linked = candidate & (x[p] @ x[q].T >= index.similarity)
                links[p] += linked @ n[q]
                links[q] += n[p] @ linked
                i, j = np.nonzero(linked)
                if len(i):
                    # Of every tile only a forest is kept.
                    own = np.unique(np.concatenate([p[i], q[j]]))
                    u, v = _forest(np.searchsorted(own, p[i]), np.searchsorted(own, q[j]), len(own))
                    first.append(own[u])
                    second.append(own[v])
        some = np.flatnonzero(links)
        u = np.concatenate(first) if first else np.zeros(0, np.int64)
        v = np.concatenate(second) if second else np.zeros(0, np.int64)
        if len(u):
            own = np.unique(np.concatenate([u, v]))
            u, v = _forest(np.searchsorted(own, u), np.searchsorted(own, v), len(own))
            u, v = own[u], own[v]
        return pa.table(
            {
                "a": pa.array(np.concatenate([cls[some], cls[u]]), pa.int64()),
                "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cls[v], pa.int64())]),
                "n": pa.concat_arrays([pa.array(links[some], pa.int64()), pa.nulls(len(u), pa.int64())]),
            }
        )

    return verify


def links_by_index(classes: DataFrame, index: PivotIndex) -> DataFrame:
    """(a, b, n) of all groups: link counts where ``b`` is null, else edges of forests.

    ``classes`` holds cls, n, h1, h2 and ``v``, a valid vector for each class.  Vectors
    of fewer components count as filled up with zeros.
    """
    spark = classes.sparkSession
    count, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], "a long, b long, n long")
    pivots = choose_pivots(classes, count, width, index)
    kind = "<f4" if dict(classes.dtypes)["v"] == "array<float>" else "<f8"
    described = staged(
        classes.select("cls", "n", "v").mapInArrow(_nearest(pivots, width, index), "cls long, n long, v binary, near binary"), "described"
    )
    ranks = np.empty(len(pivots), np.int64)
    ranks[np.argsort(_lengths(described, len(pivots)), kind="stable")] = np.arange(len(pivots))
    near = min(index.prefix, len(pivots))
    sent = near - min(index.shared, near) + 1
    blocks = np.maximum(1, -(-_lengths(described, len(pivots), ranks, sent) // index.block))
    entries = described.mapInArrow(_enter(ranks, blocks, sent), _ENTRY)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size_in_bytes(described) * sent // (64 * 1024 * 1024))
    cell = ("pivot", "lo", "hi")
    return entries.repartition(parts, *cell).groupBy(*cell).applyInArrow(_verify(index, kind), "a long, b long, n long")


def near_vectors(vectors: DataFrame, index: PivotIndex | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Rows are linked if the cosine of their vectors, in double precision, reaches the
    similarity.  ``n_links`` counts the other rows that a row is linked with directly,
    ``component_id`` is the smallest ``vec_id`` that links reach, and ``kept`` marks the
    rows with that id.  Equal vectors are one class, which enters the index once, so
    copies cost one aggregate however many there are.

    Vectors that are null or empty, have only zeros, or hold a null or a number that is
    not finite link with nothing.  Of vectors with different numbers of components the
    shorter one counts as filled up with zeros.  Every row counts, also one that repeats
    another's ``vec_id``; a component whose rows all lack an id has none itself and
    keeps them all.  Other columns are ignored.
    """
    index = index or PivotIndex()
    small_batches(vectors.sparkSession)
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    # Adding zero makes negative zeros positive.
    clean = F.when(valid(F.col("embedding")), F.transform("embedding", lambda x: (x + F.lit(0).cast(kind)).cast(kind)))
    rows = staged(
        vectors.select("vec_id", clean.alias("v"))
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}),
        "vectors",
    )
    some = rows.where("v is not null")
    # Written before it is joined: adaptive execution can split a hot class only where
    # both sides come straight from a shuffle.
    reps = staged(some.groupBy("h1", "h2").agg(F.min("_row").alias("cls"), F.count("*").alias("n"), F.min("vec_id").alias("least")), "classes")
    mine = staged(some.join(reps, ["h1", "h2"]).select("_row", "vec_id", "cls", "n"), "members")
    classes = some.join(reps.select("n", "least", F.col("cls").alias("_row")), "_row").select(F.col("_row").alias("cls"), "n", "h1", "h2", "v")
    found = staged(links_by_index(staged(classes, "class-vectors"), index), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    joined = components(found.where("b is not null").select("a", "b")).select(F.col("doc_id").alias("cls"), F.col("component_id").alias("comp"))
    facts = (
        reps.join(links, "cls", "left").join(joined, "cls", "left")
        .select("cls", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("comp", "cls").alias("comp"))
    )
    facts = staged(facts, "facts")
    least = staged(facts.groupBy("comp").agg(F.min("least").alias("component_id")), "components")
    facts = staged(facts.join(least, "comp").select("cls", "links", "component_id"), "facts")
    done = mine.join(facts, "cls").select("vec_id", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
