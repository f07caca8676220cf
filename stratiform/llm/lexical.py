"""Ranked lexical search: exact inner products found with sparse ball trees.

A document is a sparse vector with one integer for each of its terms, an item the vector
of its terms' weights; the score is their inner product.  Documents are gathered in
balls around centroids, in trees of bounded size.  For a query q, no document of a ball
with centroid c and radius r scores above ``q.c + |q| r``; subtrees are visited in order
of that bound until it falls below the k-th best score found so far.  Bounds are doubles,
rounded up by more than their error; scores at the leaves are exact integers, so pruning
never changes the result.

Only terms of the items can add to a score, so documents are kept on these alone.  Items
are broadcast in blocks of bounded size; every document is searched for every block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import slices, small_batches, staged
from stratiform.llm.terms import each_text, terms
from stratiform.llm.textbits import ragged

# Bytes of the items' texts that are searched for at once.
ITEM_BYTES = 16 * 1024 * 1024

# A tree holds at most this many documents, or about this many of their terms.
TREE_DOCS, TREE_TERMS = 4096, 400_000
LEAF_DOCS = 32

# Cells of the matrix of items by terms that a task holds.
QUERY_CELLS = 1 << 21

# More than the relative error of a sum of any realistic number of doubles.
SLACK = 1e-9


@dataclass(frozen=True)
class Ranking:
    k: int = 10  # best documents of each item
    length_percent: int = 90  # how much a document's length counts
    saturation: int = 8  # how soon repeats of a term stop counting


class Ball:
    """A node: centroid, radius, and two halves or a leaf's documents."""

    __slots__ = ("terms", "values", "radius", "halves", "first", "last", "bounds")

    def __init__(self, own_terms: np.ndarray, values: np.ndarray, radius: float, first: int, last: int):
        self.terms, self.values, self.radius, self.first, self.last = own_terms, values, radius, first, last
        self.halves: tuple[Ball, Ball] | None = None
        self.bounds: np.ndarray | None = None


class BallTree:
    """Documents as sparse vectors: ``ptr`` bounds each one's terms and whole values.

    Every document has a term at least.
    """

    def __init__(self, ptr: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
        self.ptr, self.term, self.value, self.dense = ptr, term, value, np.zeros(width)
        self.size = np.diff(ptr)
        self.order = np.arange(len(self.size))
        self.square = np.add.reduceat(value.astype(np.float64) ** 2, ptr[:-1])
        self.root = self._build(0, len(self.order))

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all entries of ``docs``, and where each one's begin."""
        n = self.size[docs]
        return ragged(self.ptr[docs], n), np.cumsum(n) - n

    def _dots(self, at: np.ndarray, begins: np.ndarray, own_terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        self.dense[own_terms] = values
        out = np.add.reduceat(self.value[at] * self.dense[self.term[at]], begins)
        self.dense[own_terms] = 0
        return out

    def _of(self, doc: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.ptr[doc], self.ptr[doc + 1])
        return self.term[s], self.value[s].astype(np.float64)

    def _build(self, first: int, last: int) -> Ball:
        docs = self.order[first:last]
        at, begins = self.entries(docs)
        own_terms, place = np.unique(self.term[at], return_inverse=True)
        centre = np.bincount(place, weights=self.value[at].astype(np.float64)) / len(docs)
        size = float(centre @ centre)
        square = self.square[docs]
        away = np.maximum(0, square - 2 * self._dots(at, begins, own_terms, centre) + size)
        # The difference of large squares is off by at most their rounding.
        radius = float(np.sqrt((away + SLACK * (square + size)).max())) * (1 + SLACK)
        ball = Ball(own_terms, centre, radius, first, last)
        if len(docs) > LEAF_DOCS:
            # Halves along the line between two documents far from each other.
            one = self._of(int(docs[np.argmax(away)]))
            to_one = self._dots(at, begins, *one)
            two = self._of(int(docs[np.argmax(square - 2 * to_one)]))
            along = to_one - self._dots(at, begins, *two)
            self.order[first:last] = docs[np.argsort(along, kind="stable")]
            middle = (first + last) // 2
            ball.halves = (self._build(first, middle), self._build(middle, last))
        return ball


def search_tree(tree: BallTree, doc_ids: list, weights: np.ndarray, norms: np.ndarray, tops: list[list], k: int) -> None:
    """Bring the ``k`` best of each row of ``weights`` in ``tops`` up to date.

    A top is a heap of (score, id order, doc_id) with the worst one first.
    """
    as_double = weights.astype(np.float64)

    def bounds(ball: Ball) -> np.ndarray:
        if ball.bounds is None:
            ball.bounds = (as_double[:, ball.terms] @ ball.values + norms * ball.radius) * (1 + SLACK) + SLACK
        return ball.bounds

    for i, top in enumerate(tops):
        todo = [(-bounds(tree.root)[i], 0, tree.root)]
        seen = 0
        while todo:
            bound, _, ball = heapq.heappop(todo)
            # A document without any of the terms does not count as found.
            if -bound < (top[0][0] if len(top) == k else 1):
                break
            if ball.halves:
                for half in ball.halves:
                    seen += 1
                    heapq.heappush(todo, (-bounds(half)[i], seen, half))
                continue
            docs = tree.order[ball.first : ball.last]
            at, begins = tree.entries(docs)
            scores = np.add.reduceat(weights[i][tree.term[at]] * tree.value[at], begins)
            least = top[0][0] if len(top) == k else 1
            for j in np.flatnonzero(scores >= least).tolist():
                doc_id = doc_ids[docs[j]]
                entry = (int(scores[j]), -doc_id if doc_id is not None else -(2**63), doc_id)
                if len(top) < k:
                    heapq.heappush(top, entry)
                elif entry[:2] > top[0][:2]:
                    heapq.heapreplace(top, entry)
    clear(tree.root)


def clear(ball: Ball) -> None:
    """Forget the bounds of one set of items."""
    ball.bounds = None
    for half in ball.halves or ():
        clear(half)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term.

    ``n`` counts all its terms with repeats; terms of the vocabulary go by number, packed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for whole in batches:
            for batch in slices(whole):
                rows, sizes, own, times = [], [], [], []
                for row, text in enumerate(each_text(batch.column("text"))):
                    found = terms(text)
                    if found:
                        at = np.array([x for x in map(number, found) if x is not None], np.int32)
                        at, n = np.unique(at, return_counts=True)
                        rows.append(row)
                        sizes.append(len(found))
                        own.append(at.astype("<i4").tobytes())
                        times.append(n.astype("<i8").tobytes())
                ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(own, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, n long, terms binary, counts binary")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column("terms"):
                total[np.frombuffer(blob.as_buffer(), "<i4")] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for r in counted.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def length_factor(n: np.ndarray, documents: int, words: int, ranking: Ranking) -> np.ndarray:
    """A document's length over the mean, weighed, in hundredths; whole numbers throughout."""
    p = ranking.length_percent
    if len(n) and p * int(n.max()) * documents >= 2**63:  # beyond 64 bits
        return np.array([100 - p + p * int(x) * documents // words for x in n], np.int64)
    return 100 - p + p * n.astype(np.int64) * documents // max(words, 1)


def _find(weights: np.ndarray, owners: list[tuple], documents: int, words: int, ranking: Ranking):
    """The best documents of each item among a task's; ``owners`` are the items' columns."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list] = [[] for _ in owners]
        norms = np.sqrt((weights.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        step = max(1, QUERY_CELLS // max(1, weights.shape[1]))
        ids: list = []
        ns: list[int] = []
        own: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = 0

        def search() -> None:
            sizes = np.array([len(x) for x in own], np.int64)
            term, tf = np.concatenate(own), np.concatenate(times)
            m = np.repeat(length_factor(np.array(ns, np.int64), documents, words, ranking), sizes)
            value = (1_000_000_000 * tf) // (1000 * tf + ranking.saturation * m)
            tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), term, value, weights.shape[1])
            for a in range(0, len(owners), step):
                search_tree(tree, ids, weights[a : a + step], norms[a : a + step], tops[a : a + step], ranking.k)

        for batch in batches:
            for doc_id, n, blob, counts in zip(*(batch.column(c) for c in ("doc_id", "n", "terms", "counts"))):
                at = np.frombuffer(blob.as_buffer(), "<i4")
                if not len(at):
                    continue
                ids.append(doc_id.as_py())
                ns.append(n.as_py())
                own.append(at)
                times.append(np.frombuffer(counts.as_buffer(), "<i8"))
                held += len(at)
                if len(ids) >= TREE_DOCS or held >= TREE_TERMS:
                    search()
                    ids, ns, own, times, held = [], [], [], [], 0
        if ids:
            search()
        found = [(*owner, doc_id, score) for owner, top in zip(owners, tops) for score, _, doc_id in top]
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])

    return find


_FOUND = "item long, item_id long, doc_id long, score long"


def _search_block(docs: DataFrame, rows: list, ranking: Ranking) -> DataFrame:
    """The tasks' best documents for the items of one block, which is at hand."""
    per_item = [sorted(set(terms((r["text"] or "").encode()))) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*per_item)))}
    counted = staged(term_counts(docs, vocabulary), "term-counts")
    documents, words = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(counted, len(vocabulary))
    rarity = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    weights = np.zeros((len(rows), len(vocabulary)), np.int64)
    for i, own in enumerate(per_item):
        at = [vocabulary[t] for t in own]
        weights[i, at] = rarity[at]
    owners = [(r["item"], r["item_id"]) for r in rows]
    return counted.mapInArrow(_find(weights, owners, documents, words, ranking), _FOUND)


def search(docs: DataFrame, items: DataFrame, ranking: Ranking | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents for every row of ``items``.

    ``docs`` holds doc_id and text, ``items`` item_id and text; ids are whole numbers.
    Only scores above 0 count; ties go to the smaller ``doc_id``, null last.  A null,
    empty or termless text is found by nothing and finds nothing.  Rows that repeat a
    text or an id are documents of their own and items of their own.  Other columns are
    ignored.  An empty table on either side gives no rows.

    A task returns at most ``k`` rows for each item, however many documents it has;
    these are cut to the best by item and a share of the documents first, then by item.
    """
    r = ranking or Ranking()
    spark = docs.sparkSession
    small_batches(spark)
    numbered = staged(items.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("item", F.monotonically_increasing_id()), "items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(-(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for b in range(blocks):
        rows = numbered.where(block == b).collect()  # about ITEM_BYTES of them
        if any(terms((x["text"] or "").encode()) for x in rows):
            parts.append(_search_block(texts, rows, r))
    found = spark.createDataFrame([], T.StructType.fromDDL(_FOUND)) if not parts else parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    found = found.withColumn("_share", share).withColumn("_at", F.row_number().over(Window.partitionBy("item", "_share").orderBy(*best)))
    ranked = found.where(F.col("_at") <= r.k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best)))
    return ranked.where(F.col("rank") <= r.k).select("item_id", "rank", "doc_id", "score")
