"""Quality rules: gradient-boosted trees over document statistics.

Fixed rules reject what is too short or too repetitive.  What passes them is judged
by boosted trees that are trained on labelled documents.  The trees are flattened
into arrays of nodes, and a batch of documents is scored level by level with numpy.
Chosen statistics may only lower the score as they grow (or only raise it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import slices, small_batches
from stratiform.llm.textbits import Prefix, Words, flat, repeated

# At most this many labelled documents train the trees: those with the smallest hashes.
TRAINING_ROWS = 20_000

# Documents are kept while the trees give good quality at least this probability.
KEEP_FROM = 0.3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Statistics the trees see, and how the score may move as each grows.
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "mark_share": -1,
    "distinct_share": 0,
    "short_line_share": 0,
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?=_~^{}[]\\"]] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts of every text, and its row of ``FEATURES``; null counts as empty."""
    data, offsets = flat(texts)
    prefix = Prefix(data)
    words = Words(data, offsets, prefix)
    n, docs = words.count, len(offsets) - 1
    code_point = (data & 0xC0) != 0x80
    upper = _UPPER[data]
    # Capitals of the Latin-1 letters: C3 80 to C3 9E.
    if len(data) > 1:
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    symbols = _per_text(_SYMBOL[data], offsets)
    chars = _per_text(code_point & ~np.isin(data, [9, 10, 11, 12, 13, 32]), offsets)

    # Lines that hold a word; a line ends at \n or with its text.
    cuts = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1], cuts + 1)
    line_end = np.append(line_start[1:], len(data))
    line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end, 1) - 1] == 10)) if len(data) else line_end
    holds = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end = line_start[holds], line_end[holds]
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    _, later = repeated(line_doc, prefix.of(line_start, line_end))
    lines = np.bincount(line_doc, minlength=docs)
    dup_lines = np.bincount(line_doc[later], minlength=docs)
    short = np.bincount(line_doc[line_end - line_start < 30], minlength=docs)

    at, h = words.windows(3)
    again, _ = repeated(words.doc[at], h)
    covered = np.zeros(len(words.hash) + 3, bool)
    for k in range(3):
        covered[at[again] + k] = True
    repeats = np.bincount(words.doc[covered[: len(words.hash)]], minlength=docs)
    _, seen = repeated(words.doc, words.hash)
    distinct = n - np.bincount(words.doc[seen], minlength=docs)

    size = np.maximum(chars, 1)
    base = dict(zip(BASE, (n, chars, symbols, dup_lines, repeats)))
    features = np.stack(
        [
            np.log1p(n),
            chars / np.maximum(n, 1),
            symbols / size,
            dup_lines / np.maximum(lines, 1),
            repeats / np.maximum(n, 1),
            _per_text(upper, offsets) / size,
            _per_text(_DIGIT[data], offsets) / size,
            _per_text(_MARK[data], offsets) / size,
            distinct / np.maximum(n, 1),
            short / np.maximum(lines, 1),
        ],
        axis=1,
    )
    return base, features


@dataclass
class Forest:
    """Trees as one array per node property; children follow the roots of their tree."""

    feature: np.ndarray  # -1 at a leaf
    threshold: np.ndarray  # right when the value is greater
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for every row of ``x``."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(f < 0, node, np.where(right, self.right[node], self.left[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def train(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 5.0,
    ridge: float = 1.0,
) -> Forest:
    """Second-order boosting on histograms of ``bins`` quantiles per feature.

    A split on a constrained feature is taken only where its two values go the right
    way, and what lies below must stay on its side of their middle.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    rate_good = np.clip(y.mean(), 0.01, 0.99)
    bias = float(np.log(rate_good / (1 - rate_good)))
    margin = np.full(len(y), bias)
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots = []

    def add() -> int:
        for k, v in zip(out, (-1, 0.0, 0, 0, 0.0)):
            out[k].append(v)
        return len(out["value"]) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(add())
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop()
            sum_g, sum_h = g[rows].sum(), h[rows].sum()
            value = float(np.clip(sum_g / (sum_h + ridge), low, high))
            best = (1e-6, -1, 0, 0.0, 0.0)
            for f in range(x.shape[1] if level < depth else 0):
                k = len(edges[f]) + 1
                if k < 2:
                    continue
                b = binned[rows, f]
                left_g = np.cumsum(np.bincount(b, g[rows], k))[:-1]
                left_h = np.cumsum(np.bincount(b, h[rows], k))[:-1]
                right_g, right_h = sum_g - left_g, sum_h - left_h
                lv = np.clip(left_g / (left_h + ridge), low, high)
                rv = np.clip(right_g / (right_h + ridge), low, high)
                gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - sum_g**2 / (sum_h + ridge)
                allowed = (left_h >= least * 0.1) & (right_h >= least * 0.1) & ((rv - lv) * monotone[f] >= 0)
                gain = np.where(allowed, gain, -1)
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    best = (float(gain[j]), f, j, float(lv[j]), float(rv[j]))
            _, f, j, lv, rv = best
            if f < 0:
                out["value"][node] = rate * value
                margin[rows] += rate * value
                continue
            a, b = add(), add()
            out["feature"][node], out["threshold"][node] = f, float(edges[f][j])
            out["left"][node], out["right"][node] = a, b
            middle = (lv + rv) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            to_left = binned[rows, f] <= j
            for child, own, (lo, hi) in zip((a, b), (rows[to_left], rows[~to_left]), bounds[int(monotone[f])]):
                todo.append((child, own, level + 1, lo, hi))
    arrays = {k: np.array(v) for k, v in out.items()}
    return Forest(**arrays, roots=np.array(roots), depth=depth, bias=bias)


def training_table(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled documents, chosen by hash.

    Only the sample's keys and numbers reach the driver, never more than ``rows`` of them:
    where documents repeat an id, rows are chosen once more, by a hash of their numbers.
    The chosen labels are joined by broadcast, being at most ``rows`` pairs of numbers.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    small_batches(docs.sparkSession)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "good")
    fields = ", ".join(f"{f} double" for f in FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                _, x = statistics(b.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in x.T), b.column("good").cast(pa.float64())], [*FEATURES, "good"]
                )

    measured = joined.mapInArrow(measure, f"{fields}, good double")
    table = measured.orderBy(F.xxhash64(*FEATURES, "good"), *FEATURES, "good").limit(rows).toPandas()
    # Rows arrive in any order; sums of floats would differ between runs.
    table = table.sort_values(list(table.columns)).to_numpy()
    return table[:, :-1], table[:, -1]


def fit(docs: DataFrame, labels: DataFrame, **options) -> Forest | None:
    """Trees for the labelled documents; None without two kinds of labels."""
    x, y = training_table(docs, labels)
    if not len(y) or y.min() == y.max():
        return None
    return train(x, y, np.array(list(FEATURES.values())), **options)


def score_quality(docs: DataFrame, forest: Forest | None, keep_from: float = KEEP_FROM, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts, ``base_failed``, ``score`` and ``kept`` for every document.

    A null text is an empty one and fails the base rules, as does any of fewer than
    fifty words or with more than half of its words in repeated three-word windows.
    Rows are judged one by one, so ties and repeated rows change nothing.  Columns of
    ``docs`` other than ``carry`` and ``text`` are not read.  Without a forest (no
    labels) the base rules decide alone, and ``score`` is null.
    """
    small_batches(docs.sparkSession)
    kept_fields = [docs.schema[c] for c in carry]
    schema = T.StructType(
        [*kept_fields, *(T.StructField(c, T.LongType()) for c in BASE)]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "_text"):
                base, x = statistics(b.column("_text"))
                n = base["n_words"]
                failed = (n < 50) | (100 * base["n_repeat_words"] > 50 * n)
                score = forest.score(x) if forest else np.full(len(n), np.nan)
                kept = ~failed & (score >= keep_from if forest else True)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in carry), *(pa.array(base[c].astype("int64")) for c in BASE)]
                    + [pa.array(failed), pa.array(score, from_pandas=True), pa.array(kept)],
                    schema.names,
                )

    chosen = docs.select(*carry, F.col("text").alias("_text"))
    return chosen.mapInArrow(judge, schema)
