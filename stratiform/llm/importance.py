"""Importance resampling towards a target distribution, over hashed runs of words.

Every run of one to ``words`` words is a feature; its bucket is the CRC-32 of its bytes
modulo ``buckets``.  A document's weight sums the log ratios of target and corpus over
its features, and Gumbel noise that depends on the document alone turns the greatest
scores into a weighted sample without replacement.

Texts follow a head-tail law: a short list of words makes up most features.  The CRC
states of these, and the buckets of frequent pairs, are computed once and broadcast;
the CRC of a longer run goes on from the state of its first word.  Features outside the
head take their CRC directly, so the head decides how fast totals come, never what they
are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import numbered, slices, small_batches, staged
from stratiform.llm.terms import each_text, terms


@dataclass(frozen=True)
class Features:
    words: int = 1  # in the longest run
    buckets: int = 10_000
    head: int = 20_000  # frequent words, and as many frequent pairs, at most
    head_bytes: int = 64  # longer features stay in the tail


class _States(dict):
    """CRC states of words; one that is missing is computed and not kept."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class Head:
    """CRC states of frequent words and of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[bytes]):
        self.states = _States((w, crc32(w)) for w in words)
        self.pairs = {tuple(p.split(b" ")): crc32(p) for p in pairs}

    def hashes(self, own: list[bytes], longest: int) -> np.ndarray:
        """CRC-32 of all runs of one to ``longest`` of the words."""
        runs = list(map(self.states.__getitem__, own))
        out = list(runs)
        for k in range(1, longest):
            if k == 1:
                seen = self.pairs
                runs = [seen[p] if (p := (a, b)) in seen else crc32(b" " + b, s) for a, b, s in zip(own, own[1:], runs)]
            else:
                runs = [crc32(b" " + w, s) for w, s in zip(own[k:], runs)]
            out += runs
        return np.array(out, np.uint32)


class _Frequent:
    """Counts of frequent features in bounded room (a mergeable summary).

    A count that is kept falls short of the real one by at most the total over the
    room, so what holds a share above that is never lost.
    """

    def __init__(self, room: int):
        self.room, self.counts, self.total = room, Counter(), 0

    def add(self, features: list[bytes]) -> None:
        self.total += len(features)
        self.counts.update(features)
        if len(self.counts) > 4 * self.room:
            kept = self.counts.most_common(self.room + 1)
            least = kept[-1][1]
            self.counts = Counter({f: n - least for f, n in kept if n > least})

    def rows(self, share: int) -> list[tuple[bytes, int]]:
        return [(f, n) for f, n in self.counts.items() if n * share >= self.total]


def head_vocabulary(texts: DataFrame, features: Features) -> Head:
    """Words and pairs that make up at least one in ``features.head`` of all.

    A task passes on what reaches that share among its own, as every frequent feature
    does in some task; counts are summed and compared with the total.  By that rule
    there are at most ``head`` of either kind.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [_Frequent(features.head) for _ in range(min(features.words, 2))]
        for batch in batches:
            for text in each_text(batch.column("text")):
                own = terms(text)
                kinds[0].add([w for w in own if len(w) <= features.head_bytes])
                if len(kinds) > 1:
                    kinds[1].add([p for a, b in zip(own, own[1:]) if len(p := a + b" " + b) <= features.head_bytes])
        for kind, summary in enumerate(kinds):
            rows = [(None, summary.total), *summary.rows(features.head)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())],
                ["kind", "feature", "n"],
            )

    counts = staged(
        texts.select("text").mapInArrow(frequent, "kind int, feature binary, n long").groupBy("kind", "feature").agg(F.sum("n").alias("n")), "head"
    )
    total = {r["kind"]: r["n"] for r in counts.where("feature is null").collect()}
    reached = F.lit(False)
    for kind, n in total.items():
        reached = reached | ((F.col("kind") == kind) & (F.col("n") * features.head >= n))
    found: dict[int, list[bytes]] = {0: [], 1: []}
    for r in counts.where("feature is not null").where(reached).select("kind", "feature").collect():
        found[r["kind"]].append(bytes(r["feature"]))
    return Head(found[0], found[1])


def hashed(texts: DataFrame, features: Features, head: Head, carry: tuple[str, ...] = ()) -> DataFrame:
    """``carry``, n_features, n_words and the buckets of all features, packed."""
    shared = texts.sparkSession.sparkContext.broadcast(head)
    kind = np.dtype("<u2") if features.buckets <= 1 << 16 else np.dtype("<u4")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_head = shared.value
        for whole in batches:
            for batch in slices(whole):
                words, sizes, blobs = [], [], []
                for text in each_text(batch.column("text")):
                    own = terms(text)
                    h = own_head.hashes(own, features.words) % np.uint32(features.buckets)
                    words.append(len(own))
                    sizes.append(len(h))
                    blobs.append(h.astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in carry), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                    [*carry, "n_words", "n_features", "buckets"],
                )

    kinds = dict(texts.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in carry), "n_words long, n_features long, buckets binary"])
    return texts.select(*carry, "text").mapInArrow(pack, schema)


def bucket_totals(packed: DataFrame, features: Features) -> DataFrame:
    """(bucket, n): how many features fall into each bucket that has any.

    A task adds up all its rows and passes on one number for each bucket.
    """
    kind = np.dtype("<u2") if features.buckets <= 1 << 16 else np.dtype("<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for blob in batch.column("buckets"):
                total += np.bincount(np.frombuffer(blob.as_buffer(), kind), minlength=features.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    return packed.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, features: Features) -> DataFrame:
    """(bucket, gain): thousand times the log of target share over corpus share, floored.

    Both shares have one added to every bucket.  One row for each bucket.
    """
    every = corpus.sparkSession.range(features.buckets).withColumnRenamed("id", "bucket")
    both = (
        every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t")))
    )
    sums = both.agg(F.sum("s"), F.sum("t")).first()
    size = float(features.buckets)
    ratio = (F.col("t") + 1.0) * (float(sums[0]) + size) / ((F.col("s") + 1.0) * (float(sums[1]) + size))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """Thousand times a Gumbel number that seed and ``doc_id`` decide, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    features: Features | None = None,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs(doc_id, text)``.

    ``target`` has a column ``text``.  Rows of at least ``least_words`` words compete; the
    floor of ``percent`` of them with the greatest scores are drawn, ranked 1, 2, 3 ..,
    ties by the smaller ``doc_id`` (null last) and equal rows in any order; the others
    have no rank.  A null or empty text has no features and weight 0.  Every row counts
    in the totals, repeated ones too.  A row without ``doc_id`` draws its noise from the
    seed alone.  Other columns of either table are ignored; an empty target or corpus
    has total 0.

    Documents are tokenised twice, once for the head; their buckets are written.  Drawn
    rows are numbered by ranges of the score, not in one place.
    """
    f = features or Features()
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    head = head_vocabulary(texts, f)
    packed = staged(hashed(texts, f, head, ("doc_id",)).withColumn("_row", F.monotonically_increasing_id()), "buckets")
    wanted = hashed(target.select("text"), f, head)
    rows = gains(bucket_totals(packed, f), bucket_totals(wanted, f), f).collect()
    gain = np.zeros(f.buckets, np.int64)
    gain[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = np.dtype("<u2") if f.buckets <= 1 << 16 else np.dtype("<u4")
    carry = ("doc_id", "_row", "n_words", "n_features")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            weights = [int(own[np.frombuffer(b.as_buffer(), kind)].sum()) for b in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(weights, pa.int64())], [*carry, "weight"])

    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, _row long, n_words long, n_features long, weight long"
    scored = staged(packed.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    enough = F.col("n_words") >= least_words
    competing = scored.where(enough)
    drawn = competing.count() * percent // 100
    ranked = numbered(competing, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")], "rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionAll(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
