"""Mixing sources to target weights.

Targets are counted in words.  A source's target gives it whole epochs first; what
remains is filled by a weighted sample without replacement.  Every document draws an
exponential key, scaled by its quality; keys are sorted within the source and sizes
summed up to the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import WORD, staged

# No document is taken more often than this.
MOST_EPOCHS = 3

# Keys of a source are sorted in buckets of about this many documents.
BUCKET_ROWS = 10_000

# Word length of ordinary prose, in characters with the space after it.
PROSE_WORD = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, *columns: str) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def sized(docs: DataFrame, seed: str, quality: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, quality, draw) and ``carry``: one narrow row for each document."""
    # Rows without an id draw by their texts: one draw for all would take or leave them as a block.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    counted = docs.select(
        "doc_id", "source", *carry, word_count(F.col("text")).alias("size"), F.length("text").alias("_length"), name.alias("_name")
    )
    weight = quality if quality is not None else F.when(
        F.col("size") > 0, 1 / (1 + F.abs(F.col("_length") / F.col("size") - PROSE_WORD) / PROSE_WORD)
    ).otherwise(F.lit(1.0))
    return counted.withColumn("quality", weight).withColumn(
        "draw", -F.log(uniform(seed, "_name")) / F.col("quality")
    ).drop("_length", "_name")


def targets(sizes: DataFrame, weights: Sequence[float], most: int = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size, ..)``, one row for each source.

    Sources in order of their names (null last) weigh ``weights``, repeating.  A target
    is the weight's share, but ``most`` times the source's size at most; the rest is
    shared by weight among the others.  With sources in order of size over weight, the
    share per weight that is right is the largest one that any of them would give if
    all before it were at their limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("_nth", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("_nth") % len(weights) + 1)
    every = Window.partitionBy()
    filled = (
        named.withColumn("_w", weight)
        .withColumn("_limit", F.col("source_size").cast("double") * most)
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
    )
    order = Window.orderBy(F.col("_limit") / F.col("_w"), "_nth")
    before = F.coalesce(F.sum("_limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = filled.withColumn("_level", (F.col("_total") - before) / rest)
    share = F.max("_level").over(every) * F.col("_w")
    return level.withColumn("target", F.least(F.col("_limit"), share)).drop("_w", "_limit", "_total", "_level")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    quality: Column | None = None,
    seed: str = "mix",
    most: int = MOST_EPOCHS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts words, repeats included: whole epochs, and one more time for the
    documents with the smallest keys until the source's target is reached to the word.
    The document at the border is taken in part.  ``quality`` is a positive column over
    (doc_id, size); by default the likeness of word lengths to prose.

    Sums of buckets of keys tell which buckets are inside the budget; rows are sorted
    only in the one bucket of each source that the budget ends in, so a source may hold
    any share of the table.  A null text has size 0 and is taken 0 words; a null source
    is a source of its own.  Equal rows draw the same key and follow each other; which
    of them is cut is left open.  Columns other than ``doc_id``, ``source`` and ``text``
    are ignored, but those in ``carry`` (such as a row key) are handed on.  The draw
    depends on ``seed`` and ``doc_id``, or the text where that is null, so reruns agree.
    """
    rows = staged(sized(docs, seed, quality, carry), "sized")
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows"), F.avg("quality").alias("_quality")
    )
    words = F.least(F.round("target"), (F.col("source_size") * most).cast("double")).cast("long")
    epochs = F.coalesce(F.floor(F.col("_words") / F.nullif("source_size", F.lit(0))), F.lit(0))
    plan = staged(
        targets(sizes, weights, most)
        .withColumn("_words", words)
        .withColumn("_epochs", epochs)
        .withColumn("_budget", F.col("_words") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_buckets", 1 + F.floor(F.col("_rows") / BUCKET_ROWS)),
        "plan",
    )
    spread = F.floor((1 - F.exp(-F.col("draw") * F.col("_quality"))) * F.col("_buckets"))
    known = (
        rows.alias("r")
        .join(plan.alias("p"), F.expr("r.source <=> p.source"))
        .select("r.*", *(F.col(f"p.{c}") for c in plan.columns if c != "source"))
        .withColumn("_bucket", F.least(F.col("_buckets") - 1, spread))
    )
    sums = known.groupBy("_nth", "_bucket").agg(F.sum("size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_nth").orderBy("_bucket")) - F.col("_sum")
    placed = known.join(sums.withColumn("_before", before), ["_nth", "_bucket"])
    left = F.col("_budget") - F.col("_before")
    border = (left > 0) & (left < F.col("_sum"))
    order = Window.partitionBy("_nth", "_bucket").orderBy("draw", "doc_id", "size")
    inner = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    cut = F.greatest(F.lit(0), F.least("size", left - F.col("_inner")))
    whole = F.when(left >= F.col("_sum"), F.col("size")).otherwise(F.lit(0))
    columns = ["doc_id", "source", "size", "source_size", "target", *carry]
    once = F.col("_epochs") * F.col("size")
    return (
        placed.where(border)
        .withColumn("_inner", inner)
        .select(*columns, (once + cut).cast("long").alias("taken"))
        .unionAll(placed.where(~border).select(*columns, (once + whole).cast("long").alias("taken")))
    )


def materialise(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix as rows of ``docs``, each as often as it is taken; part of one counts from half on.

    Rows are matched by ``key``, a column of both with another value in every row.
    Where a ``doc_id`` is missing or repeats, that is a row key which ``mix_sources``
    carries; rows that share a key and a source and have as many words are taken alike
    otherwise, as often as the one of them that is taken most.
    """
    n = F.floor(F.coalesce(F.col("taken") / F.nullif("size", F.lit(0)), F.lit(0.0)) + 0.5).cast("int")
    same = ("_key", "_source", "_size")
    times = mixed.select(F.col(key).alias("_key"), F.col("source").alias("_source"), F.col("size").alias("_size"), n.alias("_n"))
    times = times.groupBy(*same).agg(F.max("_n").alias("_n")).where("_n > 0")
    sized_docs = docs.withColumn("_words", word_count(F.col("text")))
    match = F.expr(f"d.`{key}` <=> t._key and d.source <=> t._source and d._words = t._size")
    joined = sized_docs.alias("d").join(times.alias("t"), match)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select(*(F.col(f"d.`{c}`") for c in docs.columns))
