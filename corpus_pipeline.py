"""A training corpus from raw documents: quality, near-duplicates, privacy, mix, packing.

Each stage is written as a table in the shared folder and read back as the next one's
documents; the columns of ``documents`` go through to the last stage, and others are
dropped by the first.  No stage needs ids: rows without one, or that repeat one, are rows
like all others.  A null or empty text fails the quality rules; the later stages leave it
as it is.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import mixing, packing, pii, quality_gbt, tensor_minhash
from stratiform.llm.common import documents, staged
from stratiform.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees, which learn from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = quality_gbt.fit(docs, labels)
    rest = tuple(c for c in docs.columns if c != "text")
    judged = quality_gbt.score_quality(docs, forest, carry=(*rest, "text"))
    return judged.where("kept").select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` with ``_row``, a key of every row.

    Ids that differ, none of them null, are the keys.  Otherwise the rows are written once
    with a number each.
    """
    rows = docs.select(*COLUMNS)
    if rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return rows.withColumn("_row", F.col("doc_id"))
    return staged(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id (null last), of every group of near-duplicates.

    Rows are told apart by a key of their own, whether ids repeat or are missing.
    """
    rows = keyed(docs)
    groups = tensor_minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    kept = rows.select("_row", "doc_id").join(groups, "_row").groupBy("component_id").agg(F.min(order)["_row"].alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced; ``n_chars`` follows the text."""
    done = pii.replace_pii(docs, key=pii.key_of(spark))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes each of them, whether ids repeat or are missing."""
    rows = keyed(docs)
    return mixing.materialise(rows, mixing.mix_sources(rows, carry=("_row",)), "_row").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 ids."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("personal data", privacy),
    ("mixing", mix),
    ("packing", pack),
]

# Trees, minhashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, from the table ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
