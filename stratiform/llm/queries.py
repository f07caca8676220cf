"""The registered queries of the corpus operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import (
    fingerprints, importance, lexical, mixing, packing, perspectives, pii, pivots, quality_gbt, sharding, sql, suffix_dedup,
    tensor_minhash, token_files,
)
from stratiform.llm.common import documents
from stratiform.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

WORD = r"[^\x20\x09-\x0D]+"


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place, by bytes of its virtual slot."""
    placed = sharding.shard_by_bytes(documents(spark, sf_dir), 24, scratch_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as packed blocks and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix_sources(documents(spark, sf_dir)).drop("source")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal data replaced, and how much of each type."""
    done = pii.replace_pii(documents(spark, sf_dir).select("doc_id", "text"), key=pii.key_of(spark))
    return done.select("doc_id", "text", *(c.alias(n) for n, c in pii.counts(done).items()))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 100 bytes seen before."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation, from each participant's perspective."""
    return perspectives.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op8_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of boosted trees for every document."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_gbt.score_quality(docs, quality_gbt.fit(docs, labels))
    return judged.select("doc_id", *quality_gbt.BASE, "base_failed", "kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 ids."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op10_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over four-word shingles at 0.8."""
    return tensor_minhash.near_duplicates(documents(spark, sf_dir), tensor_minhash.Banding(shingle=4))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the tenth that is drawn."""
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors at a cosine of 0.95."""
    return pivots.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_virtual_slots,
        op2_token_files,
        op3_mixing,
        op4_pii_surrogates,
        op5_suffix_dedup,
        op6_perspectives,
        op7_fingerprints,
        op8_quality_gbt,
        op9_packing,
        op10_tensor_minhash,
        op11_ball_tree,
        op12_head_tail,
        op13_pivot_index,
    )
}
ORACLES: dict[str, str] = {
    "op3_mixing": sql.MIXING,
    "op6_perspectives": sql.PERSPECTIVES,
    "op11_ball_tree": sql.SEARCH,
    "op12_head_tail": sql.RESAMPLING,
    "op13_pivot_index": sql.VECTORS,
}
