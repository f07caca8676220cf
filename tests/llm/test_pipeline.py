"""The pipeline stage by stage: what each drops, changes and hands on."""

import corpus_pipeline
from stratiform.llm import mixing
from stratiform.llm.common import documents, staged


def test_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and now
        if name in ("quality rules", "near-duplicates"):
            assert len(now) < len(ids) and docs.count() == len(now)
        if name == "personal data":
            assert now == ids
        if name != "packing":
            assert docs.columns == columns
        ids = now


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
        assert docs.count() == 0


def test_near_duplicates_without_ids_of_their_own(spark, sf_dir):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    # Repeated rows, texts under one id, copies without ids, and a copy under the greater id.
    rows = [(1, a), (1, a), (1, b), (2, b + " end"), (None, c), (None, c), (None, c + " end"), (None, a), (9, d), (None, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in got) == [(0, "c"), (1, "a"), (1, "b"), (9, "d")]


def test_mix_takes_every_row_by_itself(spark, sf_dir):
    # Sources of 4000, 4000 and 1000 words; half the rows have no id, others share one.
    rows = [(None if i % 2 else i % 5, " ".join(["word"] * 8 + [f"n{i}", source]), source) for source, n in (("a", 400), ("b", 400), ("c", 100)) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mix(spark, docs, sf_dir).collect()
    words = {s: sum(len(r.text.split()) for r in got if r.source == s) for s in "abc"}
    targets = {r.source: r.target for r in mixing.mix_sources(docs).select("source", "target").distinct().collect()}
    assert all(abs(words[s] - targets[s]) <= 10 for s in "abc")
    assert {r.text for r in got} <= {t for _, t, _ in rows}
