"""Sources, sinks, merges, layout and streaming."""

import datetime as dt
import json
import random
import re
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.audit import with_audit, with_run_metadata
from stratiform.operators.access import mask_columns, row_filter
from stratiform.operators.dimension import dimension, surrogate_key
from stratiform.operators.enrich import checked_broadcast, enrich
from stratiform.operators.layout import cluster_depth, compact, file_stats, layout_stats, z_value, zorder
from stratiform.operators.merge import AmbiguousMatch, scd2, snapshot_diff, upsert
from stratiform.operators.reporting import bernoulli_sample
from stratiform.plans import source_queries
from stratiform.session import scratch_path, shuffle_partitions_for
from stratiform.sinks import (
    LoadConflict, accepted, append_or_create, compact_files, copy_into, create_or_merge, loaded, loaded_files, merge_files,
    optimize_table, quarantined, recover, replace_files, rewrite, schema_versions, write_checked, write_gold,
)
from stratiform.sinks.copy_into import conform
from stratiform.sinks.rewrite import first_fit_decreasing, touched_files
from stratiform.sources import file_inventory, read_source, read_tree, route_by_format
from stratiform.streaming import load_evolving_files, load_new_files


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_read_tree_fails_without_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("hello")
    with pytest.raises(FileNotFoundError):
        read_tree(spark, str(tmp_path))


def test_read_tree_finds_all_depths_and_endings(spark, tmp_path):
    one = spark.createDataFrame([(1, "a")], "i int, s string")
    one.write.parquet(str(tmp_path / "d1" / "d2"))
    part = next((tmp_path / "d1" / "d2").glob("*.parquet"))
    part.rename(part.with_suffix(".parq"))
    spark.createDataFrame([(2, "b")], "i int, s string").write.json(str(tmp_path / "j"))
    assert rows(read_tree(spark, str(tmp_path))) == [("1", "a"), ("2", "b")]
    assert read_tree(spark, str(tmp_path), ("parq",)).dtypes == [("i", "int"), ("s", "string")]


def test_read_source_schema_and_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i;s\n1;x\n")
    assert rows(read_source(spark, str(tmp_path), "csv", options={"sep": ";"})) == [(1, "x")]
    typed = read_source(spark, str(tmp_path), "csv", "i string, s string", {"sep": ";"})
    assert rows(typed) == [("1", "x")]


def test_route_and_inventory(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    spark.range(2).write.option("header", True).csv(str(tmp_path / "q" / "r"))
    (tmp_path / "README").write_text("x")
    routed = route_by_format(spark, str(tmp_path), "t")
    assert {k: v.count() for k, v in routed.items()} == {"t": 3, "t_csv": 2}
    found = {r.ext: r for r in file_inventory(spark, str(tmp_path)).collect()}
    assert set(found) == {".parquet", ".csv", "no_extension"}
    assert found["no_extension"].total_bytes == 1
    assert ".csv" not in {r.ext for r in file_inventory(spark, str(tmp_path), 2).collect()}


def test_upsert_nulls_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string")
    once = upsert(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]
    keyed = source.dropna()
    assert rows(upsert(upsert(target, keyed, ["k"]), keyed, ["k"])) == rows(upsert(target, keyed, ["k"]))


def test_upsert_computes_its_source_once(spark):
    target = spark.createDataFrame([(i, -1.0) for i in range(50)], "k long, v double")
    drawn = spark.range(40).select(F.col("id").alias("k"), F.uuid().alias("extra"), F.rand().alias("v"))
    got = upsert(target, drawn, ["k"])
    assert rows(got) == rows(got) and got.where("v >= 0").count() == 40 and got.columns == ["k", "v"]
    assert got.inputFiles() == [] and "Rand" not in got._jdf.queryExecution().toString()


def test_upsert_rejects_ambiguous_matches_only(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(AmbiguousMatch):
        upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])
    fresh = spark.createDataFrame([(7, "x"), (7, "y")], "k int, v string")
    assert upsert(target, fresh, ["k"]).count() == 3


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (3, None)], "k int, v string")
    assert rows(snapshot_diff(old, new, ["k"])) == [(2, "B", "update"), (4, "d", "insert")]
    assert rows(snapshot_diff(new, old.where("k = 1"), ["k"])) == [
        (2, "B", "delete"),
        (3, None, "delete"),
        (4, "d", "delete"),
    ]


def test_scd2_twice_is_stable(spark):
    d = dt.date
    history = spark.createDataFrame(
        [(1, "a", d(2020, 1, 1), None, True), (2, "b", d(2020, 1, 1), None, True)],
        "k int, v string, valid_from date, valid_to date, is_current boolean",
    )
    snap = spark.createDataFrame([(1, "A"), (3, "c")], "k int, v string")
    once = scd2(history, snap, ["k"], ["v"], F.to_date(F.lit("2024-01-01")))
    assert rows(once) == [
        (1, "A", d(2024, 1, 1), None, True),
        (1, "a", d(2020, 1, 1), d(2024, 1, 1), False),
        (2, "b", d(2020, 1, 1), None, True),
        (3, "c", d(2024, 1, 1), None, True),
    ]
    assert rows(scd2(once, snap, ["k"], ["v"], F.to_date(F.lit("2025-01-01")))) == rows(once)


def test_surrogate_keys_follow_the_order(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("a"),
        (F.col("id") % 7).cast("string").alias("b"),
    )
    keyed = surrogate_key(dimension(df, ["a", "b"]), ["a", "b"])
    got = keyed.orderBy("dimension_key").collect()
    assert [r.dimension_key for r in got] == list(range(1, len(got) + 1))
    assert [(r.a is not None, r.a, r.b) for r in got] == sorted((r.a is not None, r.a, r.b) for r in got)
    assert sum(r.record_count for r in got) == 5000


def test_append_create_and_merge(spark, table):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    append_or_create(df, table, ["p"])
    append_or_create(df, table, ["p"])
    assert spark.table(table).count() == 4
    spark.sql(f"DROP TABLE {table}")
    create_or_merge(df, table, ["k"])
    create_or_merge(spark.createDataFrame([(2, "B"), (3, "c")], "k int, p string"), table, ["k"])
    assert rows(spark.table(table)) == [(1, "a"), (2, "B"), (3, "c")]
    create_or_merge(df, table, ["k"], merge_mode=False)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]


def test_write_gold_keeps_rows_and_statistics(spark, table):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("p"), (F.col("id") % 10).alias("c"))
    write_gold(df, table, ["p"], ["c"])
    assert spark.table(table).groupBy().sum("id").first()[0] == 499_500
    assert "1000 rows" in str(spark.sql(f"DESCRIBE EXTENDED {table}").collect())


def test_copy_into_retries_the_unfinished_batch(spark):
    root = scratch_path(spark, "test-copy")
    src, dst = f"{root}/in", f"{root}/out"
    spark.range(10).repartition(5).write.parquet(src)
    assert copy_into(spark, src, dst, pattern="*.parquet", files_per_batch=2) == 5
    assert copy_into(spark, src, dst, pattern="*.parquet") == 0
    # Data of a batch that died before its ledger entry: the next load replaces it.
    spark.range(99, 100).write.parquet(f"{dst}/copy_batch=3")
    spark.range(10, 12).coalesce(1).write.mode("append").parquet(src)
    assert copy_into(spark, src, dst, pattern="*.parquet") == 1
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == list(range(12))


def test_stream_loads_each_file_once(spark):
    root = scratch_path(spark, "test-stream")
    src, dst = f"{root}/in", f"{root}/out"

    def load():
        load_new_files(spark, src, dst, f"{root}/log", "id long").awaitTermination()
        return sorted(r.id for r in spark.read.parquet(dst).collect())

    spark.range(3).write.parquet(src)
    assert load() == load() == [0, 1, 2]
    spark.range(3, 5).write.mode("append").parquet(src)
    assert load() == [0, 1, 2, 3, 4]


def test_compact_merges_files_and_keeps_rows(spark):
    root = scratch_path(spark, "test-compact")
    df = spark.range(2000).select("id", (F.col("id") % 4).alias("p"))
    df.repartition(40).write.parquet(f"{root}/a")
    before = spark.read.parquet(f"{root}/a")
    before.createOrReplaceTempView("before_compaction")
    compact(before, f"{root}/b", partition_by=["p"])
    after = spark.read.parquet(f"{root}/b")
    assert file_stats(after).count() < file_stats(before).count()
    assert after.groupBy().sum("id").first() == before.groupBy().sum("id").first()
    stats = layout_stats(after).first()
    assert stats.row_count == 2000 and stats.partition_columns == "p"
    compact(before, f"{root}/c", where="p = 1", partition_by=["p"])
    assert spark.read.parquet(f"{root}/c").count() == 2000


def test_zorder_narrows_both_columns(spark):
    root = scratch_path(spark, "test-z")
    df = spark.range(20_000).select(
        (F.hash("id") % 1000).alias("x"), (F.hash(F.col("id") + 7) % 1000).alias("y")
    )
    df.write.parquet(f"{root}/a")
    zorder(spark.read.parquet(f"{root}/a"), ["x", "y"], partitions=16).write.parquet(f"{root}/b")
    after = spark.read.parquet(f"{root}/b")

    def spread(frame, c):
        by_file = frame.groupBy(F.col("_metadata.file_path").alias("f"))
        return by_file.agg((F.max(c) - F.min(c)).alias("w")).agg(F.avg("w")).first()[0]

    assert spread(after, "x") < 1200 and spread(after, "y") < 1200  # of 1998
    assert rows(after.groupBy("x").count()) == rows(df.groupBy("x").count())


def test_zorder_splits_copies_and_keeps_them(spark):
    root = scratch_path(spark, "test-z")
    copies = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"), F.lit("s").alias("s"))
    copies.write.parquet(f"{root}/a")
    out = zorder(spark.read.parquet(f"{root}/a"), ["x", "s"], partitions=9)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3000
    derived = zorder(copies.groupBy("x", "s").count(), ["x"])
    assert derived.count() == copies.distinct().count()


def test_z_value_rejects_too_many_bits(spark):
    with pytest.raises(ValueError):
        z_value(spark.range(1), ["id"] * 11)


def test_enrich_keeps_unmatched_and_checks_size(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    lookup = spark.createDataFrame([("a", 1)], "key string, v int")
    assert rows(enrich(df, lookup, {"k": "key"}, {"v": "got"})) == [("a", 1), ("z", None), (None, None)]
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(checked_broadcast(lookup))
    assert not hinted(checked_broadcast(spark.range(100), max_rows=10))
    assert not hinted(checked_broadcast(spark.range(100), max_bytes=10))


def test_access(spark):
    df = spark.createDataFrame([("a", "r1"), ("b", "r2")], "name string, region string")
    allowed = spark.createDataFrame([("r1",)], "r string")
    assert rows(row_filter(df, "region", allowed, True, "r")) == [("a", "r1")]
    assert row_filter(df, "region", allowed, False, "r") is df
    assert rows(mask_columns(df, ["name"], False).select("name")) == [("REDACTED",), ("REDACTED",)]


def test_shuffle_partitions_scale():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(10**12, 8) == 7451


def test_snapshot_diff_without_keys(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (None, "c"), (1, "b")], "k int, v string")
    assert rows(snapshot_diff(old, new, ["k"])) == [
        (None, "a", "delete"),
        (None, "a", "insert"),
        (None, "c", "insert"),
    ]


def test_copy_into_keeps_the_first_types(spark):
    root = scratch_path(spark, "test-types")
    src, dst = f"{root}/in", f"{root}/out"
    spark.createDataFrame([("007",)], "code string").write.json(src)
    assert copy_into(spark, src, dst, "json", "*.json") == 1
    spark.createDataFrame([(8,)], "code int").write.mode("append").json(src)
    assert copy_into(spark, src, dst, "json", "*.json") == 1
    loaded = spark.read.parquet(dst)
    assert dict(loaded.dtypes)["code"] == "string"
    assert rows(loaded.select("code")) == [("007",), ("8",)]


def test_partition_merge_leaves_other_partitions_alone(spark, table):
    keys, parts = ["k", "p"], ["p"]
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (2, "b", "y"), (3, "c", None)], "k int, v string, p string"
    )
    create_or_merge(df, table, keys, parts)

    def files():
        listed = spark.table(table).select("p", F.col("_metadata.file_path").alias("f"))
        return {tuple(r) for r in listed.distinct().collect()}

    before = files()
    source = spark.createDataFrame([(2, "B", "y"), (4, "d", "z"), (5, "e", None)], df.schema)
    create_or_merge(source, table, keys, parts)
    assert rows(spark.table(table)) == [
        (1, "a", "x"),
        (1, "b", "x"),
        (2, "B", "y"),
        (3, "c", None),
        (4, "d", "z"),
        (5, "e", None),
    ]
    kept = {f for p, f in before & files()}
    assert kept and all("p=x" in f for f in kept)
    create_or_merge(source.dropna(), table, keys, parts)
    assert spark.table(table).count() == 6


def test_merge_of_a_partitioned_table_by_other_keys(spark, table):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, p string")
    create_or_merge(df, table, ["k"], ["p"])
    moved = spark.createDataFrame([(2, "B", "x")], df.schema)
    for _ in range(2):
        create_or_merge(moved, table, ["k"], ["p"])
        assert rows(spark.table(table)) == [(1, "a", "x"), (2, "B", "x")]


def test_rewrites_keep_location_and_partitions(spark, table, tmp_path):
    """Merging at one location never reads what it overwrites; optimising keeps the layout."""
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, p string, v int")
    for v in (1, 2, 3):
        create_or_merge(df.withColumn("v", F.lit(v)), table, ["k"], ["p"], location=str(tmp_path))
    optimize_table(spark, table, cluster_by=["k"])
    assert sorted(tuple(r) for r in spark.table(table).select("k", "p", "v").collect()) == [(1, "a", 3), (2, "b", 3)]
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["p"]
    assert spark.catalog.getTable(table).tableType == "EXTERNAL"
    assert all(str(tmp_path) in f for f in spark.table(table).inputFiles())


def test_snapshots_with_repeated_keys_raise(spark):
    from stratiform.operators.merge import RepeatedKey, snapshot_diff

    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    once = twice.where("v <> 'b'")
    assert snapshot_diff(once, once, ["k"]).where("k is not null").count() == 0
    with pytest.raises(RepeatedKey):
        snapshot_diff(once, twice, ["k"])


def load_csv(spark, src, name, text):
    folder = Path(src)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_load_follows_headers_and_rescues_what_does_not_fit(spark):
    root = scratch_path(spark, "test-evolve")
    src, dst = f"{root}/in", f"{root}/out"
    load_csv(spark, src, "a.csv", "id,amount,day\n1,1.50,2024-01-01\n2,2.25,2024-01-02\n")
    assert copy_into(spark, src, dst, "csv", "*.csv") == 1
    load_csv(spark, src, "b.csv", "day,id,amount\n2024-01-03,3,9.75\n")
    load_csv(spark, src, "c.csv", "ID,amount,note\n4,x,hello\nfive,5.5,\n6,6.5,a,surplus\n")
    load_csv(spark, src, "d.csv", "")  # empty files are not listed
    assert copy_into(spark, src, dst, "csv", "*.csv") == 2
    assert copy_into(spark, src, dst, "csv", "*.csv") == 0
    got = loaded(spark, dst)
    assert got.dtypes[:4] == [("id", "int"), ("amount", "double"), ("day", "date"), ("note", "string")]
    by_id = {r.id: r for r in got.collect()}
    assert len(by_id) == got.count() == 6
    assert (by_id[3].amount, str(by_id[3].day), by_id[3].note) == (9.75, "2024-01-03", None)
    assert (by_id[4].amount, by_id[4].note, json.loads(by_id[4]._rescued_data)) == (None, "hello", {"amount": "x"})
    assert json.loads(by_id[None]._rescued_data) == {"id": "five"} and by_id[None].amount == 5.5
    assert "surplus" in json.loads(by_id[6]._rescued_data)["_corrupt_record"]
    assert by_id[1]._rescued_data is None
    assert [r.schema_version for r in schema_versions(spark, dst).orderBy("schema_version").collect()] == [1, 2]
    assert {r.schema_version for r in loaded_files(spark, dst).where("path like '%a.csv'").collect()} == {1}


def test_load_of_parquet_files_that_disagree(spark):
    root = scratch_path(spark, "test-evolve")
    src, dst = f"{root}/in", f"{root}/out"
    spark.createDataFrame([(1, 1.0)], "k int, v double").coalesce(1).write.parquet(src)
    copy_into(spark, src, dst, pattern="*.parquet")
    later = spark.createDataFrame([(2**40, 2.0, "new")], "k long, v double, w string").coalesce(1)
    later.write.mode("append").parquet(src)
    spark.createDataFrame([("three", 7, None)], "k string, v int, w string").coalesce(1).write.mode("append").parquet(src)
    assert copy_into(spark, src, dst, pattern="*.parquet") == 2
    got = {(r.k, r.v, r.w, r._rescued_data) for r in loaded(spark, dst).collect()}
    assert got == {(1, 1.0, None, None), (None, 2.0, "new", '{"k":"1099511627776"}'), (None, 7.0, None, '{"k":"three"}')}


def test_load_without_evolution_keeps_surplus_columns(spark):
    root = scratch_path(spark, "test-evolve")
    src, dst = f"{root}/in", f"{root}/out"
    spark.createDataFrame([(1, [1, 2])], "k int, extra array<int>").write.json(src)
    copy_into(spark, src, dst, "json", "*.json", schema="k decimal(4,1), m string", evolve=False)
    row = loaded(spark, dst).first()
    assert (float(row.k), row.m, json.loads(row._rescued_data)) == (1.0, None, {"extra": "[1,2]"})
    assert copy_into(spark, src, dst, "json", "*.json", reload=True) > 0
    assert loaded(spark, dst).where("k = 1").count() == 2
    spark.createDataFrame([(1, 2)], "k int, copy_batch int").write.mode("append").json(src)
    with pytest.raises(LoadConflict):
        copy_into(spark, src, dst, "json", "*.json")


def test_casts_that_lose_something_are_rescued(spark):
    df = spark.createDataFrame([("1.239", "2024-01-01 10:00:00", 1.5, 300), ("1.23", "2024-01-01", 2.0, 3), (None, None, None, None)], "a string, b string, c double, d int")
    got = conform(df, T.StructType.fromDDL("a decimal(5,2), b date, c int, d tinyint")).collect()
    assert json.loads(got[0]._rescued_data) == {"a": "1.239", "b": "2024-01-01 10:00:00", "c": "1.5", "d": "300"}
    assert (str(got[1].a), str(got[1].b), got[1].c, got[1].d, got[1]._rescued_data) == ("1.23", "2024-01-01", 2, 3, None)
    assert tuple(got[0])[:4] == tuple(got[2]) [:4] == (None,) * 4


def test_stream_and_batch_load_alike(spark):
    root = scratch_path(spark, "test-evolve")
    src = f"{root}/in"
    load_csv(spark, src, "a.csv", "id,v\n1,10\n")

    def load():
        load_evolving_files(spark, src, f"{root}/stream", f"{root}/log", "csv", "*.csv").awaitTermination()
        copy_into(spark, src, f"{root}/batch", "csv", "*.csv")

    load()
    load()
    load_csv(spark, src, "b.csv", "w,v,id\nx,twenty,2\n")
    load()
    a, b = (rows(loaded(spark, f"{root}/{way}")) for way in ("stream", "batch"))
    assert a == b and len(a) == 2


def names_of(spark, path):
    return {Path(r.file_path).name: r.row_count for r in file_stats(spark.read.parquet(path)).collect()}


def test_bins_are_first_fit_decreasing():
    assert first_fit_decreasing([3, 9, 5, 2, 7], 10) == [[1], [4, 0], [2, 3]]
    assert first_fit_decreasing([], 10) == []
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(500)]
    bins = first_fit_decreasing(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= 11 / 9 * -(-sum(sizes) // 100) + 1


def test_compacting_chosen_files_leaves_the_others(spark):
    path = scratch_path(spark, "test files +%")
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("p"), F.lit("a b/%+").alias("q"))
    df.repartition(5).write.partitionBy("p", "q").parquet(path)
    before = {f: p for p in (0, 1, 2) for f, _ in touched_files(spark.read.parquet(path), f"p = {p}")}
    assert compact_files(spark, path, "p >= 1 AND id < 2000") == (10, 2)
    after = {f: p for p in (0, 1, 2) for f, _ in touched_files(spark.read.parquet(path), f"p = {p}")}
    assert {f for f, p in before.items() if p == 0} == {f for f, p in after.items() if p == 0}
    assert Counter(after.values()) == {0: 5, 1: 1, 2: 1}
    assert rows(spark.read.parquet(path).select("id", "p", "q")) == rows(df)
    assert compact_files(spark, path, "p = 7") == (0, 0)
    # Nothing small enough is left to merge.
    assert compact_files(spark, path, "p = 1") == (0, 0)
    assert compact_files(spark, path, "p = 0", cluster_by=["id"]).removed == 5
    assert rows(spark.read.parquet(path).select("id", "p", "q")) == rows(df)


def test_writing_bins_and_small_files_sorts_no_rows_and_grows(spark, monkeypatch):
    """A sort by folder takes memory for all rows of a task, and so do tasks of a fixed number."""
    path = scratch_path(spark, "test-lines")
    price = (F.col("id") % 97).cast("double")
    flag = F.when(F.col("id") % 5 == 0, None).otherwise(F.substring(F.lit("RNAR"), (F.col("id") % 4 + 1).cast("int"), F.lit(1)))
    lines = spark.range(6000).select((F.col("id") % 50).alias("l_orderkey"), price.alias("l_extendedprice"), flag.alias("l_returnflag"))
    lines.unionAll(lines).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    writers, write = [], DataFrameWriter.parquet

    def spied(self, to, *args, **kwargs):
        if re.search("/(data|compact-where-[0-9a-f]*)$", to):
            writers.append((int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")), self._df.rdd.getNumPartitions()))
        return write(self, to, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    monkeypatch.setattr(source_queries, "_SMALL_FILE_BYTES", 100, raising=False)
    got = {r.l_returnflag: (r.lines, r.price, r.files_kept, r.fewer_files) for r in source_queries.lay_compact_where(spark, path).collect()}
    want = {r.l_returnflag: (r.n, float(r.p)) for r in lines.groupBy("l_returnflag").agg((2 * F.count("*")).alias("n"), (2 * F.sum("l_extendedprice")).alias("p")).collect()}
    assert {k: (v[0], float(v[1])) for k, v in got.items() if k} == {k: v for k, v in want.items() if k}
    assert {k: v[2:] for k, v in got.items() if k} == {"R": (False, True), "N": (True, False), "A": (True, False)}
    (small, parts), (bins, _) = writers
    # Spark sorts once as many files are open as the setting says.
    assert small > 4 and bins > 1
    assert parts > 12
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_merging_files_rewrites_only_those_with_matches(spark):
    path = scratch_path(spark, "test-merge")
    target = spark.range(1000).select("id", F.lit("old").alias("v"), F.lit(None).cast("int").alias("w"))
    target.repartitionById(10, F.floor(F.col("id") / 100).cast("int")).write.parquet(path)
    before = names_of(spark, path)
    source = spark.createDataFrame([(5, "new", 1), (310, "new", None), (5000, "new", 2), (None, "new", 3)], "id long, v string, w int")
    assert merge_files(spark, path, source, ["id"]).removed == 2
    after = names_of(spark, path)
    assert len(before.keys() & after.keys()) == 8
    got = spark.read.parquet(path)
    assert got.count() == 1002 and got.where("v = 'new'").count() == 4
    assert rows(got) == rows(upsert(target, source, ["id"]))
    # Again: the row without a key is added once more, as a merge does.
    merge_files(spark, path, source.where("id is not null"), ["id"])
    assert rows(spark.read.parquet(path)) == rows(upsert(target, source, ["id"]))
    assert merge_files(spark, path, source.where("id is null"), ["id"]).removed == 0
    assert merge_files(spark, path, source.limit(0), ["id"]).removed == 0
    twice = spark.createDataFrame([(7, "x", 1), (7, "y", 1)], source.schema)
    with pytest.raises(AmbiguousMatch):
        merge_files(spark, path, twice, ["id"])
    assert spark.read.parquet(path).count() == 1003


def test_a_rewrite_that_died_is_finished_or_dropped(spark, monkeypatch):
    path = scratch_path(spark, "test-recover")
    spark.range(100).repartition(4).write.parquet(path)
    old = [f for f, _ in touched_files(spark.read.parquet(path))]
    new = spark.range(100, 150)

    def die(*args):
        raise KeyboardInterrupt

    # Before the list of replaced files is there, nothing has happened.
    with monkeypatch.context() as m:
        m.setattr(rewrite, "local_frame", die)
        with pytest.raises(KeyboardInterrupt):
            replace_files(spark, path, old[:2], new)
    assert spark.read.parquet(path).count() == 100
    assert recover(spark, path) == 1 and recover(spark, path) == 0
    assert spark.read.parquet(path).count() == 100
    # Afterwards it is carried through, also when it died among the moves.
    with monkeypatch.context() as m:
        m.setattr(rewrite._Files, "remove", die)
        with pytest.raises(KeyboardInterrupt):
            replace_files(spark, path, old, new)
    assert recover(spark, path) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100, 150))


def test_tables_are_merged_and_optimised_in_place(spark, table):
    df = spark.range(300).select("id", F.lit("a").alias("v"), (F.col("id") % 2).cast("string").alias("p"))
    create_or_merge(df.repartition(3), table, ["id"], ["p"])
    for name in ("0", "1"):
        df.where(F.col("p") == name).limit(0).write.insertInto(table)
    before = {f for f, _ in touched_files(spark.table(table), "p = '1'")}
    change = spark.createDataFrame([(4, "b", "0"), (1000, "b", "new")], "id long, v string, p string")
    create_or_merge(change, table, ["id"])
    assert {f for f, _ in touched_files(spark.table(table), "p = '1'")} == before
    assert spark.table(table).where("v = 'b'").count() == 2 and spark.table(table).count() == 301
    optimize_table(spark, table, where="p = '0'")
    assert len(touched_files(spark.table(table), "p = '0'")) == 1
    assert {f for f, _ in touched_files(spark.table(table), "p = '1'")} == before
    assert spark.table(table).count() == 301


def test_folders_route_files_without_an_ending(spark, tmp_path):
    (tmp_path / "in" / "csv").mkdir(parents=True)
    (tmp_path / "in" / "csv" / "data").write_text("i,s\n1,x\n")
    (tmp_path / "in" / "other").mkdir()
    (tmp_path / "in" / "other" / "more.csv").write_text("i,s\n2,y\n")
    (tmp_path / "in" / "note.txt").write_text("no table")
    spark.createDataFrame([(3, "z")], "i int, s string").write.parquet(str(tmp_path / "in" / "csv" / "parquet"))
    for part in (tmp_path / "in" / "csv" / "parquet").glob("*.parquet"):
        part.rename(part.with_suffix(""))
    routed = route_by_format(spark, str(tmp_path / "in"), "t", lineage=True)
    assert list(routed) == ["t", "t_csv"]
    assert rows(routed["t"].select("i", "s")) == [(3, "z")]
    assert rows(routed["t_csv"].select("i", "s")) == [(1, "x"), (2, "y")]
    audited = with_audit(routed["t_csv"])
    assert "_metadata" not in audited.columns
    assert {Path(r["_source_file"]).name for r in audited.collect()} == {"data", "more.csv"}


def test_lineage_through_a_mixed_tree(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    df.drop("s").write.option("header", True).csv(str(tmp_path / "c"))
    tree = read_tree(spark, str(tmp_path), lineage=True)
    got = {Path(r.source_file).suffix: (r.i, r.s, r.year) for r in with_run_metadata(tree, "2024", "r").collect()}
    assert got == {".parquet": ("1", "a", "2024"), ".json": ("1", "a", "2024"), ".csv": ("1", None, "2024")}


def test_repeated_open_rows_raise_in_history(spark):
    from stratiform.operators.merge import RepeatedKey

    schema = "k int, v string, valid_from date, valid_to date, is_current boolean"
    day = dt.date(2024, 1, 1)
    closed = [(1, "a", day, day, False)] * 3
    history = spark.createDataFrame([(1, "b", day, None, True), *closed], schema)
    once = spark.createDataFrame([(1, "c"), (None, "x"), (None, "x")], "k int, v string")
    at = F.to_date(F.lit("2024-02-01"))
    assert scd2(history, once, ["k"], ["v"], at).count() == 7
    with pytest.raises(RepeatedKey):
        scd2(history, once.unionAll(once), ["k"], ["v"], at)
    with pytest.raises(RepeatedKey):
        scd2(history.unionAll(history), once, ["k"], ["v"], at)


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("n"))
    once = rows(bernoulli_sample(df.repartition(3), 0.1))
    assert once == rows(bernoulli_sample(df.repartition(17, "n"), 0.1)) and 1800 < len(once) < 2200
    assert once != rows(bernoulli_sample(df, 0.1, seed=8))
    assert bernoulli_sample(df, 1.0).count() == 20_000 and bernoulli_sample(df, 0.0).count() == 0


def test_depth_of_overlapping_files(spark):
    path = scratch_path(spark, "test-depth")
    for lo, hi in ((0, 10), (5, 15), (10, 20), (30, 30), (30, 40), (None, None)):
        spark.createDataFrame([(lo, 1), (hi, 1)], "a int, b int").coalesce(1).write.mode("append").parquet(path)
    got = {r.column_name: r for r in cluster_depth(spark.read.parquet(path), ["a", "b"]).collect()}
    # Bounds that touch overlap: the first three all meet each other, and so do the last two.
    assert (got["a"].num_files, got["a"].max_depth, got["a"].avg_overlap) == (5, 3, 13 / 5)
    assert (got["b"].num_files, got["b"].max_depth, got["b"].avg_overlap) == (6, 6, 6.0)


def test_checked_writes_take_both_sides_in_one_pass(spark):
    path = scratch_path(spark, "test-quarantine")
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    write_checked(df, path, {"has_k": "k IS NOT NULL", "short": "length(v) < 5"})
    assert rows(accepted(spark, path)) == [(1, "a")]
    assert rows(quarantined(spark, path)) == [(2, None, "short"), (None, "c", "has_k")]
    write_checked(df.limit(1), path, {}, mode="append")
    assert accepted(spark, path).count() == 2
