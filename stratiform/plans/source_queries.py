"""Readers and writers, each exercised on a copy that Spark writes of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions.audit import with_audit
from stratiform.operators.enrich import enrich
from stratiform.operators.layout import cluster_depth, compact, file_stats, layout_stats, open_folders, zorder
from stratiform.operators.merge import upsert
from stratiform.plans.registry import dbl, query
from stratiform.session import partitions_of, scratch_path
from stratiform.sinks import (
    accepted,
    append_or_create,
    compact_files,
    copy_into,
    create_or_merge,
    loaded,
    merge_files,
    overwrite_table,
    quarantined,
    write_checked,
    write_gold,
)
from stratiform.sources import (
    file_inventory,
    read_source,
    read_tree,
    reference_df,
    route_by_format,
    star_table,
)
from stratiform.streaming import load_evolving_files, load_new_files


def _money_sql(source: str = "orders") -> str:
    total = dbl("sum(CAST(o_totalprice AS DECIMAL(18,2)))")
    return (
        f"SELECT o_orderstatus, count(*) AS orders, {total} AS total, "
        f"max(o_orderkey) AS last_key FROM {source} GROUP BY 1"
    )


def _money(df):
    return df.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.max(F.col("o_orderkey").cast("bigint")).alias("last_key"),
    )


def _orders(spark, sf):
    return star_table(spark, sf, "orders")


def _table_name(path: str) -> str:
    return "stratiform_" + path.rsplit("/", 1)[-1].replace("-", "_")


@query("src_read_parquet", _money_sql())
def src_read_parquet(spark, sf):
    return _money(read_source(spark, f"{sf}/orders.parquet"))


@query("src_read_csv", _money_sql())
def src_read_csv(spark, sf):
    path = scratch_path(spark, "csv")
    _orders(spark, sf).write.option("header", True).csv(path)
    return _money(read_source(spark, path, "csv"))


@query("src_read_json", _money_sql())
def src_read_json(spark, sf):
    path = scratch_path(spark, "json")
    _orders(spark, sf).write.json(path)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    return _money(read_source(spark, path, "json", schema))


def _mixed_tree(spark, sf) -> str:
    """The orders, spread over nested folders in three formats by their status."""
    root = scratch_path(spark, "tree")
    status = F.col("o_orderstatus")
    df = _orders(spark, sf)
    df.where(status == "F").write.parquet(f"{root}/a/deep/er")
    df.where(status == "O").write.option("header", True).csv(f"{root}/b")
    df.where(~status.isin("F", "O")).write.json(f"{root}/c/deep")
    return root


@query("src_read_tree", _money_sql())
def src_read_tree(spark, sf):
    return _money(read_tree(spark, _mixed_tree(spark, sf)))


@query(
    "src_route",
    """SELECT 'trips' AS target, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'trips_csv', count(*) FROM orders WHERE o_orderstatus = 'O'""",
)
def src_route(spark, sf):
    routed = route_by_format(spark, _mixed_tree(spark, sf), "trips")
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("target"), "rows")
        for name, df in routed.items()
    ]
    return parts[0].unionByName(parts[1])


@query("src_file_inventory")
def src_file_inventory(spark, sf):
    listed = file_inventory(spark, _mixed_tree(spark, sf), max_depth=4)
    return listed.withColumn("sample_paths", F.array_join("sample_paths", ";"))


@query(
    "src_reference_zone",
    """SELECT CASE WHEN n_name IN ('NATION_5', 'NATION_6') THEN 'AIR' END AS borough,
              count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
       GROUP BY 1""",
)
def src_reference_zone(spark, sf):
    zones = reference_df(
        spark,
        [("NATION_5", "AIR"), ("NATION_6", "AIR")],
        "zone string NOT NULL, borough string NOT NULL",
    )
    customers = star_table(spark, sf, "customer").join(
        star_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = enrich(customers, zones, {"n_name": "zone"}, {"borough": "borough"})
    return placed.groupBy("borough").agg(F.count("*").alias("customers"))


@query("snk_append", _money_sql("(SELECT * FROM orders UNION ALL SELECT * FROM orders)"))
def snk_append(spark, sf):
    path = scratch_path(spark, "append")
    table = _table_name(path)
    append_or_create(_orders(spark, sf), table, ["o_orderstatus"], path)
    append_or_create(_orders(spark, sf), table, ["o_orderstatus"])
    spark.sql(f"DROP TABLE {table}")
    return _money(spark.read.parquet(path))


@query(
    "snk_overwrite",
    """SELECT c_mktsegment, count(*) AS customers, max(c_custkey) AS last_key, 4 AS column_count
       FROM customer GROUP BY 1""",
)
def snk_overwrite(spark, sf):
    path = scratch_path(spark, "overwrite")
    table = _table_name(path)
    overwrite_table(_orders(spark, sf), table, location=path)
    customers = star_table(spark, sf, "customer").drop("c_name")
    overwrite_table(customers, table, ["c_mktsegment"], path)
    columns = len(spark.table(table).columns)
    spark.sql(f"DROP TABLE {table}")
    return (
        spark.read.parquet(path)
        .groupBy("c_mktsegment")
        .agg(
            F.count("*").alias("customers"),
            F.max("c_custkey").alias("last_key"),
            F.lit(columns).alias("column_count"),
        )
    )


@query("snk_copy_into", _money_sql())
def snk_copy_into(spark, sf):
    """Three loads of a growing folder: each file is taken once."""
    root = scratch_path(spark, "copy")
    src, dst = f"{root}/in", f"{root}/out"
    closed = F.col("o_orderstatus") == "F"
    _orders(spark, sf).where(closed).repartition(4).write.parquet(src)
    copy_into(spark, src, dst, pattern="*.parquet", files_per_batch=3)
    copy_into(spark, src, dst, pattern="*.parquet")
    _orders(spark, sf).where(~closed).write.mode("append").parquet(src)
    copy_into(spark, src, dst, pattern="*.parquet")
    return _money(spark.read.parquet(dst))


@query("snk_copy_into_stream", _money_sql())
def snk_copy_into_stream(spark, sf):
    """The same as a stream that catches up and stops, three times."""
    root = scratch_path(spark, "stream")
    src, dst, log = f"{root}/in", f"{root}/out", f"{root}/log"
    closed = F.col("o_orderstatus") == "F"
    orders = _orders(spark, sf)

    def load():
        load_new_files(spark, src, dst, log, orders.schema, audit=True).awaitTermination()

    orders.where(closed).write.parquet(src)
    load()
    load()
    orders.where(~closed).write.mode("append").parquet(src)
    load()
    return _money(spark.read.parquet(dst))


@query(
    "snk_copy_into_evolving",
    """WITH orders_in AS (
         SELECT o_orderkey, o_orderstatus, o_totalprice,
                o_orderstatus = 'P' AND o_orderkey % 10 = 0 AS bad, o_custkey,
                CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders)
       SELECT way, o_orderkey, CASE WHEN NOT bad THEN o_custkey END AS o_custkey, o_orderstatus,
              o_totalprice, o_orderpriority,
              CASE WHEN bad THEN '{"o_custkey":"no. ' || o_custkey || '"}' END AS rescued
       FROM orders_in, (VALUES ('batch'), ('stream')) AS ways(way)""",
)
def snk_copy_into_evolving(spark, sf):
    """CSV files with other orders of columns, a new column and bad numbers, batch and stream."""
    root = scratch_path(spark, "copy-evolving")
    src = f"{root}/in"
    orders = _orders(spark, sf)
    status = F.col("o_orderstatus")
    custkey = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("no. "), "o_custkey"))
    arrivals = [
        orders.where(status == "F").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
        orders.where(status == "O").select("o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey"),
        orders.where(status == "P").select(
            "o_orderpriority", "o_orderkey", F.coalesce(custkey, F.col("o_custkey").cast("string")).alias("o_custkey"),
            "o_orderstatus", "o_totalprice",
        ),
    ]
    for rows in arrivals:
        rows.write.mode("append").option("header", True).csv(src)
        copy_into(spark, src, f"{root}/batch", "csv", "*.csv")
        load_evolving_files(spark, src, f"{root}/stream", f"{root}/log", "csv", "*.csv").awaitTermination()
    parts = [
        loaded(spark, f"{root}/{way}").select(
            F.lit(way).alias("way"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
            "o_orderpriority", F.col("_rescued_data").alias("rescued"),
        )
        for way in ("batch", "stream")
    ]
    return parts[0].unionByName(parts[1])


_CHANGES = """changes AS (
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT o_orderkey + 1000000000000, o_custkey, 'N', o_totalprice FROM orders
  WHERE o_orderstatus = 'P')"""

_UPSERTED = f"""WITH {_CHANGES}
  SELECT * FROM changes UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)"""

_UPSERT_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _changes(spark, sf):
    """Orders since 1998 with a new status, and copies of the pending ones as new orders."""
    orders = _orders(spark, sf)
    changed = orders.where(F.col("o_orderdate") >= "1998-01-01").select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_totalprice"
    )
    added = orders.where(F.col("o_orderstatus") == "P").select(
        (F.col("o_orderkey") + 1_000_000_000_000).alias("o_orderkey"),
        "o_custkey",
        F.lit("N").alias("o_orderstatus"),
        "o_totalprice",
    )
    return changed.unionByName(added)


@query("snk_upsert", _UPSERTED)
def snk_upsert(spark, sf):
    target = _orders(spark, sf).select(*_UPSERT_COLUMNS)
    return upsert(target, _changes(spark, sf), ["o_orderkey"])


@query("snk_create_or_merge", _UPSERTED)
def snk_create_or_merge(spark, sf):
    """A table created, then merged into twice with the same changes, at one location."""
    path = scratch_path(spark, "merge")
    table = _table_name(path)
    target = _orders(spark, sf).select(*_UPSERT_COLUMNS)
    for rows in (target, _changes(spark, sf), _changes(spark, sf)):
        create_or_merge(rows, table, ["o_orderkey"], location=path)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    files = described.first().data_type
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(files)


@query("snk_merge_files", _UPSERTED.replace("SELECT * FROM changes", "SELECT *, 'written' AS file FROM changes").replace(
    "o_totalprice FROM orders\n  WHERE o_orderkey NOT IN",
    """o_totalprice, CASE WHEN o_orderkey // 1000 IN (SELECT o_orderkey // 1000 FROM changes)
         THEN 'written' ELSE 'kept' END FROM orders WHERE o_orderkey NOT IN""",
))
def snk_merge_files(spark, sf):
    """The same changes merged into a folder of files by key; each row with its file's fate."""
    path = scratch_path(spark, "merge-files")
    target = _orders(spark, sf).select(*_UPSERT_COLUMNS)
    span = F.floor(F.col("o_orderkey") / 1000).cast("int")
    spans = target.agg(F.max(span)).first()[0] + 1
    target.repartitionById(spans, span).write.parquet(path)
    before = file_stats(spark.read.parquet(path)).select("file_path", F.lit("kept").alias("file"))
    before.write.parquet(f"{path}-before")
    changes = _changes(spark, sf)
    merge_files(spark, path, changes, ["o_orderkey"])
    merge_files(spark, path, changes.where("o_orderstatus = 'N'"), ["o_orderkey"])
    after = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    fate = F.coalesce("file", F.lit("written")).alias("file")
    return after.join(spark.read.parquet(f"{path}-before"), "file_path", "left").select(*_UPSERT_COLUMNS, fate)


@query(
    "snk_merge_partitions",
    """WITH changes AS (
         SELECT o_orderkey, o_orderpriority, 'X' AS o_orderstatus, o_totalprice FROM orders
         WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
       SELECT * FROM changes UNION ALL
       SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders
       WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')""",
)
def snk_merge_partitions(spark, sf):
    """A merge that rewrites one partition of the table and leaves the others."""
    path = scratch_path(spark, "merge-parts")
    table = _table_name(path)
    target = _orders(spark, sf).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    keys, parts = ["o_orderpriority", "o_orderkey"], ["o_orderpriority"]
    changes = target.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
    create_or_merge(target, table, keys, parts, location=path)
    create_or_merge(changes.withColumn("o_orderstatus", F.lit("X")), table, keys, parts)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path)


@query(
    "snk_write_gold",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderpriority, count(*) AS orders
       FROM orders GROUP BY 1, 2""",
)
def snk_write_gold(spark, sf):
    path = scratch_path(spark, "gold")
    table = _table_name(path)
    gold = (
        _orders(spark, sf)
        .groupBy(F.year("o_orderdate").alias("order_year"), "o_orderpriority")
        .agg(F.count("*").alias("orders"))
    )
    write_gold(gold, table, ["order_year"], ["o_orderpriority", "orders"], location=path)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path)


# Bytes of a scan whose rows go into one set of small files.
_SMALL_FILE_BYTES = 32 * 1024 * 1024

_LINES_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  l_quantity, l_extendedprice, l_returnflag FROM lineitem"""


def _lines(df):
    return df.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
    )


@query("lay_compact", _LINES_SQL)
def lay_compact(spark, sf):
    path = scratch_path(spark, "compact")
    lines = star_table(spark, sf, "lineitem")
    compact(lines, path, where="l_returnflag <> 'N'", partition_by=["l_returnflag"])
    return _lines(spark.read.parquet(path))


@query(
    "lay_compact_where",
    f"""SELECT l_returnflag, count(*) AS lines, {dbl("sum(CAST(l_extendedprice AS DECIMAL(18,2)))")} AS price,
               l_returnflag <> 'R' AS files_kept, l_returnflag = 'R' AS fewer_files
        FROM lineitem GROUP BY l_returnflag""",
)
def lay_compact_where(spark, sf):
    """Small files of one partition merged; per partition, whether its files are the same."""
    path = scratch_path(spark, "compact-where")
    lines = star_table(spark, sf, "lineitem")
    # Rows are dealt in turn by their places in the files, with no sort on either side.
    n = partitions_of(lines, 12, _SMALL_FILE_BYTES)
    turn = (F.pmod(F.xxhash64("_metadata.file_path"), F.lit(n)) + F.col("_metadata.row_index")) % n
    with open_folders(spark, 16):
        lines.repartitionById(n, turn.cast("int")).write.partitionBy("l_returnflag").parquet(path)
    flag = F.regexp_extract("file_path", "l_returnflag=([^/]*)", 1).alias("l_returnflag")
    file_stats(spark.read.parquet(path)).select("file_path", flag).write.parquet(f"{path}-before")
    compact_files(spark, path, "l_returnflag = 'R'")
    before = spark.read.parquet(f"{path}-before")
    after = file_stats(spark.read.parquet(path)).select("file_path", flag, F.lit(True).alias("there"))
    fates = (
        before.withColumn("was", F.lit(True))
        .join(after, ["file_path", "l_returnflag"], "full")
        .groupBy("l_returnflag")
        .agg(
            (F.count("*") == F.count(F.when(F.col("was") & F.col("there"), 1))).alias("files_kept"),
            (F.count("there") < F.count("was")).alias("fewer_files"),
        )
    )
    sums = (
        spark.read.parquet(path)
        .groupBy("l_returnflag")
        .agg(F.count("*").alias("lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"))
    )
    return sums.join(fates, "l_returnflag")


@query("lay_zorder", _LINES_SQL)
def lay_zorder(spark, sf):
    lines = star_table(spark, sf, "lineitem")
    return _lines(zorder(lines, ["l_shipdate", "l_partkey"]))


@query("lay_file_stats")
def lay_file_stats(spark, sf):
    path = scratch_path(spark, "stats")
    compact(star_table(spark, sf, "lineitem"), path, partition_by=["l_returnflag"])
    return layout_stats(spark.read.parquet(path))


_CLUSTERED = ("l_shipdate", "l_partkey")


@query(
    "lay_cluster_depth",
    """SELECT unnest(['l_shipdate', 'l_partkey']) AS column_name, true AS all_overlap_before,
              true AS less_after, true AS as_compared_pairwise""",
)
def lay_cluster_depth(spark, sf):
    """Overlap of files before and after clustering; the sweep against a comparison of all pairs."""
    path = scratch_path(spark, "depth")
    lines = star_table(spark, sf, "lineitem").select(*_CLUSTERED)
    lines.repartition(16).write.parquet(f"{path}/before")
    zorder(lines, list(_CLUSTERED), partitions=16).write.parquet(f"{path}/after")
    before, after = (spark.read.parquet(f"{path}/{t}") for t in ("before", "after"))

    def pairwise(df):
        """The mean overlap by definition, over the list of files."""
        parts = []
        for c in _CLUSTERED:
            bounds = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
            other = bounds.select(F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
            met = bounds.join(other, (F.col("lo") <= F.col("hi2")) & (F.col("lo2") <= F.col("hi")))
            parts.append(met.agg(F.lit(c).alias("column_name"), (F.count("*") / F.count_distinct("f")).alias("pairwise")))
        return parts[0].unionByName(parts[1])

    was = cluster_depth(before, _CLUSTERED)
    now = cluster_depth(after, _CLUSTERED).withColumnsRenamed({"avg_overlap": "now", "max_depth": "now_depth"}).drop("num_files")
    return (
        was.join(now, "column_name")
        .join(pairwise(after), "column_name")
        .select(
            "column_name",
            ((F.col("avg_overlap") == F.col("num_files")) & (F.col("max_depth") == F.col("num_files"))).alias("all_overlap_before"),
            ((F.col("now") < F.col("avg_overlap")) & (F.col("now_depth") < F.col("max_depth"))).alias("less_after"),
            (F.abs(F.col("now") - F.col("pairwise")) < 1e-9).alias("as_compared_pairwise"),
        )
    )


@query(
    "brz_mixed_tree",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'parquet' WHEN 'O' THEN 'csv' ELSE 'json' END AS source_format,
              count(*) AS rows, true AS has_file_time, max(o_orderkey) AS last_key FROM orders GROUP BY 1""",
)
def brz_mixed_tree(spark, sf):
    """Rows of a mixed folder with their files, counted by format."""
    audited = with_audit(read_tree(spark, _mixed_tree(spark, sf), lineage=True))
    return audited.groupBy(F.regexp_extract("_source_file", r"\.([a-z]+)$", 1).alias("source_format")).agg(
        F.count("*").alias("rows"),
        F.bool_and(F.col("_source_modified_time").isNotNull()).alias("has_file_time"),
        F.max(F.col("o_orderkey").cast("bigint")).alias("last_key"),
    )


@query(
    "slv_quarantine",
    """WITH checked AS (
         SELECT *, concat_ws(';', CASE WHEN NOT coalesce(o_totalprice > 50000, false) THEN 'large' END,
                             CASE WHEN NOT coalesce(o_orderstatus <> 'P', false) THEN 'settled' END,
                             CASE WHEN NOT coalesce(o_custkey % 97 <> 0, false) THEN 'customer' END) AS broken FROM orders)
       SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CASE WHEN broken = '' THEN 'accepted' ELSE 'quarantined' END AS side,
              CASE WHEN broken <> '' THEN broken END AS errors FROM checked""",
)
def slv_quarantine(spark, sf):
    """Orders written under three constraints, in two halves; both sides are returned."""
    path = scratch_path(spark, "quarantine")
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rules = {"large": "o_totalprice > 50000", "settled": F.col("o_orderstatus") != "P", "customer": "o_custkey % 97 <> 0"}
    early = F.col("o_orderkey") % 2 == 0
    write_checked(orders.where(early), path, rules)
    write_checked(orders.where(~early), path, rules, mode="append")
    good = accepted(spark, path).select("*", F.lit("accepted").alias("side"), F.lit(None).cast("string").alias("errors"))
    bad = quarantined(spark, path).select(*orders.columns, F.lit("quarantined").alias("side"), F.col("_validation_errors").alias("errors"))
    return good.unionByName(bad)
