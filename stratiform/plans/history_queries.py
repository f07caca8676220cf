"""Changes between snapshots, type-2 history, and access rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.operators.access import mask_columns, row_filter
from stratiform.operators.merge import scd2, snapshot_diff
from stratiform.plans.registry import dbl, query
from stratiform.session import reliable_checkpoint
from stratiform.sources import star_table


def _old_customers(spark, sf):
    """Customers before a change: some not there yet, some in another segment."""
    customers = star_table(spark, sf, "customer")
    return customers.where(F.col("c_mktsegment") != "BUILDING").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_acctbal") < 0, "DORMANT")
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )


def _new_customers(spark, sf):
    customers = star_table(spark, sf, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return customers.select("c_custkey", "c_nationkey", "c_mktsegment")


_VERSIONS = """old AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN 'DORMANT' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
new AS (
  SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY')"""


@query(
    "slv_snapshot_diff",
    f"""WITH {_VERSIONS}
        SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
               CAST(coalesce(n.c_nationkey, o.c_nationkey) AS BIGINT) AS c_nationkey,
               coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment,
               CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete'
                    ELSE 'update' END AS change_type
        FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey
        WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_mktsegment <> n.c_mktsegment""",
)
def slv_snapshot_diff(spark, sf):
    return snapshot_diff(_old_customers(spark, sf), _new_customers(spark, sf), ["c_custkey"])


@query(
    "slv_scd2",
    f"""WITH {_VERSIONS}, changed AS (
          SELECT o.*, o.c_mktsegment <> n.c_mktsegment AS differs
          FROM old o LEFT JOIN new n ON o.c_custkey = n.c_custkey)
        SELECT c_custkey, c_mktsegment, '2020-01-01' AS valid_from,
               CASE WHEN coalesce(differs, false) THEN '2024-01-01' END AS valid_to,
               NOT coalesce(differs, false) AS is_current FROM changed
        UNION ALL
        SELECT c_custkey, c_mktsegment, '2024-01-01', NULL, true FROM new
        WHERE c_custkey NOT IN (SELECT c_custkey FROM changed WHERE NOT coalesce(differs, false))
        UNION ALL
        SELECT c_custkey, 'FIRST', '2019-01-01', '2020-01-01', false FROM old""",
)
def slv_scd2(spark, sf):
    old = _old_customers(spark, sf)

    def version(segment, start, end, current):
        return old.select(
            "c_custkey",
            segment.alias("c_mktsegment"),
            F.to_date(F.lit(start)).alias("valid_from"),
            F.to_date(F.lit(end)).alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    history = version(F.lit("FIRST"), "2019-01-01", "2020-01-01", False).unionByName(
        version(F.col("c_mktsegment"), "2020-01-01", None, True)
    )
    return scd2(
        history,
        _new_customers(spark, sf),
        ["c_custkey"],
        ["c_mktsegment"],
        F.to_date(F.lit("2024-01-01")),
    )


_SNAPSHOTS = ("2024-01-01", "2024-02-01", "2024-03-01")

# The segment of each customer in each month: some change once or twice, some come late,
# some miss a month.
_MONTHS = """months AS (
  SELECT c_custkey, day,
         CASE WHEN c_custkey % 3 = 0 AND day >= '2024-02-01' THEN 'MOVED' ELSE c_mktsegment END
           || CASE WHEN c_custkey % 5 = 0 AND day >= '2024-03-01' THEN '+' ELSE '' END AS c_mktsegment
  FROM customer, (VALUES ('2024-01-01'), ('2024-02-01'), ('2024-03-01')) AS days(day)
  WHERE NOT (c_custkey % 7 = 0 AND day < '2024-02-01') AND NOT (c_custkey % 11 = 0 AND day = '2024-02-01'))"""


@query(
    "slv_scd2_snapshots",
    f"""WITH {_MONTHS},
        changes AS (
          SELECT *, coalesce(lag(c_mktsegment) OVER (PARTITION BY c_custkey ORDER BY day) <> c_mktsegment, true) AS opens
          FROM months)
        SELECT c_custkey, c_mktsegment, day AS valid_from,
               lead(day) OVER (PARTITION BY c_custkey ORDER BY day) AS valid_to,
               lead(day) OVER (PARTITION BY c_custkey ORDER BY day) IS NULL AS is_current
        FROM changes WHERE opens""",
)
def slv_scd2_snapshots(spark, sf):
    """Three monthly snapshots folded into one history, starting from an empty one."""
    customers = star_table(spark, sf, "customer")
    key = F.col("c_custkey")
    history = customers.limit(0).select(
        "c_custkey",
        "c_mktsegment",
        *(F.lit(None).cast("date").alias(c) for c in ("valid_from", "valid_to")),
        F.lit(True).alias("is_current"),
    )
    for month, day in enumerate(_SNAPSHOTS):
        segment = F.concat(
            F.when((key % 3 == 0) & F.lit(month >= 1), "MOVED").otherwise(F.col("c_mktsegment")),
            F.when((key % 5 == 0) & F.lit(month >= 2), "+").otherwise(""),
        )
        there = ~((key % 7 == 0) & F.lit(month < 1)) & ~((key % 11 == 0) & F.lit(month == 1))
        snapshot = customers.where(there).select("c_custkey", segment.alias("c_mktsegment"))
        # Kept, so that the next step does not compute all earlier ones again.
        history = reliable_checkpoint(
            scd2(history, snapshot, ["c_custkey"], ["c_mktsegment"], F.to_date(F.lit(day)))
        )
    return history


@query(
    "sec_masked_region",
    f"""SELECT c_custkey, 'REDACTED' AS c_name, {dbl("c_acctbal")} AS c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def sec_masked_region(spark, sf):
    """What a reader sees who may read one region and no names."""
    nation, region = star_table(spark, sf, "nation"), star_table(spark, sf, "region")
    allowed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(
        F.col("r_name") == "ASIA"
    )
    customers = star_table(spark, sf, "customer")
    visible = row_filter(customers, "c_nationkey", allowed, True, "n_nationkey")
    return mask_columns(visible, ["c_name"], may_read=False).select(
        "c_custkey", "c_name", "c_acctbal"
    )
