"""Sharding over fixed virtual slots.

A record's text is hashed into one of thousands of slots.  Bytes are summed for each
slot, and a versioned table maps slots to shards.  Rebalancing edits that table: it
moves as few slots as it needs to, and records follow their slot.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import staged
from stratiform.session import local_frame

SLOTS = 8192

# Ranks are counted in cells of a slot; a cell has about this many records.
CELL_ROWS = 50_000

# A slot with more than this share of a fair shard is split over several shards, text by
# text; so is, row by row, a text with more than that.
SPLIT_ABOVE = 1.25

MAP_SCHEMA = "version int, slot int, part int, parts int, shard int, bytes long, records long, text long"


@dataclass(frozen=True)
class SlotPart:
    """A slot, or one of the parts that a slot too large for a shard is split into.

    A text that is too large itself has parts of its own; the others share the rest.
    """

    slot: int
    part: int
    parts: int
    bytes: int
    records: int
    shard: int | None = None
    text: int | None = None  # the hash of the text that the part is of, if it is split

    @property
    def order(self) -> tuple[int, int, int, int]:
        return self.slot, self.part, self.text is not None, self.text or 0


def rebalance(parts: list[SlotPart], shards: int, slack: float = 0.02) -> list[SlotPart]:
    """Assign unassigned slots and move slots off shards that are too full.

    Slots without a shard, or on one that no longer exists, go to the emptiest shard,
    largest first.  Then the fullest shard hands slots to the emptiest one until it is
    within ``slack`` of a fair share, or no move would help.  All other slots stay.
    """
    load = [0] * shards
    own: list[list[SlotPart]] = [[] for _ in range(shards)]
    homeless = []
    for p in parts:
        if p.shard is not None and p.shard < shards:
            load[p.shard] += p.bytes
            own[p.shard].append(p)
        else:
            homeless.append(p)
    heap = [(b, i) for i, b in enumerate(load)]
    heapq.heapify(heap)
    for p in sorted(homeless, key=lambda p: (-p.bytes, *p.order)):
        b, i = heapq.heappop(heap)
        own[i].append(replace(p, shard=i))
        load[i] = b + p.bytes
        heapq.heappush(heap, (load[i], i))
    fair = sum(load) / shards
    while True:
        full, empty = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[empty]
        if load[full] <= fair * (1 + slack):
            break
        fitting = [p for p in own[full] if 0 < p.bytes < gap]
        if not fitting:
            break
        p = min(fitting, key=lambda p: (abs(gap / 2 - p.bytes), *p.order))
        own[full].remove(p)
        own[empty].append(replace(p, shard=empty))
        load[full] -= p.bytes
        load[empty] += p.bytes
    return sorted((p for s in own for p in s), key=lambda p: p.order)


def write_map(spark: SparkSession, path: str, version: int, parts: list[SlotPart]) -> None:
    """Store one version of the slot map; a version is written once and never changed."""
    rows = [(version, p.slot, p.part, p.parts, p.shard, p.bytes, p.records, p.text) for p in parts]
    local_frame(spark, rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/v{version}")


def read_map(spark: SparkSession, path: str, version: int) -> list[SlotPart]:
    """At most ``SLOTS`` rows and the parts of split slots, of which a shard has few."""
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v{version}").collect()
    return [SlotPart(r["slot"], r["part"], r["parts"], r["bytes"], r["records"], r["shard"], r["text"]) for r in rows]


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, text_hash): what sharding needs to know of a record.

    ``size`` is the bytes of the text (null: none) plus 8.  Equal texts share a slot.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.xxhash64(text).alias("text_hash"),
    )


def measure(records: DataFrame, shards: int) -> list[SlotPart]:
    """Bytes and records of every slot, with slots too large for a shard split.

    Three aggregates, whose results number at most ``SLOTS``, the texts too large for a
    shard and the parts of large slots.
    """
    totals = records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    fair = sum(r["b"] for r in totals) / shards
    large = {r["virtual_slot"]: r["b"] for r in totals if r["b"] > SPLIT_ABOVE * fair}
    parts = [SlotPart(r["virtual_slot"], 0, 1, r["b"], r["n"]) for r in totals if r["virtual_slot"] not in large]
    if large:
        hot = records.where(F.col("virtual_slot").isin(sorted(large)))
        by_text = hot.groupBy("virtual_slot", "text_hash").agg(F.sum("size").alias("b")).where(F.col("b") > SPLIT_ABOVE * fair)
        pieces = lambda size: -(-8 * size // max(1, int(fair)))
        split, rest = {}, dict(large)
        for r in by_text.collect():
            split[r["virtual_slot"], r["text_hash"]] = pieces(r["b"])
            rest[r["virtual_slot"]] -= r["b"]
        # What is left of a slot without its large texts may be small enough to stay whole.
        split |= {(slot, None): pieces(size) if size > SPLIT_ABOVE * fair else 1 for slot, size in rest.items()}
        dealt = parted(hot, split).groupBy("virtual_slot", "text", "part", "parts")
        for r in dealt.agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
            parts.append(SlotPart(r["virtual_slot"], r["part"], r["parts"], r["b"], r["n"], text=r["text"]))
    return parts


def parted(records: DataFrame, split: dict[tuple[int, int | None], int]) -> DataFrame:
    """Add ``text``, ``part`` and ``parts``: rows of a split text are dealt by id, other texts by hash.

    ``split`` has the parts by slot and text, with no text for the rest of a slot.
    """
    spark = records.sparkSession
    rests = local_frame(spark, [(slot, n) for (slot, text), n in split.items() if text is None], "virtual_slot int, _rest int")
    texts = local_frame(
        spark, [(slot, text, n) for (slot, text), n in split.items() if text is not None], "virtual_slot int, text_hash long, _own int"
    )
    by = F.when(F.col("_own").isNull(), F.xxhash64("text_hash", F.lit("part"))).otherwise(F.xxhash64("spread", F.lit("part")))
    return (
        records.join(F.broadcast(rests), "virtual_slot", "left")
        .join(F.broadcast(texts), ["virtual_slot", "text_hash"], "left")
        .withColumn("text", F.when(F.col("_own").isNotNull(), F.col("text_hash")))
        .withColumn("parts", F.coalesce("_own", "_rest", F.lit(1)))
        .withColumn("part", F.pmod(by, F.col("parts")).cast("int"))
        .drop("_own", "_rest")
    )


def place(records: DataFrame, parts: list[SlotPart]) -> DataFrame:
    """Add ``shard`` and ``slot``, the record's gapless place in its shard, from the map.

    Places count the records of earlier slots of the shard, of earlier cells of the
    slot and of smaller ids of the cell (null first), so that no task sees a whole
    shard.  Rows equal in id, size and text are interchangeable.  The map is broadcast:
    its rows are bounded by the number of slots.
    """
    spark = records.sparkSession
    before: dict[int, int] = {}
    rows = []
    for lot, p in enumerate(parts):
        base = before.get(p.shard, 0)
        before[p.shard] = base + p.records
        rows.append((lot, p.slot, p.text, p.part, p.shard, base, 1 + p.records // CELL_ROWS))
    table = local_frame(spark, rows, "lot int, slot_ int, text_ long, part_ int, shard int, base long, cells int")
    known = (
        parted(records, {(p.slot, p.text): p.parts for p in parts})
        .join(F.broadcast(table), F.expr("virtual_slot = slot_ and part = part_ and text <=> text_"))
        .withColumn("cell", F.pmod(F.xxhash64("spread"), F.col("cells")))
    )
    cells = known.groupBy("lot", "cell").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("lot").orderBy("cell")) - F.col("n")
    cells = cells.select("lot", "cell", earlier.alias("earlier"))
    order = Window.partitionBy("lot", "cell").orderBy("doc_id", "size", "text_crc32")
    return (
        known.withColumn("rank", F.row_number().over(order))
        .join(cells, ["lot", "cell"])
        .withColumn("slot", F.col("base") + F.col("earlier") + F.col("rank") - 1)
        .select(*(c for c in records.columns if c not in ("text_hash", "spread")), "shard", "slot")
    )


def shard_by_bytes(docs: DataFrame, shards: int, map_path: str, version: int = 1) -> DataFrame:
    """Deal ``docs(doc_id, text)`` to ``shards`` of nearly equal bytes.

    Stores the slot map as ``version`` under ``map_path``; a later version starts from
    the one before and moves only what balance asks for.  Equal texts share a shard,
    unless one text alone outgrows 1.25 fair ones: then its rows are split by ``doc_id``,
    and its rows only.  A null text counts as an empty one; an empty table gives no rows and an empty map.
    Columns other than ``doc_id`` and ``text`` are ignored.
    """
    # Rows without an id are told apart by a number, or one task would get them all.
    number = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    records = staged(slotted(docs).withColumn("spread", F.xxhash64(F.col("doc_id"), number)), "slots")
    parts = measure(records, shards)
    if version > 1:
        earlier = {(p.slot, p.text, p.part, p.parts): p.shard for p in read_map(docs.sparkSession, map_path, version - 1)}
        parts = [replace(p, shard=earlier.get((p.slot, p.text, p.part, p.parts))) for p in parts]
    parts = rebalance(parts, shards)
    write_map(docs.sparkSession, map_path, version, parts)
    return place(records, parts)
