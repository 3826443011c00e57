"""Sharding by fixed virtual slots.

Records are hashed into some thousands of slots, which never change. A versioned map says which
shard holds each slot. It is made from the bytes per slot, and rebalancing edits it: a new version
moves as few slots as will even the shards out, and every other record stays where it is.

Everything is DataFrame work. The map has one row per slot, a fixed number, so it is broadcast
and its one ordered pass runs in one task; records are aggregated before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinledger.llm.common import utf8
from twinledger.session import scratch_dir

SLOTS = 4096
SHARDS = 24
RECORD_OVERHEAD = 8


def record_columns(doc_id: Column, text: Column, slots: int = SLOTS) -> dict[str, Column]:
    """Size, CRC and slot of a record. NULL text has no bytes; a NULL id is hashed by its text."""
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("long")
    crc = F.crc32(utf8(text))
    return {
        "size": size,
        "text_crc32": crc,
        "virtual_slot": F.pmod(F.xxhash64(doc_id, size, crc), F.lit(slots)).cast("int"),
    }


def slot_weights(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and records of every slot, empty ones included."""
    found = records.groupBy("virtual_slot").agg(
        F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows")
    )
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(found), "virtual_slot", "left").na.fill(0)


def _fill(loose: DataFrame, loads: Column, version: Column) -> DataFrame:
    """Give loose slots, largest first, each to the shard that has least so far.

    ``loose`` has ``virtual_slot`` and ``slot_bytes``; ``loads`` is an array with the bytes that each
    shard already has. One row of at most ``SLOTS`` elements is folded over.
    """
    order = F.sort_array(
        F.collect_list(F.struct((-F.col("slot_bytes")).alias("less"), F.col("virtual_slot")))
    )

    def give(done: Column, slot: Column) -> Column:
        least = F.array_position(done["loads"], F.array_min(done["loads"]))
        # One byte more for each slot, so that empty slots are spread as well.
        more = F.lit(1) - slot["less"]
        return F.struct(
            F.transform(done["loads"], lambda v, i: F.when(i + 1 == least, v + more).otherwise(v)).alias("loads"),
            F.array_append(done["picks"], least.cast("int") - 1).alias("picks"),
        )

    one = loose.agg(order.alias("order"), F.first(version).alias("version"), F.first(loads).alias("loads"))
    start = F.struct(F.col("loads"), F.expr("cast(array() as array<int>)").alias("picks"))
    dealt = one.select("version", "order", F.reduce("order", start, give)["picks"].alias("picks"))
    pairs = F.arrays_zip(F.col("order.virtual_slot").alias("virtual_slot"), F.col("picks").alias("shard"))
    return dealt.select("version", F.explode(pairs).alias("s")).select("version", "s.virtual_slot", "s.shard")


def first_map(weights: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: ``version``, ``virtual_slot``, ``shard``."""
    return _fill(weights, F.array_repeat(F.lit(0).cast("long"), shards), F.lit(1))


def rebalance(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version, for changed weights or more shards.

    A shard keeps its slots, largest first, up to an even share; what goes beyond, or belongs to a
    shard that is no more, is dealt out again. All other slots stay where they are.
    """
    held = slot_map.join(weights, "virtual_slot")
    total = weights.agg(F.sum(F.col("slot_bytes") + 1).alias("total"))
    so_far = Window.partitionBy("shard").orderBy(F.desc("slot_bytes"), "virtual_slot").rowsBetween(
        Window.unboundedPreceding, 0
    )
    marked = (
        held.crossJoin(F.broadcast(total))  # one row
        .withColumn("running", F.sum(F.col("slot_bytes") + 1).over(so_far))
        .withColumn("keep", (F.col("shard") < shards) & (F.col("running") <= F.col("total") / shards))
        .withColumn("next", F.col("version") + 1)
    )
    kept = marked.filter("keep")
    per_shard = kept.groupBy("shard").agg(F.sum(F.col("slot_bytes") + 1).alias("load"))
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(per_shard, "shard", "left").na.fill(0).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", "load"))), lambda x: x["load"]).alias("loads")
    )
    loose = marked.filter(~F.col("keep")).crossJoin(F.broadcast(loads))  # one row
    moved = _fill(loose.select("virtual_slot", "slot_bytes", "next", "loads"), F.col("loads"), F.col("next"))
    return kept.select(F.col("next").alias("version"), "virtual_slot", "shard").unionByName(moved)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored map. A version that is saved again replaces itself."""
    slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "version"
    ).parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest if none is named."""
    stored = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version)


def place(records: DataFrame, slot_map: DataFrame, weights: DataFrame, tie_break: list[str]) -> DataFrame:
    """Add ``shard`` and ``slot``, the record's place in its shard, without gaps from 0.

    A record's place is what the virtual slots before its own hold in the shard, plus its rank in
    its own; no task sorts a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(weights, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("virtual_slot").orderBy(*tie_break)
    return (
        records.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(starts), "virtual_slot")  # SLOTS rows
        .withColumn("slot", (F.col("_start") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "_start")
    )


def shard_records(records: DataFrame, tie_break: list[str], shards: int = SHARDS, path: str | None = None) -> DataFrame:
    """Weigh the slots, store the first map and place every record by it."""
    spark = records.sparkSession
    path = path or scratch_dir(spark, "slot_map")
    weights = slot_weights(records)
    save_map(first_map(weights, shards), path)
    return place(records, load_map(spark, path), weights, tie_break)
