"""Keyed trade stores on Parquet.

A store is a folder ``writer=<name>/batch_id=<n>/``. Each batch owns its folder, so a batch that
is tried again replaces its own rows and never sees them as duplicates. Every stream writes under
a name of its own, and a replay always takes a new number, so neither ever replaces another's rows.
A store has one active writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import notional
from twinledger.operators.ordering import keep_first
from twinledger.operators.validate import trade_is_valid
from twinledger.plans.joins import fits_broadcast
from twinledger.schema import STORE, STORE_TOTALS, TRADE_COLUMNS

_LAYOUT = ["writer", "batch_id"]

# Lets a lookup by id skip row groups; the filter is sized to the ids it holds.
_ID_BLOOM_FILTER = {
    "parquet.bloom.filter.enabled#trade_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def _create(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> None:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    empty = spark.range(0, 0, 1, 1).select(*columns)
    # Static, so that overwriting with nothing removes every partition whatever the session says.
    writer = empty.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(*_LAYOUT).parquet(path)


def totals_path(store: str) -> str:
    return f"{store.rstrip('/')}_totals"


def create_store(spark: SparkSession, path: str) -> None:
    """Make the store if it is not there."""
    _create(spark, path, STORE, "ignore")
    _create(spark, totals_path(path), STORE_TOTALS, "ignore")


def reset_store(spark: SparkSession, path: str) -> None:
    """Empty the store and forget its totals."""
    _create(spark, path, STORE, "overwrite")
    _create(spark, totals_path(path), STORE_TOTALS, "overwrite")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Always with the stated schema, so that an empty store reads as one."""
    return spark.read.schema(STORE).parquet(path)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """What each batch added; small next to the store itself."""
    return spark.read.schema(STORE_TOTALS).parquet(totals_path(path))


def heal_totals(spark: SparkSession, path: str) -> None:
    """Write the totals of batches that have rows but no totals, as a crash between the two leaves
    them. For a writer to call when it starts; it reads price and quantity of the store."""
    known = read_totals(spark, path).select(*_LAYOUT).distinct()
    lacking = read_store(spark, path).join(known, _LAYOUT, "left_anti")
    totals = lacking.groupBy(*_LAYOUT).agg(
        F.count("*").alias("trade_count"),
        F.sum(notional()).cast("decimal(36,2)").alias("volume"),
    )
    totals.write.mode("append").partitionBy(*_LAYOUT).parquet(totals_path(path))


def next_batch_id(spark: SparkSession, path: str, writer: str) -> int:
    """A batch number that ``writer`` has never used in this store. Looked up in the rows and the
    totals, so that a batch that was cut off between the two counts as used."""
    create_store(spark, path)
    ids = read_store(spark, path).select("writer", "batch_id").union(
        read_totals(spark, path).select("writer", "batch_id")
    )
    last = ids.filter(F.col("writer") == writer).agg(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1


def find_by_id(store: DataFrame, trade_id: str) -> DataFrame:
    """A lookup whose predicate reaches the Parquet scan."""
    return store.filter(F.col("trade_id") == trade_id)


def storable(trades: DataFrame) -> DataFrame:
    """Rows that meet the store's own checks: nothing missing, price and quantity positive."""
    return trades.filter(trade_is_valid())


def first_copies(batch: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """The first copy of each id, in the stated order if there is one."""
    return keep_first(batch, "trade_id", order_by) if order_by else batch.dropDuplicates(["trade_id"])


def not_held(firsts: DataFrame, store: DataFrame) -> DataFrame:
    """Trades whose ids the store lacks. Ids are unique on both sides, so no key is frequent."""
    return firsts.join(store.select("trade_id"), "trade_id", "left_anti")


def not_held_small(firsts: DataFrame, store: DataFrame) -> DataFrame:
    """The same for a batch that may be small next to the store, and is cheap to read twice.

    If its ids fit a broadcast they first narrow the store's ids, so the store is scanned but not
    shuffled.
    """
    ids = firsts.select("trade_id")
    if fits_broadcast(ids):
        store = store.select("trade_id").join(F.broadcast(ids), "trade_id", "left_semi")
    return not_held(firsts, store)


def append_idempotent(
    trades: DataFrame,
    store: str,
    writer: str,
    batch_id: int,
    order_by: list[str] | None = None,
    bulk: bool = False,
) -> int:
    """Add the trades whose ids are new and return how many were added.

    The first copy in ``order_by`` wins within a batch; without it the copies are taken to be
    equal. Rows that fail the store's checks are left out. A batch is held on the executors while
    its size is looked at; a ``bulk`` load is not, and goes straight to a join that shuffles both
    sides. What the batch added is also kept as one row of totals, measured during the write.
    """
    spark = trades.sparkSession
    create_store(spark, store)
    own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    others = read_store(spark, store).filter(~own)

    firsts = first_copies(storable(trades), order_by).select(*TRADE_COLUMNS)
    if bulk:
        return _write_batch(not_held(firsts, others), store, writer, batch_id)
    firsts = firsts.persist()
    try:
        return _write_batch(not_held_small(firsts, others), store, writer, batch_id)
    finally:
        firsts.unpersist()


def append_new(trades: DataFrame, store: str, writer: str, batch_id: int) -> int:
    """Add trades whose ids are known to be new and unique, without a look at the store."""
    create_store(trades.sparkSession, store)
    return _write_batch(trades.select(*TRADE_COLUMNS), store, writer, batch_id)


def _write_batch(new: DataFrame, store: str, writer: str, batch_id: int) -> int:
    added = Observation()
    rows = new.withColumn("created_at", F.current_timestamp()).observe(
        added,
        F.count(F.lit(1)).alias("trade_count"),
        F.coalesce(F.sum(notional()), F.lit(0)).cast("decimal(36,2)").alias("volume"),
    )
    folder = f"writer={writer}/batch_id={batch_id}"
    writer_of_rows = rows.write.mode("overwrite").options(**_ID_BLOOM_FILTER)
    writer_of_rows.parquet(f"{store}/{folder}")

    measured = added.get
    totals = new.sparkSession.range(0, 1, 1, 1).select(
        F.lit(measured["trade_count"]).cast("long").alias("trade_count"),
        F.lit(measured["volume"]).cast("decimal(36,2)").alias("volume"),
    )
    totals.write.mode("overwrite").parquet(f"{totals_path(store)}/{folder}")
    return measured["trade_count"]
