"""Replay of what the cloud store missed, and the proofs around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.operators.ordering import keep_first
from twinledger.operators.parity import missing_ids, parity_audit
from twinledger.operators.store import append_idempotent, next_batch_id, read_store
from twinledger.operators.validate import rejected, split_checked, with_trade_reasons
from twinledger.schema import ACKNOWLEDGEMENTS, DEAD_LETTERS, TRADE_COLUMNS
from twinledger.session import materialize


def replay_candidates(
    backlog: DataFrame, missing: DataFrame, order_by: list[str] | None = None
) -> DataFrame:
    """The first copy in the backlog of each missing id.

    Copies are thinned out first: that does not change which copy is replayed, and an id with
    very many copies is down to one row before the join.
    """
    first = keep_first(backlog, "trade_id", order_by) if order_by else backlog.dropDuplicates(["trade_id"])
    return first.join(missing.select("trade_id"), "trade_id", "left_semi")


def reconcile(
    spark: SparkSession,
    legacy_path: str,
    cloud_path: str,
    backlog: DataFrame,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Replay missing trades from ``backlog`` into the cloud store; one summary row.

    The replay writes to the store whatever an outage switch says. It always writes a new batch and
    only what the store lacks, so it may be repeated or tried again at any time.
    """
    legacy, cloud = read_store(spark, legacy_path), read_store(spark, cloud_path)
    missing = materialize(missing_ids(legacy, cloud), "missing_ids")
    initially_missing = missing.count()
    candidates = replay_candidates(backlog, missing, order_by).select(*TRADE_COLUMNS)
    batch_id = next_batch_id(spark, cloud_path, "replay")
    replayed = append_idempotent(candidates, cloud_path, "replay", batch_id)
    audit = parity_audit(read_store(spark, legacy_path), read_store(spark, cloud_path))
    return audit.select(
        F.lit(replayed).cast("long").alias("replayed_count"),
        F.lit(initially_missing).cast("long").alias("initial_missing_count"),
        F.col("status").alias("final_status"),
        F.col("drift").alias("final_drift"),
        F.struct(*audit.columns).alias("final_audit"),
    )


def acknowledgements_path(dead_letters: str) -> str:
    return f"{dead_letters.rstrip('/')}_acks"


def _create_acknowledgements(spark: SparkSession, dead_letters: str) -> None:
    empty = spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ACKNOWLEDGEMENTS.fields])
    empty.write.mode("ignore").parquet(acknowledgements_path(dead_letters))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """What outages dropped and no replay has acknowledged, in order of arrival, copies included."""
    _create_acknowledgements(spark, path)
    letters = spark.read.schema(DEAD_LETTERS).parquet(path)
    acknowledged = spark.read.schema(ACKNOWLEDGEMENTS).parquet(acknowledgements_path(path))
    # A letter is a feed row; its position and id name it, so no key is frequent. An id may be missing.
    same = (letters.ingest_seq == acknowledged.ingest_seq) & letters.trade_id.eqNullSafe(acknowledged.trade_id)
    return letters.join(acknowledged, same, "left_anti").select(*DEAD_LETTERS.fieldNames())


def refused_letters(spark: SparkSession, path: str) -> DataFrame:
    """Letters, acknowledged or not, that no store takes as they break a rule, with ``reject_reasons``."""
    return rejected(with_trade_reasons(spark.read.schema(DEAD_LETTERS).parquet(path)))


def acknowledge(letters: DataFrame, path: str) -> None:
    """Note that some letters are done with. Noting one twice changes nothing."""
    letters.select(*ACKNOWLEDGEMENTS.fieldNames()).write.mode("append").parquet(acknowledgements_path(path))


def replay_dead_letters(
    spark: SparkSession, legacy_path: str, cloud_path: str, dead_letters: str
) -> DataFrame:
    """Reconcile from the open dead letters, then acknowledge those whose ids the cloud store holds, and those that
    break a rule: no store ever takes them, and ``refused_letters`` has them. They are no first copy of their id either.

    Only letters that were there at the start are claimed: one that a running load adds meanwhile stays open, as
    does one whose id the primary store lacks as yet. A failure before the acknowledgement repeats the
    replay, which adds nothing twice. Trades that came while the consumer was halted are not among the letters.
    """
    claimed = materialize(read_dead_letters(spark, dead_letters), "claimed_letters")
    good, refused = split_checked(with_trade_reasons(claimed))
    done = materialize(reconcile(spark, legacy_path, cloud_path, good, ["ingest_seq"]), "replay")
    held = read_store(spark, cloud_path).select("trade_id")
    settled = good.join(held, "trade_id", "left_semi").select(*DEAD_LETTERS.fieldNames())
    acknowledge(settled.unionByName(refused.select(*DEAD_LETTERS.fieldNames())), dead_letters)
    return done


def failback_proof(feed: DataFrame, legacy: DataFrame, cloud: DataFrame) -> DataFrame:
    """After a failback: the primary holds every trade of the feed, and the shadow holds nothing
    the primary lacks."""
    distinct_ids = feed.select("trade_id").distinct()

    def count_of(ids: DataFrame, name: str) -> DataFrame:
        return ids.select(F.lit(name).alias("_what"))

    what = (
        count_of(distinct_ids, "feed")
        .unionByName(count_of(legacy, "primary"))
        .unionByName(count_of(cloud, "shadow"))
        .unionByName(count_of(missing_ids(distinct_ids, legacy), "lost"))
        .unionByName(count_of(missing_ids(legacy, cloud), "behind"))
        .unionByName(count_of(missing_ids(cloud, legacy), "stray"))
    )

    def n(name: str):
        return F.count(F.when(F.col("_what") == name, 1))

    return what.agg(
        n("feed").alias("feed_trades"),
        n("primary").alias("primary_trades"),
        n("shadow").alias("shadow_trades"),
        n("lost").alias("lost_trades"),
        n("behind").alias("shadow_behind"),
        n("stray").alias("shadow_only"),
    ).withColumn(
        "zero_loss",
        (F.col("lost_trades") == 0)
        & (F.col("shadow_only") == 0)
        & (F.col("primary_trades") == F.col("feed_trades")),
    )
