"""What became of each trade in both stores, and parity as the feed goes by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.numbers import notional
from twinledger.operators.intervals import flag_intervals
from twinledger.operators.ordering import scan_forward
from twinledger.operators.parity import audit_columns
from twinledger.schema import (
    FEED_DROPPED,
    OUTCOME_DROPPED,
    OUTCOME_DUPLICATE,
    OUTCOME_HALTED,
    OUTCOME_STORED,
)

HALT = "HALT"
PARTITION = "PARTITION"


def flag_outages(feed: DataFrame, outages: DataFrame, axis: str = "ingest_seq", **how) -> DataFrame:
    """Add ``halted`` and ``cut_off`` from the intervals of each kind."""
    halted = flag_intervals(feed, outages, HALT, "halted", axis, **how)
    return flag_intervals(halted, outages, PARTITION, "cut_off", axis, **how)


def reached_cloud() -> Column:
    return ~F.col("halted") & ~F.col("cut_off")


def _not_held(firsts: DataFrame, column: str, held: DataFrame | None) -> DataFrame:
    """Forget the first copy of ids that a store already holds."""
    if held is None:
        return firsts
    known = held.select("trade_id").distinct().withColumn("_held", F.lit(True))
    return firsts.join(known, "trade_id", "left").withColumn(
        column, F.when(F.col("_held").isNull(), F.col(column))
    ).drop("_held")


def outcome_ledger(
    flagged: DataFrame,
    seq: str = "ingest_seq",
    legacy: DataFrame | None = None,
    cloud: DataFrame | None = None,
) -> DataFrame:
    """Add ``legacy_inserted``, ``cloud_inserted`` and ``cloud_status`` to a flagged feed.

    The legacy store takes the first copy of an id; the cloud store the first copy that reaches
    it, so a copy after an outage that swallowed the first is stored. ``legacy`` and ``cloud``
    are what the stores already hold, if anything.

    First copies are found by aggregating positions per id and joined back on the position,
    which is unique: an id with very many copies never gathers its rows in one task.
    """
    at = F.col(seq)
    firsts = flagged.groupBy("trade_id").agg(
        F.min(at).alias("_legacy_at"),
        F.min(F.when(reached_cloud(), at)).alias("_cloud_at"),
    )
    firsts = _not_held(firsts, "_legacy_at", legacy)
    firsts = _not_held(firsts, "_cloud_at", cloud)
    places = F.array_distinct(F.array_compact(F.array("_legacy_at", "_cloud_at")))
    marks = firsts.select(F.explode(places).alias(seq), "_legacy_at", "_cloud_at")

    joined = flagged.join(marks, seq, "left")
    in_cloud = F.coalesce(F.col("_cloud_at") == at, F.lit(False))
    return joined.select(
        *flagged.columns,
        F.coalesce(F.col("_legacy_at") == at, F.lit(False)).alias("legacy_inserted"),
        in_cloud.alias("cloud_inserted"),
        F.when(F.col("halted"), OUTCOME_HALTED)
        .when(F.col("cut_off"), OUTCOME_DROPPED)
        .when(in_cloud, OUTCOME_STORED)
        .otherwise(OUTCOME_DUPLICATE)
        .alias("cloud_status"),
    )


def feed_record(flagged: DataFrame) -> DataFrame:
    """A trade as the live feed shows it: always stored in legacy, stored or dropped in cloud."""
    return flagged.withColumns(
        {
            "legacy_status": F.lit(OUTCOME_STORED),
            "cloud_status": F.when(reached_cloud(), OUTCOME_STORED).otherwise(FEED_DROPPED),
        }
    )


def outcome_summary(ledger: DataFrame) -> DataFrame:
    """Trades per outcome."""
    return ledger.groupBy("cloud_status").agg(F.count("*").alias("trades"))


def parity_steps(ledger: DataFrame, every: int, seq: str = "ingest_seq") -> DataFrame:
    """What each run of ``every`` positions adds to either store."""
    kept_legacy, kept_cloud = F.col("legacy_inserted"), F.col("cloud_inserted")
    return ledger.groupBy(F.expr(f"`{seq}` div {every}").alias("step")).agg(
        F.max(seq).alias("_last"),
        F.count(F.when(kept_legacy, 1)).alias("_ln"),
        F.count(F.when(kept_cloud, 1)).alias("_cn"),
        F.coalesce(F.sum(F.when(kept_legacy, notional())), F.lit(0)).alias("_lv"),
        F.coalesce(F.sum(F.when(kept_cloud, notional())), F.lit(0)).alias("_cv"),
    )


def running_sums(steps: DataFrame, before: DataFrame | None = None, width: int | None = None) -> DataFrame:
    """Running counts and volumes after each step, on top of those of ``before``: the last row of an earlier run."""
    columns = {"legacy_count": "_ln", "cloud_count": "_cn", "legacy_volume": "_lv", "cloud_volume": "_cv"}
    if before is not None:
        # It stands in front of the first step, as a step of its own, since that one may go on.
        start = before.select(
            F.lit(-1).cast("long").alias("step"),
            F.lit(None).cast("long").alias("_last"),
            *[F.col(name).alias(part) for name, part in columns.items()],
        )
        steps = start.unionByName(steps)
    # Steps are counted from 0 here: the carried one takes that place.
    numbered = steps.withColumn("_at", F.col("step") + 1)
    running = scan_forward(numbered, "_at", sums={name: F.col(part) for name, part in columns.items()}, width=width)
    exact = [
        F.col(name).cast("decimal(36,2)" if name.endswith("volume") else "long").alias(name) for name in columns
    ]
    return running.filter("step >= 0").select("step", (F.col("_last") + 1).alias("processed"), *exact)


def running_parity(
    ledger: DataFrame, every: int, seq: str = "ingest_seq", width: int | None = None
) -> DataFrame:
    """The audit after every ``every`` trades and after the last one.

    Positions must count from 0 without gaps. Trades are first added up per checkpoint, so the
    running sums go over checkpoints and not over trades.
    """
    running = running_sums(parity_steps(ledger, every, seq), width=width)
    return running.select("processed", *audit_columns())
