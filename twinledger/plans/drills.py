"""The end-to-end runs, put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.operators.store import create_store
from twinledger.session import scratch_dir
from twinledger.sources.topics import publish, subscribe, topic_path
from twinledger.streaming.loads import drain, load_cloud, load_legacy
from twinledger.streaming.telemetry import log_parity


@dataclass(frozen=True)
class DrillTables:
    """Where a drill left its tables."""

    topic: str
    legacy: str
    cloud: str
    dead_letters: str
    parity_log: str


def drill_tables(root: str) -> DrillTables:
    return DrillTables(
        topic_path(root),
        f"{root}/legacy",
        f"{root}/cloud",
        f"{root}/dead_letters",
        f"{root}/parity_log",
    )


def slices_of(feed: DataFrame, cuts: list[int], seq: str = "ingest_seq") -> list[DataFrame]:
    """The feed between consecutive positions."""
    at = F.col(seq)
    return [feed.filter((at >= a) & (at < b)) for a, b in zip(cuts, cuts[1:])]


def dual_ingestion(
    spark: SparkSession, deliveries: list[DataFrame], outages: DataFrame, root: str | None = None
) -> DrillTables:
    """Publish deliveries one after another; after each, let both consumers catch up and audit.

    The two loads and the audit are three streaming queries over one topic. They take up at their
    checkpoints with each delivery, as they would after a restart.
    """
    root = root or scratch_dir(spark, "drill")
    at = drill_tables(root)
    create_store(spark, at.legacy)
    create_store(spark, at.cloud)
    for delivery in deliveries:
        publish(delivery, at.topic, spread=True)
        loads = [
            load_legacy(subscribe(spark, at.topic), at.legacy, f"{root}/checkpoints/legacy"),
            load_cloud(
                subscribe(spark, at.topic),
                at.cloud,
                at.dead_letters,
                outages,
                f"{root}/checkpoints/cloud",
            ),
        ]
        for query in loads:
            drain(query)
        drain(
            log_parity(
                subscribe(spark, at.topic),
                at.legacy,
                at.cloud,
                at.parity_log,
                f"{root}/checkpoints/audit",
            )
        )
    return at
