"""Parity between the two stores: totals, audit, consistency, missing ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.numbers import clamp, notional
from twinledger.schema import STATUS_DRIFT, STATUS_IN_PARITY


def store_totals(store: DataFrame) -> DataFrame:
    """Number of trades and total notional of a store; an empty store has volume 0."""
    return store.agg(
        F.count("*").alias("trade_count"),
        F.coalesce(F.sum(notional()), F.lit(0)).alias("volume"),
    )


def store_ids(store: DataFrame) -> DataFrame:
    return store.select("trade_id").distinct()


def _side_by_side(legacy: DataFrame, cloud: DataFrame, n: Column, v: Column) -> DataFrame:
    """Both stores in one aggregate: each row adds to the columns of its own side."""
    both = legacy.select(F.lit(True).alias("_legacy"), n.alias("_n"), v.alias("_v")).unionByName(
        cloud.select(F.lit(False).alias("_legacy"), n.alias("_n"), v.alias("_v"))
    )
    here, there = F.col("_legacy"), ~F.col("_legacy")
    total = {
        "legacy_count": F.sum(F.when(here, F.col("_n"))),
        "cloud_count": F.sum(F.when(there, F.col("_n"))),
        "legacy_volume": F.sum(F.when(here, F.col("_v"))),
        "cloud_volume": F.sum(F.when(there, F.col("_v"))),
    }
    return both.agg(*[F.coalesce(c, F.lit(0)).alias(name) for name, c in total.items()])


def audit_columns(count_only: bool = False) -> list[Column]:
    """The audit, from ``legacy_count``, ``cloud_count``, ``legacy_volume``, ``cloud_volume``.

    Parity means no difference in count and none in volume to four places. It does not look at
    ids: equal totals over different trades still count as parity, and a surplus in the cloud
    counts as drift.
    """
    drift = F.abs(F.col("legacy_count") - F.col("cloud_count"))
    difference = F.round(F.abs(F.col("legacy_volume") - F.col("cloud_volume")), 4)
    same = drift == 0 if count_only else (drift == 0) & (difference == 0)
    return [
        F.col("legacy_count"),
        F.col("cloud_count"),
        drift.alias("drift"),
        F.when(same, STATUS_IN_PARITY).otherwise(STATUS_DRIFT).alias("status"),
        F.round("legacy_volume", 2).cast("double").alias("legacy_volume"),
        F.round("cloud_volume", 2).cast("double").alias("cloud_volume"),
        difference.cast("double").alias("volume_difference"),
        # Constant by definition: the primary store holds every trade.
        F.lit(0.0).alias("data_loss_percentage"),
    ]


def parity_audit(legacy: DataFrame, cloud: DataFrame, count_only: bool = False) -> DataFrame:
    """One audit row from the two stores, reading price and quantity only."""
    sides = _side_by_side(legacy, cloud, F.lit(1), notional())
    return sides.select(*audit_columns(count_only))


def parity_from_totals(
    legacy: DataFrame, cloud: DataFrame, count_only: bool = False
) -> DataFrame:
    """The same audit from what each batch added, for audits on a short interval."""
    sides = _side_by_side(legacy, cloud, F.col("trade_count"), F.col("volume"))
    return sides.select(*audit_columns(count_only))


def consistency_pct(audit: DataFrame) -> DataFrame:
    """100 in parity, else the cloud's share of the legacy count, between 0 and 100."""
    share = 100.0 * F.col("cloud_count") / F.greatest(F.col("legacy_count"), F.lit(1))
    return audit.select(
        "legacy_count",
        "cloud_count",
        "status",
        F.when(F.col("status") == STATUS_IN_PARITY, F.lit(100.0))
        .otherwise(clamp(share, 0.0, 100.0))
        .alias("consistency_pct"),
    )


def missing_ids(legacy: DataFrame, cloud: DataFrame) -> DataFrame:
    """Ids in the legacy store that the cloud store lacks."""
    ids = legacy.select("trade_id").join(cloud.select("trade_id"), "trade_id", "left_anti")
    return ids.distinct()


def missing_ids_by_subtract(legacy: DataFrame, cloud: DataFrame) -> DataFrame:
    """The same as a set difference."""
    return legacy.select("trade_id").subtract(cloud.select("trade_id"))
