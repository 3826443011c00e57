"""State carried from batch to batch as a small table, so that a batch reads new rows only.

Batch n starts from what batch n-1 left in ``state/slot=<0|1>`` and leaves its own in the other slot; a batch that is
tried again starts from the same state, and there are never more than two. What a batch gives out is in
``<table>/batch_id=<n>``, written before the state. A path belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinledger.operators.controls import as_events, control_state, latest_state
from twinledger.operators.outcomes import parity_steps, running_sums
from twinledger.operators.parity import audit_columns
from twinledger.operators.reporting import throughput
from twinledger.streaming.loads import start

#: New rows and the state before them, to the tables of the batch; one of them is ``state``.
Fold = Callable[[DataFrame, DataFrame | None], dict[str, DataFrame]]


def _slot(path: str, batch_id: int) -> str:
    return f"{path}/state/slot={batch_id % 2}"


def carry(stream: DataFrame, path: str, checkpoint: str, fold: Fold, every: str | None = None) -> StreamingQuery:
    """Fold every micro-batch of ``stream`` into the tables below ``path``."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        before = None
        if batch_id:
            before = batch.sparkSession.read.parquet(_slot(path, batch_id - 1)).filter(F.col("at") == batch_id - 1).drop("at")
            if before.isEmpty():
                raise ValueError(f"the state in {path} is of another checkpoint")
        batch = batch.persist()
        try:
            tables = fold(batch, before)
            for name, rows in tables.items():
                if name != "state":
                    rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            state = tables["state"].withColumn("at", F.lit(batch_id).cast("long"))
            state.coalesce(1).write.mode("overwrite").parquet(_slot(path, batch_id))
        finally:
            batch.unpersist()

    return start(stream, each_batch, checkpoint, every)


def last_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of the last batch that was finished, with its number in ``at``."""
    both = spark.read.parquet(f"{path}/state").drop("slot")
    newest = both.agg(F.max("at").alias("at"))  # one row
    return both.join(F.broadcast(newest), "at", "left_semi")


def finished(spark: SparkSession, path: str, name: str) -> DataFrame:
    """What the finished batches gave out as ``name``, with ``batch_id``."""
    last = last_state(spark, path).agg(F.max("at").alias("_at"))  # one row
    rows = spark.read.parquet(f"{path}/{name}")
    return rows.crossJoin(F.broadcast(last)).filter(F.col("batch_id") <= F.col("_at")).drop("_at")


# --- Control state ------------------------------------------------------------------------------


def _fold_controls(batch: DataFrame, before: DataFrame | None) -> dict[str, DataFrame]:
    new = batch.dropDuplicates(["seq"])
    if before is not None:
        new = new.crossJoin(F.broadcast(before.select(F.col("seq").alias("_done")))).filter(F.col("seq") > F.col("_done")).drop("_done")
    first = new.agg(F.min("seq")).first()[0]
    if first is None:
        nothing = before if before is not None else control_state(new)
        return {"states": nothing.limit(0), "state": nothing}
    log = new.select("seq", "action", "rate")
    if before is not None:
        log = log.unionByName(as_events(before, first))
    states = control_state(log).filter(F.col("seq") >= first)
    return {"states": states, "state": latest_state(states)}


def log_controls(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """State after each control event, as ``controls.control_state`` gives it, from new events and the last state.

    Events come in the order of ``seq``; one at or below the last ``seq`` is a copy of an event that was folded.
    """
    return carry(stream, path, checkpoint, _fold_controls, every)


def control_states(spark: SparkSession, path: str) -> DataFrame:
    return finished(spark, path, "states").drop("batch_id")


# --- Running parity -----------------------------------------------------------------------------


def log_running_parity(stream: DataFrame, every_trades: int, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The audit after every ``every_trades`` trades, from a stream of outcomes and the last running sums.

    ``ingest_seq`` counts from 0 without gaps. A position below the last one is a copy; a missing one fails the batch.
    """

    def fold(batch: DataFrame, before: DataFrame | None) -> dict[str, DataFrame]:
        done = before.first().processed if before is not None else 0
        new = batch.filter(F.col("ingest_seq") >= done).dropDuplicates(["ingest_seq"])
        rows, last = new.agg(F.count("*"), F.max("ingest_seq")).first()
        if rows and last + 1 != done + rows:
            raise ValueError(f"positions {done} to {last} have {rows} rows")
        running = running_sums(parity_steps(new, every_trades), before)
        kept = running if before is None else running.unionByName(before)
        return {"steps": running, "state": kept.orderBy(F.desc("processed")).limit(1)}

    return carry(stream, path, checkpoint, fold, every)


def running_parity_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The audits; a step that a later batch went on with counts as that batch left it."""
    steps = finished(spark, path, "steps")
    values = F.struct(*[c for c in steps.columns if c not in ("step", "batch_id")])
    latest = steps.groupBy("step").agg(F.max_by(values, "processed").alias("_v")).select("_v.*")
    return latest.select("processed", *audit_columns())


# --- Throughput ---------------------------------------------------------------------------------


def log_windows(
    stream: DataFrame, path: str, checkpoint: str, bucket: str = "1 second", late_by: str = "1 minute", every: str | None = None
) -> StreamingQuery:
    """Trades per bucket, with buckets that close.

    The watermark is the newest time of the batches before, less ``late_by``. A bucket that ends at or before it
    is closed: written once and out of the state. Trades of closed buckets are counted apart, as late. The
    state holds the open buckets only. Trades without a time are in no bucket.
    """
    wait = F.expr(f"INTERVAL {late_by}")
    end = F.col("bucket_start") + F.expr(f"INTERVAL {bucket}")

    def fold(batch: DataFrame, before: DataFrame | None) -> dict[str, DataFrame]:
        seen = batch.agg(F.max("event_ts").alias("_newest"))
        counted = throughput(batch, bucket)
        if before is None:
            known = batch.sparkSession.range(1).select(F.lit(None).cast("timestamp").alias("_mark"))
            held = counted.limit(0)
        else:
            known = before.agg(F.max("watermark").alias("_mark"))
            held = before.filter(F.col("bucket_start").isNotNull()).select("bucket_start", "trades")
        marks = known.crossJoin(seen).select("_mark", F.greatest("_mark", F.col("_newest") - wait).alias("_next"))  # one row
        marks = F.broadcast(marks)
        marked = counted.crossJoin(marks)
        late = marked.filter(F.coalesce(end <= F.col("_mark"), F.lit(False))).select("bucket_start", "trades")
        on_time = marked.filter(F.coalesce(end > F.col("_mark"), F.lit(True))).select("bucket_start", "trades")
        sums = held.unionByName(on_time).groupBy("bucket_start").agg(F.sum("trades").alias("trades")).crossJoin(marks)
        passed = F.coalesce(end <= F.col("_next"), F.lit(False))
        mark = marks.select(F.lit(None).cast("timestamp").alias("bucket_start"), F.lit(0).cast("long").alias("trades"), F.col("_next").alias("watermark"))
        still = sums.filter(~passed).select("bucket_start", "trades", F.col("_next").alias("watermark"))
        return {"closed": sums.filter(passed).select("bucket_start", "trades"), "late": late, "state": mark.unionByName(still)}

    return carry(stream, path, checkpoint, fold, every)


def windows_so_far(spark: SparkSession, path: str) -> DataFrame:
    """All buckets with trades on time and late ones; open buckets come from the last batch's state."""
    zero = F.lit(0).cast("long")
    closed = finished(spark, path, "closed").select("bucket_start", "trades", zero.alias("late"), F.lit(False).alias("is_open"))
    late = finished(spark, path, "late").select("bucket_start", zero.alias("trades"), F.col("trades").alias("late"), F.lit(False).alias("is_open"))
    open_ = last_state(spark, path).filter(F.col("bucket_start").isNotNull())
    open_ = open_.select("bucket_start", "trades", zero.alias("late"), F.lit(True).alias("is_open"))
    rows = closed.unionByName(late).unionByName(open_)
    return rows.groupBy("bucket_start").agg(F.sum("trades").alias("trades"), F.sum("late").alias("late"), F.max("is_open").alias("is_open"))
