"""Audits on an interval, throughput of a stream, and the snapshot that a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinledger.operators.controls import latest_state
from twinledger.operators.parity import parity_from_totals
from twinledger.operators.reporting import audit_log_tail, recent_trades, throughput
from twinledger.operators.store import read_totals
from twinledger.streaming.loads import start, write_batch, writer_of


def log_parity(
    ticks: DataFrame, legacy: str, cloud: str, log: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append one audit row per micro-batch of ``ticks`` (a feed, or a rate source for a clock).

    The audit adds up what each batch stored rather than scanning both stores on every tick.
    While the loads are running it may see drift that is gone once both have caught up.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        audit = parity_from_totals(read_totals(spark, legacy), read_totals(spark, cloud))
        write_batch(audit, log, writer_of(batch), batch_id)

    return start(ticks, each_batch, checkpoint, every)


def log_throughput(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    bucket: str = "1 second",
    late_by: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Trades per bucket from a stream.

    With ``late_by`` a bucket is written once, when the watermark has passed it, and its state is
    then dropped: the form to run for long. Without it every bucket so far is rewritten on each
    trigger, the last ones included.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    if late_by:
        counted = throughput(stream.withWatermark("event_ts", late_by), bucket)
        writer = counted.writeStream.outputMode("append").format("parquet").option("path", path)
    else:

        def rewrite(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        writer = throughput(stream, bucket).writeStream.outputMode("complete").foreachBatch(rewrite)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def telemetry_snapshot(
    audit: DataFrame,
    report: DataFrame,
    feed: DataFrame,
    state: DataFrame,
    messages: DataFrame,
    bucket: str = "1 second",
) -> DataFrame:
    """One row: audit, control flags, rate, report, latest trades and latest log messages.

    ``audit`` and ``report`` are one row each, best taken from batch totals, so that no store is scanned. Each
    part is one row or a short top-k list before the parts are put side by side. The rate is that of
    the last bucket, the only one that is counted; an idle stream shows its target rate instead.
    """
    last = feed.agg(F.max("event_ts").alias("_last"))  # one row
    recent = feed.crossJoin(F.broadcast(last)).filter(
        F.col("event_ts") > F.col("_last") - F.expr(f"INTERVAL {bucket}")
    )
    newest = throughput(recent.drop("_last"), bucket).orderBy(F.desc("bucket_start")).limit(1)
    shown = recent_trades(feed)
    trade = F.struct("ingest_seq", *[c for c in feed.columns if c != "ingest_seq"])
    tail = audit_log_tail(messages)
    parts = {
        "audit": audit.agg(F.first(F.struct(*audit.columns)).alias("v")),
        "state": latest_state(state).agg(F.first(F.struct(*state.columns)).alias("v")),
        "rate": newest.agg(F.coalesce(F.first("trades"), F.lit(0)).alias("v")),
        "reporting": report.agg(F.first(F.struct("*")).alias("v")),
        "latest_trades": shown.agg(F.sort_array(F.collect_list(trade), asc=False).alias("v")),
        "recent_logs": tail.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("v")),
    }
    stacked = None
    for name, part in parts.items():
        named = part.select(F.col("v").alias(name))
        stacked = named if stacked is None else stacked.unionByName(named, allowMissingColumns=True)
    row = stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in parts])
    target = F.when(F.col("state.is_streaming"), F.col("state.target_rate")).otherwise(0)
    return row.select(
        "audit.legacy_count",
        "audit.cloud_count",
        "audit.drift",
        "audit.status",
        "audit.legacy_volume",
        "audit.cloud_volume",
        "audit.volume_difference",
        "state.is_streaming",
        "state.is_chaos_active",
        "state.is_cutover_active",
        F.when(F.col("rate") > 0, F.col("rate")).otherwise(target).cast("long").alias("tps"),
        "reporting",
        "latest_trades",
        "recent_logs",
    )
