"""End-of-day reports and the views of recent activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions.numbers import divide_or_zero, money_text, notional
from twinledger.functions.text import contains_ignore_case, time_of_day
from twinledger.operators.parity import audit_columns, store_totals
from twinledger.plans.joins import join_dimension
from twinledger.schema import (
    AUDIT_LOG_SHOWN,
    CUTOVER_DAYS,
    EXPORT_ID_PREFIX,
    EXPORT_LABELS,
    PRICE_TYPE,
    RECENT_KEPT,
    RECENT_SHOWN,
    REPORT_LABELS,
    STATUS_IN_PARITY,
    TREND_FLOOR,
    TREND_SAMPLES,
    VENUE_MIC,
)


def _labels(labels: dict[str, str]) -> list[Column]:
    return [F.lit(text).alias(name) for name, text in labels.items()]


def _average_value() -> Column:
    return divide_or_zero(F.col("volume").cast("double"), F.col("trade_count"))


def eod_report(store: DataFrame) -> DataFrame:
    """Executions, total notional and average value of an execution, with the fixed labels."""
    return _report(store_totals(store))


def eod_report_from_totals(totals: DataFrame) -> DataFrame:
    """The same report from what each batch added, without a scan of the store."""
    return _report(
        totals.agg(
            F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trade_count"),
            F.coalesce(F.sum("volume"), F.lit(0)).cast("decimal(36,2)").alias("volume"),
        )
    )


def _report(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("trade_count").alias("total_reported_executions"),
        F.round("volume", 2).cast("double").alias("total_notional_volume"),
        F.round(_average_value(), 2).alias("average_execution_value"),
        *_labels(REPORT_LABELS),
    )


def eod_export(
    store: DataFrame, generated_at_ms: int, labels: dict[str, str] = EXPORT_LABELS
) -> DataFrame:
    """The downloadable form of the report; the time it is made and its labels are passed in."""
    made = F.timestamp_millis(F.lit(generated_at_ms))
    return store_totals(store).select(
        F.lit(f"{EXPORT_ID_PREFIX}{generated_at_ms}").alias("report_id"),
        F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("generated_at"),
        F.col("trade_count").alias("total_executed_trades"),
        F.col("volume").cast("double").alias("aggregate_notional_volume"),
        _average_value().alias("average_trade_value"),
        F.lit(0.0).alias("data_loss_percentage"),
        *_labels(labels),
    )


# --- Recent activity --------------------------------------------------------------------------


def recent_trades(feed: DataFrame, shown: int = RECENT_SHOWN, seq: str = "ingest_seq") -> DataFrame:
    """The newest ``shown`` trades, newest first. The live view shows 15 of the 40 it keeps."""
    return feed.orderBy(F.desc(seq)).limit(shown)


def recent_per_group(
    feed: DataFrame, by: str, kept: int = RECENT_KEPT, seq: str = "ingest_seq"
) -> DataFrame:
    """The newest rows of each group; the limit is applied before the shuffle."""
    newest = Window.partitionBy(by).orderBy(F.desc(seq))
    return (
        feed.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= kept)
    )


def first_in_stream(feed: DataFrame, n: int, seq: str = "ingest_seq") -> DataFrame:
    """The first n rows of a feed whose positions count from 0: a filter, no sort."""
    return feed.filter(F.col(seq) < n)


def phase_cuts(feed: DataFrame, first: int = 150, second: int = 250) -> DataFrame:
    """Where a drill's outage starts and ends, from the length of the feed."""
    n = F.count("*")
    return feed.agg(
        n.alias("total"),
        F.least(F.lit(first), F.floor(n / 2)).cast("long").alias("outage_start"),
        F.least(F.lit(second), F.floor(n * 0.75)).cast("long").alias("outage_end"),
    )


def audit_log_tail(log: DataFrame, seq: str = "seq", shown: int = AUDIT_LOG_SHOWN) -> DataFrame:
    """The last ``shown`` messages of a log. The live view shows 8 of the 50 it keeps."""
    return log.orderBy(F.desc(seq)).limit(shown)


def filter_feed(feed: DataFrame, term: str) -> DataFrame:
    return feed.filter(contains_ignore_case(F.col("instrument"), term))


def filter_feed_count(feed: DataFrame, term: str) -> DataFrame:
    return filter_feed(feed, term).agg(F.count("*").alias("executions"))


def feed_display(feed: DataFrame) -> DataFrame:
    """A feed as it is shown: money with thousands, time of day only."""
    return feed.select(
        "trade_id",
        "instrument",
        F.concat(F.lit("$"), F.col("price").cast(PRICE_TYPE).cast("string")).alias("price_text"),
        "quantity",
        F.concat(F.lit("$"), money_text(notional())).alias("volume_text"),
        time_of_day(F.col("timestamp")).alias("time_text"),
    )


# --- Throughput -------------------------------------------------------------------------------


def throughput(feed: DataFrame, every: str = "1 second", ts: str = "event_ts") -> DataFrame:
    """Trades per time bucket. Works on a batch and, as an aggregate, on a stream."""
    return (
        feed.groupBy(F.window(ts, every).alias("_w"))
        .agg(F.count("*").alias("trades"))
        .select(F.col("_w.start").alias("bucket_start"), "trades")
    )


def trailing_throughput(
    buckets: DataFrame,
    bucket_seconds: int = 1,
    samples: int = TREND_SAMPLES,
    floor: int = TREND_FLOOR,
    block: int = 3600,
) -> DataFrame:
    """Each bucket with the samples of the trailing interval and the peak of the trend line.

    Buckets are cut into blocks of ``block`` ticks. The last ticks of a block are also copied
    into the next one as context, so the trailing frame never needs one global window.
    """
    tick = F.floor(F.unix_seconds("bucket_start") / bucket_seconds).cast("long")
    ticks = buckets.withColumn("_tick", tick)
    home = F.floor(F.col("_tick") / block)
    reach = F.floor((F.col("_tick") + samples - 1) / block)
    copies = ticks.withColumn("_block", F.explode(F.sequence(home, reach)))
    trailing = Window.partitionBy("_block").orderBy("_tick").rangeBetween(-(samples - 1), 0)
    history = F.collect_list("trades").over(trailing)
    return (
        copies.withColumns(
            {
                "history": history,
                "peak": F.greatest(F.max("trades").over(trailing), F.lit(floor)),
            }
        )
        .filter(F.col("_block") == home)
        .drop("_block", "_tick")
    )


# --- Regulatory extracts ----------------------------------------------------------------------


def transaction_report(store: DataFrame, instruments: DataFrame) -> DataFrame:
    """One line per trade: venue, ISIN where the instrument has one, both parties, notional.

    ``instruments`` has ``symbol`` and ``isin``. Of a symbol with several, the smallest ISIN counts,
    so that no trade is reported twice.
    """
    isin = instruments.groupBy(F.col("symbol").alias("instrument")).agg(F.min("isin").alias("isin"))
    return join_dimension(store, isin, "instrument", "left").select(
        "trade_id",
        F.lit(VENUE_MIC).alias("venue_mic"),
        "instrument",
        "isin",
        F.col("buy_order_id").alias("buyer_id"),
        F.col("sell_order_id").alias("seller_id"),
        "price",
        "quantity",
        notional().alias("notional"),
        F.col("timestamp").alias("executed_at"),
    )


def order_audit_trail(store: DataFrame) -> DataFrame:
    """Each execution once per side, from one scan."""
    sides = F.explode(
        F.array(
            F.struct(F.col("buy_order_id").alias("order_id"), F.lit("BUY").alias("side")),
            F.struct(F.col("sell_order_id").alias("order_id"), F.lit("SELL").alias("side")),
        )
    )
    return store.select(
        sides.alias("_s"), "trade_id", "instrument", "price", "quantity", "timestamp"
    ).select("_s.*", "trade_id", "instrument", "price", "quantity", "timestamp")


def ordered_audit_trail(store: DataFrame) -> DataFrame:
    return order_audit_trail(store).orderBy("order_id", "timestamp", "trade_id", "side")


def daily_parity(legacy: DataFrame, cloud: DataFrame) -> DataFrame:
    """The audit of each trading day."""
    day = F.to_date(F.substring("timestamp", 1, 10))
    both = legacy.select(F.lit(True).alias("_legacy"), day.alias("day"), notional().alias("_v"))
    both = both.unionByName(
        cloud.select(F.lit(False).alias("_legacy"), day.alias("day"), notional().alias("_v"))
    )
    here, there = F.col("_legacy"), ~F.col("_legacy")
    per_day = both.groupBy("day").agg(
        F.count(F.when(here, 1)).alias("legacy_count"),
        F.count(F.when(there, 1)).alias("cloud_count"),
        F.coalesce(F.sum(F.when(here, F.col("_v"))), F.lit(0)).alias("legacy_volume"),
        F.coalesce(F.sum(F.when(there, F.col("_v"))), F.lit(0)).alias("cloud_volume"),
    )
    return per_day.select("day", *audit_columns())


def cutover_gate(days: DataFrame, needed: int = CUTOVER_DAYS) -> DataFrame:
    """Whether enough consecutive days of trade were in parity. Days on which the market was closed
    have no row and break no run.

    ``days`` has one row per day, so the global windows order days, not trades.
    """
    placed = days.select("status", F.row_number().over(Window.orderBy("day")).alias("_place"))
    good = placed.filter(F.col("status") == STATUS_IN_PARITY)
    runs = (
        good.withColumn(
            "_island", F.col("_place") - F.row_number().over(Window.orderBy("_place"))
        )
        .groupBy("_island")
        .agg(F.count("*").alias("_days"))
    )
    longest = F.coalesce(F.max("_days"), F.lit(0))
    return runs.agg(
        longest.alias("longest_run_days"), (longest >= needed).alias("cutover_ready")
    )
