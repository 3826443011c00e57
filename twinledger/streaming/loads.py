"""Continuous loads of the two stores from one feed, each at its own pace.

Every consumer is its own streaming query with its own checkpoint. A batch writes only folders
named after its query and its batch id, so a batch that is tried again replaces what it wrote before,
and nothing else: another topic, or a fresh checkpoint, is another query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinledger.operators.outcomes import flag_outages, outcome_ledger, reached_cloud
from twinledger.operators.store import append_idempotent, append_new, read_store
from twinledger.operators.validate import split_checked, trade_is_valid, with_trade_reasons
from twinledger.schema import TRADE_COLUMNS
from twinledger.sources.payloads import parse_payloads


def writer_of(batch: DataFrame) -> str:
    """The name under which a query writes. Its id lives in its checkpoint and survives restarts."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("a stream's batch must be written from within its query")
    return f"stream-{query_id}"


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``each_batch`` on every micro-batch: on an interval, or until the feed is drained."""
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def drain(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait until a query has taken in everything published; its failure fails the caller. With a
    ``timeout`` in seconds, a query that takes longer is stopped."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"query {query.id} did not drain in {timeout} s")


def write_batch(rows: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Keep a batch's rows under its query and its id; trying the batch again replaces them."""
    rows.write.mode("overwrite").parquet(f"{path}/writer={writer}/batch_id={batch_id}")


def refused_path(store: str) -> str:
    """Where a load keeps what it refuses, unless it is told another place."""
    return f"{store.rstrip('/')}_refused"


def set_aside(rows: DataFrame, quarantine: str, writer: str, batch_id: int) -> DataFrame:
    """The rows that a store accepts; the others go to ``quarantine`` with reasons."""
    # Reasons are worked out for the rows that need them; a row without any is a valid one.
    bad = with_trade_reasons(rows.filter(~trade_is_valid()))
    write_batch(bad, quarantine, writer, batch_id)
    return rows.filter(trade_is_valid())


def load_legacy(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    every: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """The primary store takes every new trade; what breaks a rule goes to ``quarantine``, by itself ``refused_path``."""
    quarantine = quarantine or refused_path(store)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        good = set_aside(batch, quarantine, writer_of(batch), batch_id)
        append_idempotent(good, store, writer_of(batch), batch_id, ["ingest_seq"])

    return start(stream, each_batch, checkpoint, every)


def load_cloud(
    stream: DataFrame,
    store: str,
    dead_letters: str,
    outages: DataFrame | Callable[[], DataFrame],
    checkpoint: str,
    every: str | None = None,
    axis: str = "ingest_seq",
    quarantine: str | None = None,
    outcomes: str | None = None,
) -> StreamingQuery:
    """The shadow store takes what reaches it.

    Trades of an outage go to the dead letters, copies included; trades that arrive while the
    consumer is halted are ignored. ``outages`` may be a function: it is asked again for every batch, so
    an outage that begins while the load runs counts from its next batch on. Trades that break a rule go to
    ``quarantine``, by itself ``refused_path``, and ``outcomes`` keeps what became of every other trade: each trade of a batch is in one of the two.
    """
    quarantine = quarantine or refused_path(store)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        known = outages() if callable(outages) else outages
        flagged = flag_outages(batch, known, axis).persist()
        try:
            good = set_aside(flagged.filter(reached_cloud()), quarantine, writer, batch_id)
            if outcomes:
                held = read_store(batch.sparkSession, store)
                held = held.filter((F.col("writer") != writer) | (F.col("batch_id") != batch_id))
                counted = good.unionByName(flagged.filter(~reached_cloud()))
                ledger = outcome_ledger(counted, axis, cloud=held.select("trade_id"))
                write_batch(ledger.select(axis, "trade_id", "cloud_status"), outcomes, writer, batch_id)
            append_idempotent(good, store, writer, batch_id, ["ingest_seq"])
            dropped = flagged.filter(F.col("cut_off") & ~F.col("halted"))
            write_batch(dropped.drop("cut_off", "halted"), dead_letters, writer, batch_id)
        finally:
            flagged.unpersist()

    return start(stream, each_batch, checkpoint, every)


def load_payloads(
    stream: DataFrame, store: str, quarantine: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """JSON payloads to the store; a bad one goes to quarantine with its reasons and the load
    goes on."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # Held, so that each payload is parsed once and not once per rule and side.
        parsed = parse_payloads(batch).persist()
        try:
            good, bad = split_checked(parsed)
            # Among copies of an id the smallest payload counts, so that a retry picks the same one.
            append_idempotent(good, store, writer_of(batch), batch_id, ["payload"])
            write_batch(bad.select("payload", "reject_reasons"), quarantine, writer_of(batch), batch_id)
        finally:
            parsed.unpersist()

    return start(stream, each_batch, checkpoint, every)


def load_records(
    stream: DataFrame, store: str, quarantine: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Decoded records, as ``topics.decode_records`` gives them, to the store in topic order; the rest go to
    quarantine with their text and reasons."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_checked(batch)
        append_idempotent(good, store, writer_of(batch), batch_id, ["ingest_seq"])
        write_batch(bad.select("ingest_seq", "payload", "reject_reasons"), quarantine, writer_of(batch), batch_id)

    return start(stream, each_batch, checkpoint, every)


def load_checked(
    stream: DataFrame, store: str, quarantine: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Typed trades to the store, with those that break an invariant set aside."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_checked(with_trade_reasons(batch))
        append_idempotent(good, store, writer_of(batch), batch_id, ["ingest_seq"])
        write_batch(bad, quarantine, writer_of(batch), batch_id)

    return start(stream, each_batch, checkpoint, every)


#: Exact identity for ever needs state on disk, and only its changes written with each batch.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_seen(stream: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Per batch (output mode ``update``) the ids that it met, with their first copy and ``is_new``.

    The state is one row per id and has no watermark, so an id is known for ever. The first copy is the first one
    delivered, by batch and then by ``seq``. The time of a batch is kept in the checkpoint, so a batch tried again has the same.
    """
    copy = F.struct(*[c for c in stream.columns if c != "trade_id"])
    timed = stream.withColumn("_at", F.current_timestamp())
    firsts = timed.groupBy("trade_id").agg(
        F.min_by(copy, F.struct("_at", seq)).alias("_first"), F.min("_at").alias("_from"), F.max("_at").alias("_to")
    )
    return firsts.select("trade_id", "_first.*", (F.col("_from") == F.col("_to")).alias("is_new"))


def load_by_state(stream: DataFrame, store: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Every new trade to a store that this query alone writes, known by the stream's own state in place of a join with the store.

    What breaks a rule is left out here; ``load_refused`` on the same topic keeps it.
    """
    spark = stream.sparkSession
    before = {name: spark.conf.get(name, None) for name in _ON_DISK}
    valid = stream.filter(trade_is_valid()).select(*TRADE_COLUMNS, "ingest_seq")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        append_new(batch.filter("is_new").select(*TRADE_COLUMNS), store, writer_of(batch), batch_id)

    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    try:  # a query takes its settings along when it starts
        writer = first_seen(valid).writeStream.outputMode("update").foreachBatch(each_batch)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def load_refused(stream: DataFrame, quarantine: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The trades that break a rule, with reasons."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        set_aside(batch, quarantine, writer_of(batch), batch_id)

    return start(stream, each_batch, checkpoint, every)
