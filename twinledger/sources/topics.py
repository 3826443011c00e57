"""Topics: a folder of Parquet files, or Kafka where its connector is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.schema import DEFAULT_TOPIC, FEED, RATE_MAX, RATE_MIN
from twinledger.sources.payloads import parse_payloads

# Positions leave this many bits to the offset, the rest to the partition.
_OFFSET_BITS = 48


def topic_path(root: str, topic: str = DEFAULT_TOPIC) -> str:
    return f"{root.rstrip('/')}/{topic}"


def publish(trades: DataFrame, path: str, spread: bool = False) -> None:
    """Add trades to a topic folder. Each call is delivered after the calls before it.

    The files follow the input's own splits, of which a part of a feed may fill a few only. ``spread`` deals the
    rows evenly, so that every consumer reads them in as many tasks; copies of an id may then lie in any file of
    the call, so its consumers must take the whole call in one trigger.
    """
    rows = trades.select(*FEED.fieldNames())
    if spread:
        # Positions are unique, so no key is frequent; the number of files follows from the size.
        rows = rows.repartition("ingest_seq")
    rows.write.mode("append").parquet(path)


def subscribe(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream over a topic folder; ``max_files`` caps how much one trigger takes in."""
    reader = spark.readStream.schema(FEED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def subscribe_payloads(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of JSON payloads, one per line of text, in the column ``payload``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).withColumnRenamed("value", "payload")


def rate_cap(trades_per_second: int, trigger_seconds: int = 1) -> int:
    """Rows per trigger for a target rate kept within its limits."""
    return max(RATE_MIN, min(RATE_MAX, int(trades_per_second))) * trigger_seconds


def kafka_options(
    servers: str, topic: str = DEFAULT_TOPIC, max_offsets: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def decode_records(records: DataFrame) -> DataFrame:
    """Kafka records with trades of seven fields to feed rows with ``payload`` and ``reject_reasons``.

    No record is lost: what is not JSON, lacks a field or breaks a rule keeps its text and its
    reasons. The position is that in the topic, by partition and offset, and the time is the trade's
    own or else the broker's.
    """
    texts = records.select(
        F.col("value").cast("string").alias("payload"),
        (F.shiftleft(F.col("partition").cast("long"), _OFFSET_BITS) + F.col("offset")).alias("ingest_seq"),
        F.col("timestamp").alias("_broker_time"),
    )
    parsed = parse_payloads(texts)
    at = F.coalesce(F.try_to_timestamp("timestamp"), F.col("_broker_time"))
    return parsed.withColumn("event_ts", at).drop("_broker_time")


def subscribe_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = DEFAULT_TOPIC,
    max_offsets: int | None = None,
    trades_per_second: int | None = None,
    trigger_seconds: int = 1,
) -> DataFrame:
    """A stream of records, decoded by ``decode_records``. ``trades_per_second`` caps each trigger, within
    the limits of the target rate."""
    if trades_per_second is not None:
        max_offsets = rate_cap(trades_per_second, trigger_seconds)
    options = kafka_options(servers, topic, max_offsets)
    return decode_records(spark.readStream.format("kafka").options(**options).load())


def publish_kafka(trades: DataFrame, servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Keyed by trade id, so that copies of a trade stay in order."""
    value = F.to_json(F.struct(*FEED.fieldNames()))
    records = trades.select(F.col("trade_id").alias("key"), value.alias("value"))
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
