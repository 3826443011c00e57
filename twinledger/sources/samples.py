"""Trade feeds, orders, instruments and stores derived from the given tables.

The same derivations are stated in SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.timestamps import format_iso_utc
from twinledger.operators.cleanse import cleanse_trades, drop_missing, usable_trades
from twinledger.operators.ordering import with_position
from twinledger.operators.store import append_idempotent, create_store, read_store
from twinledger.schema import PRICE_TYPE, TRADE_COLUMNS
from twinledger.session import materialize, scratch_dir, use_utc

# Order of arrival in the raw feed. The first three order the copies of an id; all five are
# unique over the whole feed.
ARRIVAL = ["arr_ship", "arr_supp", "arr_part", "arr_order", "arr_line"]

# Days on which the shadow store was cut off, or stopped.
OUTAGE_DAYS = [
    ("PARTITION", "1997-03-01", "1997-06-01"),
    ("PARTITION", "1999-12-25", "2000-01-10"),
    ("HALT", "1998-09-15", "1998-10-01"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return format_iso_utc(ts.cast("timestamp"))


def _raw_view(spark: SparkSession, sf_dir: str, more_dirt: bool = False) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    b = (
        F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey") * 3
    ) % 100
    shipped = F.col("l_shipdate").cast("timestamp")
    order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    trade_id = F.concat(F.lit("TRD-"), order, F.lit("-"), line)
    feed = lines.select(
        F.when(b.between(4, 6), "").otherwise(trade_id).alias("trade_id"),
        F.when(b.between(7, 9), "").otherwise(F.col("p_brand")).alias("instrument"),
        F.when(b.between(10, 13), "")
        .when(b == 14, "-150.0")
        .when(b == 15, "0.0")
        .when(b == 16, "-0.01")
        .otherwise(F.col("l_extendedprice").cast(PRICE_TYPE).cast("string"))
        .alias("price"),
        F.when(b == 17, "0")
        .when(b == 18, "-10")
        .when(b == 19, "-50")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.concat(F.lit("ORD-B-"), order).alias("buy_order_id"),
        F.concat(F.lit("ORD-S-"), F.col("l_suppkey").cast("string")).alias("sell_order_id"),
        F.when(b.between(20, 22), F.date_format(shipped, "yyyy-MM-dd HH:mm:ss"))
        .when(b.between(23, 24), F.unix_millis(shipped).cast("string"))
        .when(b == 25, "not-a-date")
        .otherwise(format_iso_utc(shipped))
        .alias("timestamp"),
        shipped.alias("arr_ship"),
        F.col("l_suppkey").alias("arr_supp"),
        F.col("l_partkey").alias("arr_part"),
        F.col("l_orderkey").alias("arr_order"),
        F.col("l_linenumber").alias("arr_line"),
        b.alias("_b"),
    )
    if more_dirt:
        feed = feed.withColumns(
            {c: _more_dirt(F.col(c), dirt, F.col("_b")) for c, dirt in _MORE_DIRT.items()}
        ).withColumn(
            "timestamp",
            F.when(F.col("_b") == 37, F.concat(F.substring("timestamp", 1, 19), F.lit("+02:00")))
            .when(F.col("_b") == 38, F.date_format("arr_ship", "MM/dd/yyyy HH:mm"))
            .otherwise(F.col("timestamp")),
        )
    return feed.drop("_b")


# Texts that further buckets carry in the dirtier feed; ``{}`` stands for the clean value.
_MORE_DIRT = {
    "trade_id": {26: "\t{} ", 39: "none", 40: "NA"},
    "instrument": {27: "NaN "},
    "buy_order_id": {28: "null"},
    "sell_order_id": {29: "None"},
    "price": {30: "1e3", 31: "10d", 32: "inf", 33: " 12.5 "},
    "quantity": {34: "0.5", 35: "10.7", 36: "1_000"},
}


def _more_dirt(clean: Column, dirt: dict[int, str], b: Column) -> Column:
    value = clean
    for bucket, text in dirt.items():
        head, _, tail = text.partition("{}")
        dirty = F.concat(F.lit(head), clean, F.lit(tail)) if "{}" in text else F.lit(text)
        value = F.when(b == bucket, dirty).otherwise(value)
    return value


# Tables built once per session and data folder: (application, folder, name) to what was built.
# A session that runs on after its input folder has changed still sees what was built first.
_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw feed of text, with its dirt decided by a bucket of each line's keys."""
    return once(
        use_utc(spark), sf_dir, "raw", lambda: materialize(_raw_view(spark, sf_dir), "raw_feed")
    )


def dirty_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed with more kinds of dirt: padding, null words, odd numbers, other layouts."""
    return once(
        use_utc(spark),
        sf_dir,
        "dirty",
        lambda: materialize(_raw_view(spark, sf_dir, more_dirt=True), "dirty_feed"),
    )


def wide_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw feed of orders in which some prices and quantities are larger than a store holds."""
    k = F.col("o_orderkey")
    text = F.col("o_totalprice").cast(PRICE_TYPE).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("TRD-"), k.cast("string")).alias("trade_id"),
        F.lit("WIDE").alias("instrument"),
        F.when(k % 5 == 0, F.concat(F.lit("20000000000000"), text)).otherwise(text).alias("price"),
        F.when(k % 7 == 0, F.lit("3000000000")).otherwise((k % 100 + 1).cast("string")).alias("quantity"),
        F.lit("B").alias("buy_order_id"),
        F.lit("S").alias("sell_order_id"),
        F.lit("2026-10-01T10:00:00Z").alias("timestamp"),
    )


def clean_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse_trades(raw_trades(spark, sf_dir), ARRIVAL)


def delivery_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable trades with every repeated delivery kept, numbered in order of arrival."""

    def build() -> DataFrame:
        # Written once, as the ranges of the numbering are cut by a pass of its own, which would cleanse the feed again.
        usable = materialize(drop_missing(usable_trades(raw_trades(spark, sf_dir)), "timestamp"), "usable")
        # Numbering writes the sorted rows once; they are not written again.
        return with_position(usable, ARRIVAL).select(
            *TRADE_COLUMNS,
            "ingest_seq",
            F.to_timestamp("timestamp").alias("event_ts"),
        )

    return once(spark, sf_dir, "delivery_feed", build)


def during(kind: str | None = None) -> Column:
    """Whether a trade's timestamp falls into one of the outage days' intervals."""
    hits = [
        (F.col("timestamp") >= f"{start}T00:00:00Z") & (F.col("timestamp") < f"{end}T00:00:00Z")
        for k, start, end in OUTAGE_DAYS
        if kind in (None, k)
    ]
    hit = F.lit(False)
    for h in hits:
        hit = hit | h
    return hit


def store_paths(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A legacy store with every clean trade, and a cloud store without the outage days."""

    def build() -> tuple[str, str]:
        legacy, cloud = scratch_dir(spark, "legacy"), scratch_dir(spark, "cloud")
        append_idempotent(clean_trades(spark, sf_dir).select(*TRADE_COLUMNS), legacy, "load", 0, bulk=True)
        held = read_store(spark, legacy).filter(~during())
        append_idempotent(held.select(*TRADE_COLUMNS), cloud, "load", 0, bulk=True)
        return legacy, cloud

    return once(spark, sf_dir, "stores", build)


def stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    use_utc(spark)
    legacy, cloud = store_paths(spark, sf_dir)
    return read_store(spark, legacy), read_store(spark, cloud)


def outage_days(spark: SparkSession) -> DataFrame:
    """The outage days as intervals over the text of a timestamp."""
    return spark.range(0, 1, 1, 1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("kind"),
                        F.lit(f"{start}T00:00:00Z").alias("start"),
                        F.lit(f"{end}T00:00:00Z").alias("end"),
                    )
                    for kind, start, end in OUTAGE_DAYS
                ]
            )
        )
    )


def drill_cuts(n: int) -> list[int]:
    """Positions at which a drill over n trades is delivered: four parts."""
    return [i * n // 4 for i in range(5)]


def drill_outages(spark: SparkSession, n: int) -> DataFrame:
    """An outage in the third quarter of a feed and a halt near its end."""
    return spark.range(0, 1, 1, 1).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("PARTITION").alias("kind"),
                    F.lit(n // 2).cast("long").alias("start"),
                    F.lit(3 * n // 4).cast("long").alias("end"),
                ),
                F.struct(
                    F.lit("HALT").alias("kind"),
                    F.lit(7 * n // 8).cast("long").alias("start"),
                    F.lit(15 * n // 16).cast("long").alias("end"),
                ),
            )
        )
    )


def fresh_store(spark: SparkSession, name: str) -> str:
    path = scratch_dir(spark, name)
    create_store(spark, path)
    return path


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trade stream from ``events``: every tenth trade delivers an earlier id once more."""
    e = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    number = F.when(e % 10 == 9, F.floor(e / 2)).otherwise(e).cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("TRD-"), number).alias("trade_id"),
        F.col("event_type").alias("instrument"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        (F.col("user_id") % 500 + 1).cast("int").alias("quantity"),
        F.concat(F.lit("ORD-B-"), F.col("user_id").cast("string")).alias("buy_order_id"),
        F.concat(F.lit("ORD-S-"), e.cast("string")).alias("sell_order_id"),
        format_iso_utc(ts).alias("timestamp"),
        e.alias("ingest_seq"),
        ts.alias("event_ts"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event trades as records of a topic with four partitions; one in fifty is cut short."""
    e = F.col("ingest_seq")
    whole = F.to_json(F.struct(*TRADE_COLUMNS))
    text = F.when(e % 50 == 1, F.substring(whole, F.lit(1), F.length(whole) - 15)).otherwise(whole)
    return event_trades(spark, sf_dir).select(
        F.col("trade_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        (e % 4).cast("int").alias("partition"),
        F.floor(e / 4).alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator actions from ``events``: the kind of event names the action."""
    kind = F.col("event_type")
    action = (
        F.when(F.col("event_id") % 97 == 96, "reset")
        .when(kind == "click", "stream_toggle")
        .when(kind == "error", "chaos_toggle")
        .when(kind == "purchase", "cutover")
        .when(kind == "signup", "rollback")
        .otherwise("set_rate")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        action.alias("action"),
        F.when(action == "set_rate", F.col("value").cast(PRICE_TYPE).cast("int")).alias("rate"),
    )


def text_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of each event, written in one of many layouts; some are not dates at all."""
    ts = F.col("ts").cast("timestamp")
    layout = F.col("event_id") % 24

    def as_text(pattern: str) -> Column:
        return F.date_format(ts, pattern)

    text = (
        F.when(layout == 0, as_text("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(layout == 1, as_text("yyyy-MM-dd HH:mm:ss"))
        .when(layout == 2, F.unix_millis(ts).cast("string"))
        .when(layout == 3, F.unix_seconds(ts).cast("string"))
        .when(layout == 4, F.concat(as_text("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(layout == 5, as_text("MM/dd/yyyy HH:mm"))
        .when(layout == 6, as_text("MMM d yyyy"))
        .when(layout == 7, F.lit("not-a-date"))
        .when(layout == 8, F.lit("now"))
        .when(layout == 9, F.concat(F.lit("\t "), as_text("yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z ")))
        .when(layout == 10, as_text("yyyy-MM-dd"))
        .when(layout == 11, F.lit("None"))
        .when(layout == 12, as_text("yyyy/MM/dd HH:mm:ss"))
        .when(layout == 13, as_text("d MMM yyyy HH:mm"))
        .when(layout == 14, as_text("HH:mm:ss"))
        .when(layout == 16, as_text("MMMM d, yyyy"))
        .when(layout == 17, as_text("MM/dd/yyyy hh:mm a"))
        .when(layout == 18, as_text("MMM d yyyy h:mm:ss a"))
        .when(layout == 19, F.concat(as_text("E, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(layout == 20, as_text("yyyyMMdd'T'HHmmss'Z'"))
        .when(layout == 21, as_text("dd-MMM-yyyy"))
        .when(layout == 22, as_text("MM/dd/yy"))
        .when(layout == 23, as_text("MM/dd/yyyy HH:mm:ss.SSS"))
        .otherwise(F.concat(F.lit("99"), F.unix_millis(ts).cast("string")))
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("timestamp"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with some broken sides, prices, quantities and instruments."""
    k = F.col("o_orderkey")
    side = (
        F.when(k % 23 == 0, "HOLD")
        .when(k % 29 == 0, " BUY")
        .when(k % 4 == 0, "BUY")
        .when(k % 4 == 1, "sell")
        .when(k % 4 == 2, "buy")
        .otherwise("SELL")
    )
    price = F.when(k % 31 == 0, F.lit(0)).when(k % 37 == 0, F.lit(-1)).otherwise(
        F.col("o_totalprice")
    )
    return table(spark, sf_dir, "orders").select(
        F.when(k % 41 == 0, "   ").otherwise(F.concat(F.lit("ORD-"), k.cast("string"))).alias("order_id"),
        side.alias("side"),
        F.when(k % 43 == 0, "\t").otherwise(F.col("o_orderpriority")).alias("instrument"),
        price.cast(PRICE_TYPE).alias("price"),
        F.when(k % 47 == 0, F.lit(0)).otherwise(F.col("o_custkey") % 500 + 1).cast("int").alias("quantity"),
        _iso(F.col("o_orderdate")).alias("timestamp"),
        F.when(k % 5 > 0, F.concat(F.lit("ACC-"), F.col("o_custkey").cast("string"))).alias("account_id"),
        F.when(k % 3 > 0, F.col("o_orderstatus")).alias("status"),
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments with defaults to fill and some broken ticks, lots and names."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("instrument_key"),
        F.when(k % 19 == 0, " ").otherwise(F.col("p_brand")).alias("symbol"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("name"),
        F.col("p_type").alias("asset_class"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 17 == 0, 0.0).otherwise(0.05).cast("double").alias("tick_size"),
        F.when(k % 4 == 0, F.lit(None)).when(k % 13 == 0, F.lit(-1)).otherwise(F.col("p_size")).cast("int").alias("lot_size"),
    )


def isin_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand with an identifier for it; some brands have none."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("_k"))
    return brands.select(
        F.col("p_brand").alias("symbol"),
        F.when(
            ~F.col("p_brand").endswith("5"),
            F.concat(F.lit("XN"), F.lpad(F.col("_k").cast("string"), 10, "0")),
        ).alias("isin"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trades as JSON; some are cut short, some lack a price, some break a rule."""
    clean = clean_trades(spark, sf_dir)
    b = (F.col("arr_order") * 5 + F.col("arr_line") * 11) % 50
    quantity = F.when(b == 3, F.lit(0)).otherwise(F.col("quantity"))
    price = F.when(b != 2, F.col("price").cast("string"))
    whole = F.to_json(
        F.struct(
            "trade_id",
            "instrument",
            price.alias("price"),
            quantity.alias("quantity"),
            "buy_order_id",
            "sell_order_id",
            "timestamp",
        )
    )
    cut = F.substring(whole, F.lit(1), F.length(whole) - 20)
    return clean.select(
        F.col("trade_id").alias("source_id"),
        F.when(b == 1, cut).otherwise(whole).alias("payload"),
    )
