"""Row types of the ledger, and the fixed values its results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_TYPE = T.DecimalType(15, 2)

TRADE_COLUMNS = [
    "trade_id",
    "instrument",
    "price",
    "quantity",
    "buy_order_id",
    "sell_order_id",
    "timestamp",
]


def _text_fields(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# A raw feed is read as text only; nothing is inferred.
RAW_FEED = T.StructType(_text_fields(TRADE_COLUMNS))

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("price", PRICE_TYPE),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("buy_order_id", T.StringType()),
        T.StructField("sell_order_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# What a topic carries: a trade plus its position in the feed and its event time.
FEED = T.StructType(
    TRADE.fields
    + [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

# Feed rows that an outage dropped, kept per batch.
DEAD_LETTERS = T.StructType(FEED.fields + [T.StructField("batch_id", T.LongType())])

# Dead letters that a replay is done with.
ACKNOWLEDGEMENTS = T.StructType(
    [T.StructField("ingest_seq", T.LongType()), T.StructField("trade_id", T.StringType())]
)

# What a store holds. The last two columns are directory partitions.
STORE = T.StructType(
    TRADE.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# One row per batch and store: what that batch added.
STORE_TOTALS = T.StructType(
    [
        T.StructField("trade_count", T.LongType()),
        T.StructField("volume", T.DecimalType(36, 2)),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("price", PRICE_TYPE),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

INSTRUMENT = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("asset_class", T.StringType()),
        T.StructField("tick_size", T.DoubleType()),
        T.StructField("lot_size", T.IntegerType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("legacy_count", T.LongType()),
        T.StructField("cloud_count", T.LongType()),
        T.StructField("drift", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("legacy_volume", T.DoubleType()),
        T.StructField("cloud_volume", T.DoubleType()),
        T.StructField("volume_difference", T.DoubleType()),
        T.StructField("data_loss_percentage", T.DoubleType()),
    ]
)

# --- Fixed values -----------------------------------------------------------------------------
# These must stay exactly as they are for the results to be right.

# Texts that a pandas CSV read turns into a missing value.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Whitespace that Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Digits-only timestamps above this are milliseconds, others seconds.
EPOCH_MS_THRESHOLD = 10**11

ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

STATUS_IN_PARITY = "IN_PARITY"
STATUS_DRIFT = "DRIFT_DETECTED"

OUTCOME_STORED = "STORED"
OUTCOME_DROPPED = "DROPPED_BY_CHAOS"
OUTCOME_DUPLICATE = "DUPLICATE_SKIPPED"
OUTCOME_HALTED = "HALTED"

# Status a live feed record carries when the shadow write was dropped.
FEED_DROPPED = "DROPPED"

DEFAULT_ORDER_STATUS = "FILLED"
DEFAULT_TICK_SIZE = 0.01
DEFAULT_LOT_SIZE = 1

REPORT_LABELS = {
    "workload_name": "Post-Trade Regulatory Reporting & Surveillance",
    "execution_status": "CLOUD_NATIVE_ACTIVE",
    "compliance_standard": "FINRA CAT / MiFID II Compliant",
    "data_source": "Target AWS Aurora Multi-AZ PostgreSQL (Shadow Store)",
    "offload_impact": "100% of reporting query I/O removed from on-prem matching engine",
}

EXPORT_ID_PREFIX = "FINRA_CAT_EOD_"
EXPORT_LABELS = {
    "compliance_standard": "FINRA CAT Section 6800 / MiFID II RTS 22",
    "migration_architecture": "Hexagonal Clean Architecture",
    "source_database": "AWS Aurora Multi-AZ Cloud PostgreSQL",
    "on_prem_engine_impact": "0% CPU (100% Query I/O Offloaded to Cloud)",
    "verified_by": "Out-of-Band Parity Checker Engine",
}

PRIMARY_CLOUD = "AWS Aurora Multi-AZ PostgreSQL"
PRIMARY_LEGACY = "Legacy On-Premises Matching Engine"

VENUE_MIC = "XNEX"

DEFAULT_TOPIC = "market.trades"

RECENT_KEPT = 40
RECENT_SHOWN = 15
AUDIT_LOG_KEPT = 50
AUDIT_LOG_SHOWN = 8
TREND_SAMPLES = 30
TREND_FLOOR = 60
RATE_MIN = 1
RATE_MAX = 100
RATE_DEFAULT = 20
CUTOVER_DAYS = 7

# What the operator log says about a control event: tag, type and message.
LOG_STREAM_RESUMED = ("STREAM", "info", "Market stream RESUMED.")
LOG_STREAM_PAUSED = ("STREAM", "info", "Market stream PAUSED.")
LOG_CHAOS_ON = ("CHAOS", "alert", "Outage INJECTED: Cloud worker dropping trades!")
LOG_CHAOS_OFF = ("CHAOS", "success", "Outage HEALED.")
LOG_CUTOVER = ("CUTOVER", "success", "Cloud Aurora promoted to Primary Master.")
LOG_ROLLBACK = (
    "ROLLBACK",
    "alert",
    "Failback executed! Legacy Hot-Standby resumed primary matching (0.00% data loss).",
)
LOG_RECONCILED = ("RECON", "success", "Idempotent replay restored %d missing trades. Parity: %s.")
LOG_RESET = ("SYSTEM", "info", "Databases reset to initial state.")
