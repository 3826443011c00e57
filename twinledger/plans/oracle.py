"""The registered queries in SQL, stated independently of the Spark code.

The feeds are derived from the same tables. Where the Spark side parses or coerces text, this side
works from the value the text was made of, so that a wrong parse shows.
"""

from __future__ import annotations

from twinledger.plans.catalog import CHECKPOINT_EVERY, EXPORTED_AT_MS
from twinledger.schema import (
    EXPORT_ID_PREFIX,
    EXPORT_LABELS,
    LOG_CHAOS_OFF,
    LOG_CHAOS_ON,
    LOG_CUTOVER,
    LOG_RESET,
    LOG_ROLLBACK,
    LOG_STREAM_PAUSED,
    LOG_STREAM_RESUMED,
    PRIMARY_CLOUD,
    PRIMARY_LEGACY,
    REPORT_LABELS,
    VENUE_MIC,
)
from twinledger.sources.samples import OUTAGE_DAYS

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_TRADE = "trade_id, instrument, price::DOUBLE AS price, quantity, buy_order_id, sell_order_id, \"timestamp\""
_ARRIVAL = "l_shipdate, l_suppkey, l_partkey, l_orderkey, l_linenumber"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- Feeds ------------------------------------------------------------------------------------

# Every line with its dirt bucket, its clean values, and the texts the raw feed carries.
_LINES = f"""
lines AS (
  SELECT l.*, p_brand,
         (l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3) % 100 AS b,
         'TRD-' || l_orderkey || '-' || l_linenumber AS id,
         l_extendedprice::DECIMAL(15,2) AS clean_price,
         l_quantity::INTEGER AS clean_quantity,
         'ORD-B-' || l_orderkey AS buy, 'ORD-S-' || l_suppkey AS sell,
         strftime(l_shipdate, {_ISO}) AS iso
  FROM lineitem l JOIN part ON p_partkey = l_partkey
),
raw AS (
  SELECT lines.*,
         CASE WHEN b BETWEEN 4 AND 6 THEN '' ELSE id END AS trade_id,
         CASE WHEN b BETWEEN 7 AND 9 THEN '' ELSE p_brand END AS instrument,
         CASE WHEN b BETWEEN 10 AND 13 THEN '' WHEN b = 14 THEN '-150.0' WHEN b = 15 THEN '0.0'
              WHEN b = 16 THEN '-0.01' ELSE clean_price::VARCHAR END AS price,
         CASE WHEN b = 17 THEN '0' WHEN b = 18 THEN '-10' WHEN b = 19 THEN '-50'
              ELSE clean_quantity::VARCHAR END AS quantity,
         buy AS buy_order_id, sell AS sell_order_id,
         CASE WHEN b BETWEEN 20 AND 22 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
              WHEN b BETWEEN 23 AND 24 THEN epoch_ms(l_shipdate)::VARCHAR
              WHEN b = 25 THEN 'not-a-date' ELSE iso END AS "timestamp"
  FROM lines
)"""

# Usable deliveries: the dirt of buckets 4 to 19 stops a row, bucket 25 has no timestamp.
_USABLE = (
    _LINES
    + f""",
usable AS (
  SELECT lines.*, id AS trade_id, p_brand AS instrument, clean_price AS price,
         clean_quantity AS quantity, buy AS buy_order_id, sell AS sell_order_id,
         CASE WHEN b = 25 THEN NULL ELSE iso END AS "timestamp"
  FROM lines WHERE b NOT BETWEEN 4 AND 19 AND clean_price > 0 AND clean_quantity > 0
),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY {_ARRIVAL}) AS copy FROM usable
  ) WHERE copy = 1
),
clean AS (SELECT * FROM firsts WHERE "timestamp" IS NOT NULL),
feed AS (
  SELECT *, row_number() OVER (ORDER BY {_ARRIVAL}) - 1 AS ingest_seq
  FROM usable WHERE "timestamp" IS NOT NULL
)"""
)


def _days(kind: str, column: str = '"timestamp"') -> str:
    tests = [
        f"({column} >= '{start}T00:00:00Z' AND {column} < '{end}T00:00:00Z')"
        for k, start, end in OUTAGE_DAYS
        if k == kind
    ]
    return "(" + " OR ".join(tests) + ")"


_CUT, _HALT = _days("PARTITION"), _days("HALT")

_STORES = (
    _USABLE
    + f""",
legacy AS (SELECT * FROM clean),
cloud AS (SELECT * FROM clean WHERE NOT {_CUT} AND NOT {_HALT})"""
)

# The dirtier feed: what each row holds after the identifier checks, and its numbers.
_DIRTY = (
    _LINES
    + """,
dirty AS (
  SELECT raw.* REPLACE (
    CASE WHEN b = 39 THEN 'none' WHEN b BETWEEN 4 AND 6 OR b = 40 THEN NULL ELSE id END AS trade_id,
    CASE WHEN b BETWEEN 7 AND 9 THEN NULL WHEN b = 27 THEN 'NaN' ELSE p_brand END AS instrument,
    CASE WHEN b = 28 THEN NULL ELSE buy END AS buy_order_id,
    CASE WHEN b = 29 THEN NULL ELSE sell END AS sell_order_id,
    CASE WHEN b BETWEEN 10 AND 13 THEN '' WHEN b = 30 THEN '1e3' WHEN b = 31 THEN '10d'
         WHEN b = 32 THEN 'inf' WHEN b = 33 THEN ' 12.5 ' ELSE price END AS price,
    CASE WHEN b = 34 THEN '0.5' WHEN b = 35 THEN '10.7' WHEN b = 36 THEN '1_000'
         ELSE quantity END AS quantity,
    CASE WHEN b = 37 THEN left(iso, 19) || '+02:00'
         WHEN b = 38 THEN strftime(l_shipdate, '%m/%d/%Y %H:%M')
         ELSE "timestamp" END AS "timestamp"),
    CASE WHEN b BETWEEN 10 AND 13 OR b IN (31, 32) THEN NULL WHEN b = 14 THEN -150.0
         WHEN b = 15 THEN 0.0 WHEN b = 16 THEN -0.01 WHEN b = 30 THEN 1000.0
         WHEN b = 33 THEN 12.5 ELSE clean_price END::DOUBLE AS price_number,
    CASE WHEN b = 17 THEN 0 WHEN b = 18 THEN -10 WHEN b = 19 THEN -50 WHEN b = 34 THEN 0.5
         WHEN b = 35 THEN 10.7 WHEN b = 36 THEN NULL ELSE clean_quantity END::DOUBLE
      AS quantity_number,
    CASE WHEN b = 25 THEN NULL WHEN b = 37 THEN strftime(l_shipdate - INTERVAL 2 HOUR, """
    + _ISO
    + """)
         ELSE iso END AS iso_timestamp
  FROM raw
),
marked AS (
  SELECT *, (trade_id IS NOT NULL AND instrument IS NOT NULL) AS has_ids,
         (trade_id IS NOT NULL AND instrument IS NOT NULL AND lower(instrument) <> 'nan'
          AND buy_order_id IS NOT NULL AND sell_order_id IS NOT NULL) AS has_strict_ids
  FROM dirty
)"""
)


def _dirty_cleanse(ids: str) -> str:
    return f"""WITH {_DIRTY},
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY {_ARRIVAL}) AS copy
    FROM marked WHERE {ids} AND price_number > 0 AND quantity_number > 0
  ) WHERE copy = 1
)
SELECT trade_id, instrument, price_number AS price, trunc(quantity_number)::INTEGER AS quantity,
       buy_order_id, sell_order_id, iso_timestamp AS "timestamp"
FROM firsts WHERE iso_timestamp IS NOT NULL"""


_RAW_COLUMNS = 'trade_id, instrument, price, quantity, buy_order_id, sell_order_id, "timestamp"'

# --- Audits and reports -----------------------------------------------------------------------


def _audit(n1: str, n2: str, v1: str, v2: str, status_on_count: bool = False) -> str:
    same = f"{n1} = {n2}" + ("" if status_on_count else f" AND {v1} = {v2}")
    return f"""{n1}::BIGINT AS legacy_count, {n2}::BIGINT AS cloud_count,
       abs({n1} - {n2})::BIGINT AS drift,
       CASE WHEN {same} THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS status,
       ({v1})::DOUBLE AS legacy_volume, ({v2})::DOUBLE AS cloud_volume,
       abs({v1} - {v2})::DOUBLE AS volume_difference, 0.0::DOUBLE AS data_loss_percentage"""


_VOLUME = "coalesce(sum(price::DECIMAL(15,2) * quantity), 0)::DECIMAL(36,2)"


def _totals(name: str, source: str) -> str:
    return f"{name} AS (SELECT count(*) AS n, {_VOLUME} AS v FROM {source})"


def _store_audit(count_only: bool = False) -> str:
    return f"""WITH {_STORES}, {_totals('lt', 'legacy')}, {_totals('ct', 'cloud')}
SELECT {_audit('lt.n', 'ct.n', 'lt.v', 'ct.v', count_only)} FROM lt, ct"""


def _label_columns(labels: dict[str, str]) -> str:
    return ", ".join(f"{_text(v)} AS {k}" for k, v in labels.items())


def _report(ctes: str, source: str) -> str:
    return f"""WITH {ctes}, {_totals('t', source)}
SELECT n AS total_reported_executions, v::DOUBLE AS total_notional_volume,
       CASE WHEN n > 0 THEN round(v::DOUBLE / n, 2) ELSE 0.0 END AS average_execution_value,
       {_label_columns(REPORT_LABELS)}
FROM t"""


def _reconciled(kept: str) -> str:
    """Summary after replaying the missing trades for which ``kept`` holds."""
    return f"""WITH {_STORES},
gone AS (SELECT * FROM legacy WHERE trade_id NOT IN (SELECT trade_id FROM cloud)),
back AS (SELECT * FROM gone WHERE {kept}),
healed AS (SELECT * FROM cloud UNION ALL SELECT * FROM back),
{_totals('lt', 'legacy')}, {_totals('ct', 'healed')}
SELECT (SELECT count(*) FROM back) AS replayed_count,
       (SELECT count(*) FROM gone) AS initial_missing_count,
       CASE WHEN lt.n = ct.n AND lt.v = ct.v THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS final_status,
       abs(lt.n - ct.n)::BIGINT AS final_drift, lt.n AS legacy_count, ct.n AS cloud_count,
       lt.v::DOUBLE AS legacy_volume, ct.v::DOUBLE AS cloud_volume,
       abs(lt.v - ct.v)::DOUBLE AS volume_difference
FROM lt, ct"""


# --- Outcomes ---------------------------------------------------------------------------------


def _ledger(source: str, halted: str, cut: str) -> str:
    """Outcome of each delivery: ``source`` with flags, then who took the first copy."""
    return f"""flagged AS (SELECT s.*, {halted} AS halted, {cut} AS cut_off FROM {source} s),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_seq) AS any_copy,
         CASE WHEN NOT halted AND NOT cut_off THEN
           count(*) FILTER (WHERE NOT halted AND NOT cut_off)
             OVER (PARTITION BY trade_id ORDER BY ingest_seq) END AS reached_copy
  FROM flagged
),
ledger AS (
  SELECT *, any_copy = 1 AS legacy_inserted, coalesce(reached_copy = 1, FALSE) AS cloud_inserted,
         CASE WHEN halted THEN 'HALTED' WHEN cut_off THEN 'DROPPED_BY_CHAOS'
              WHEN reached_copy = 1 THEN 'STORED' ELSE 'DUPLICATE_SKIPPED' END AS cloud_status
  FROM numbered
)"""


_DAY_LEDGER = _USABLE + ", " + _ledger("feed", _HALT, _CUT)

# --- Event trades and the control log ---------------------------------------------------------

_EVENT_TRADES = f"""
et AS (
  SELECT 'TRD-' || CASE WHEN event_id % 10 = 9 THEN event_id // 2 ELSE event_id END AS trade_id,
         event_type AS instrument, value::DECIMAL(15,2) AS price,
         (user_id % 500 + 1)::INTEGER AS quantity,
         'ORD-B-' || user_id AS buy_order_id, 'ORD-S-' || event_id AS sell_order_id,
         strftime(ts, {_ISO}) AS "timestamp", event_id AS ingest_seq, ts AS event_ts,
         count(*) OVER () AS n
  FROM events
)"""

_DRILL = (
    _EVENT_TRADES
    + ", "
    + _ledger(
        "(SELECT * FROM et WHERE instrument IS NOT NULL AND price > 0)",
        "ingest_seq >= 7 * n // 8 AND ingest_seq < 15 * n // 16",
        "ingest_seq >= n // 2 AND ingest_seq < 3 * n // 4",
    )
)

_CONTROL = f"""
control AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 97 = 96 THEN 'reset' WHEN event_type = 'click' THEN 'stream_toggle'
              WHEN event_type = 'error' THEN 'chaos_toggle' WHEN event_type = 'purchase' THEN 'cutover'
              WHEN event_type = 'signup' THEN 'rollback' ELSE 'set_rate' END AS action,
         trunc(value::DECIMAL(15,2))::INTEGER AS rate
  FROM events
),
epochs AS (
  SELECT *, count(*) FILTER (WHERE action = 'reset') OVER w AS stream_epoch,
         count(*) FILTER (WHERE action IN ('reset', 'rollback')) OVER w AS chaos_epoch,
         last_value(CASE WHEN action = 'cutover' THEN TRUE
                         WHEN action IN ('rollback', 'reset') THEN FALSE END IGNORE NULLS) OVER w AS cut,
         last_value(CASE WHEN action = 'rollback' THEN TRUE
                         WHEN action IN ('cutover', 'reset') THEN FALSE END IGNORE NULLS) OVER w AS back,
         last_value(CASE WHEN action = 'set_rate' THEN greatest(1, least(100, rate)) END IGNORE NULLS)
           OVER w AS last_rate
  FROM control WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)
),
state AS (
  SELECT seq, action,
         (count(*) FILTER (WHERE action = 'stream_toggle')
            OVER (PARTITION BY stream_epoch ORDER BY seq ROWS UNBOUNDED PRECEDING)) % 2 = 1 AS is_streaming,
         (count(*) FILTER (WHERE action = 'chaos_toggle')
            OVER (PARTITION BY chaos_epoch ORDER BY seq ROWS UNBOUNDED PRECEDING)) % 2 = 1 AS is_chaos_active,
         coalesce(cut, FALSE) AS is_cutover_active, coalesce(back, FALSE) AS is_rollback_active,
         coalesce(last_rate, 20)::INTEGER AS target_rate,
         CASE WHEN coalesce(cut, FALSE) THEN {_text(PRIMARY_CLOUD)}
              ELSE {_text(PRIMARY_LEGACY)} END AS active_primary
  FROM epochs
)"""

_CONTROL_OUTAGES = (
    _CONTROL
    + """,
turns AS (
  SELECT seq, is_chaos_active FROM (
    SELECT seq, is_chaos_active,
           coalesce(lag(is_chaos_active) OVER (ORDER BY seq), FALSE) AS was FROM state
  ) WHERE is_chaos_active <> was
),
outages AS (
  SELECT 'PARTITION' AS kind, seq AS "start",
         coalesce(next_seq, (SELECT count(*) FROM events)) AS "end"
  FROM (SELECT seq, is_chaos_active, lead(seq) OVER (ORDER BY seq) AS next_seq FROM turns)
  WHERE is_chaos_active
)"""
)


def _log_case() -> str:
    cases = [
        ("action = 'stream_toggle' AND is_streaming", LOG_STREAM_RESUMED),
        ("action = 'stream_toggle'", LOG_STREAM_PAUSED),
        ("action = 'chaos_toggle' AND is_chaos_active", LOG_CHAOS_ON),
        ("action = 'chaos_toggle'", LOG_CHAOS_OFF),
        ("action = 'cutover'", LOG_CUTOVER),
        ("action = 'rollback'", LOG_ROLLBACK),
        ("action = 'reset'", LOG_RESET),
    ]
    columns = []
    for i, name in enumerate(["tag", "type", "msg"]):
        whens = " ".join(f"WHEN {test} THEN {_text(parts[i])}" for test, parts in cases)
        columns.append(f'CASE {whens} END AS "{name}"')
    return ", ".join(columns)


_LOG = _CONTROL + f", log AS (SELECT seq, {_log_case()} FROM state WHERE action <> 'set_rate')"

_HOURS = """hours AS (
  SELECT epoch(date_trunc('hour', ts))::BIGINT AS bucket_start, count(*) AS trades
  FROM events GROUP BY 1
)"""

_ORDERS = f"""o AS (
  SELECT CASE WHEN o_orderkey % 41 = 0 THEN '   ' ELSE 'ORD-' || o_orderkey END AS order_id,
         CASE WHEN o_orderkey % 23 = 0 THEN 'HOLD' WHEN o_orderkey % 29 = 0 THEN ' BUY'
              WHEN o_orderkey % 4 = 0 THEN 'BUY' WHEN o_orderkey % 4 = 1 THEN 'sell'
              WHEN o_orderkey % 4 = 2 THEN 'buy' ELSE 'SELL' END AS side,
         CASE WHEN o_orderkey % 43 = 0 THEN chr(9) ELSE o_orderpriority END AS instrument,
         CASE WHEN o_orderkey % 31 = 0 THEN 0 WHEN o_orderkey % 37 = 0 THEN -1
              ELSE o_totalprice END::DECIMAL(15,2) AS price,
         CASE WHEN o_orderkey % 47 = 0 THEN 0 ELSE o_custkey % 500 + 1 END::INTEGER AS quantity,
         strftime(o_orderdate, {_ISO}) AS "timestamp",
         CASE WHEN o_orderkey % 5 > 0 THEN 'ACC-' || o_custkey END AS account_id,
         coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END, 'FILLED') AS status
  FROM orders
)"""


def _reasons(rules: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {test} THEN {_text(reason)} END" for reason, test in rules)
    return f"concat_ws('; ', {parts}) AS reject_reasons"


def _positive(name: str) -> tuple[str, str]:
    return (f"{name} must be strictly positive", f"({name} IS NULL OR {name} <= 0)")


def _filled(name: str) -> tuple[str, str]:
    column = '"timestamp"' if name == "timestamp" else name
    blank = f"({column} IS NULL OR trim({column}, chr(9) || ' ') = '')"
    return (f"{name} must be a non-empty string", blank)


_TRADE_RULES = [
    _filled("trade_id"),
    _filled("instrument"),
    _positive("price"),
    _positive("quantity"),
    _filled("buy_order_id"),
    _filled("sell_order_id"),
    _filled("timestamp"),
]
_ORDER_RULES = [
    _filled("order_id"),
    ("side must be BUY or SELL", "upper(side) NOT IN ('BUY', 'SELL')"),
    _filled("instrument"),
    _positive("price"),
    _positive("quantity"),
    _filled("timestamp"),
]

# The raw feed as typed trades: numbers from the values the texts were made of.
_TYPED = (
    _LINES
    + """,
typed AS (
  SELECT trade_id, instrument,
         CASE WHEN price = '' THEN NULL ELSE price::DECIMAL(15,2) END AS price,
         quantity::INTEGER AS quantity, buy_order_id, sell_order_id, "timestamp"
  FROM raw
)"""
)

_PAYLOADS = (
    _USABLE
    + """,
sent AS (SELECT *, (l_orderkey * 5 + l_linenumber * 11) % 50 AS pb FROM clean),
received AS (
  SELECT trade_id AS source_id,
         CASE WHEN pb <> 1 THEN trade_id END AS trade_id,
         CASE WHEN pb <> 1 THEN instrument END AS instrument,
         CASE WHEN pb NOT IN (1, 2) THEN price END::DOUBLE AS price,
         CASE WHEN pb = 1 THEN NULL WHEN pb = 3 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN pb <> 1 THEN buy_order_id END AS buy_order_id,
         CASE WHEN pb <> 1 THEN sell_order_id END AS sell_order_id,
         CASE WHEN pb <> 1 THEN "timestamp" END AS "timestamp",
         CASE pb WHEN 1 THEN 'malformed payload' WHEN 2 THEN 'missing price'
                 WHEN 3 THEN 'quantity must be strictly positive' ELSE '' END AS reject_reasons
  FROM sent
)"""
)

_PER_DAY = (
    _STORES
    + f""",
per_day AS (
  SELECT left("timestamp", 10) AS day, count(*) AS ln,
         count(*) FILTER (WHERE NOT {_CUT} AND NOT {_HALT}) AS cn,
         coalesce(sum(price * quantity), 0)::DECIMAL(36,2) AS lv,
         coalesce(sum(price * quantity) FILTER (WHERE NOT {_CUT} AND NOT {_HALT}), 0)::DECIMAL(36,2) AS cv
  FROM legacy GROUP BY 1
)"""
)


def _profile() -> str:
    names = ["trade_id", "instrument", "price", "quantity", "buy_order_id", "sell_order_id", "timestamp"]
    rows = [
        f"""SELECT count(*) AS total_rows, {i}::INTEGER AS column_index, '{c}' AS column_name,
       'string' AS column_type, count("{c}") AS present FROM raw"""
        for i, c in enumerate(names)
    ]
    return f"WITH {_LINES} " + " UNION ALL ".join(rows)


def oracle_catalog() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Scans and sinks
    sql["scan_raw_feed"] = f"WITH {_LINES} SELECT {_RAW_COLUMNS} FROM raw"
    sql["raw_feed_profile"] = _profile()
    sql["raw_feed_preview"] = f"WITH {_LINES} SELECT {_RAW_COLUMNS} FROM raw ORDER BY {_ARRIVAL} LIMIT 3"
    sql["csv_round_trip"] = f"WITH {_USABLE} SELECT {_TRADE} FROM clean"
    metrics = f"""WITH {_USABLE}, k AS (SELECT count(*) AS kept FROM clean),
a AS (SELECT count(*) AS n FROM lineitem)
SELECT n AS initial_records, kept AS retained_records, n - kept AS dropped_records,
       round(100.0::DOUBLE * (n - kept) / n, 2) AS dropped_pct FROM a, k"""
    sql["cleanse_to_csv"] = metrics
    sql["cleanse_metrics"] = metrics
    sql["json_payload_ingest"] = f"WITH {_PAYLOADS} SELECT * FROM received"
    sql["store_scan"] = f"WITH {_STORES} SELECT {_TRADE}, TRUE AS is_stamped FROM legacy"
    sql["eod_json"] = _report(_STORES, "cloud")

    # Cleansing
    sql["filter_blank_ids"] = f"WITH {_DIRTY} SELECT {_RAW_COLUMNS} FROM marked WHERE has_ids"
    sql["filter_blank_ids_strict"] = (
        f"WITH {_DIRTY} SELECT {_RAW_COLUMNS} FROM marked WHERE has_strict_ids"
    )
    sql["coerce_numeric"] = f"""WITH {_DIRTY}
SELECT l_orderkey AS arr_order, l_linenumber AS arr_line, price_number AS price,
       quantity_number AS quantity FROM marked"""
    sql["positive_trades"] = f"""WITH {_DIRTY}
SELECT l_orderkey AS arr_order, l_linenumber AS arr_line, price_number AS price,
       trunc(quantity_number)::INTEGER AS quantity
FROM marked WHERE price_number > 0 AND quantity_number > 0"""
    sql["normalize_timestamps"] = f"""
SELECT event_id,
       CASE event_id % 24
         WHEN 4 THEN strftime(ts - INTERVAL 2 HOUR, {_ISO})
         WHEN 5 THEN strftime(date_trunc('minute', ts), {_ISO})
         WHEN 6 THEN strftime(date_trunc('day', ts), {_ISO})
         WHEN 7 THEN NULL WHEN 8 THEN NULL
         WHEN 10 THEN strftime(date_trunc('day', ts), {_ISO})
         WHEN 11 THEN NULL
         WHEN 13 THEN strftime(date_trunc('minute', ts), {_ISO})
         WHEN 14 THEN NULL WHEN 15 THEN NULL
         WHEN 16 THEN strftime(date_trunc('day', ts), {_ISO})
         WHEN 17 THEN strftime(date_trunc('minute', ts), {_ISO})
         WHEN 21 THEN strftime(date_trunc('day', ts), {_ISO})
         WHEN 22 THEN strftime(date_trunc('day', ts), {_ISO})
         ELSE strftime(date_trunc('second', ts), {_ISO}) END AS "timestamp"
FROM events"""
    sql["dedup_keep_first"] = f"WITH {_USABLE} SELECT {_TRADE} FROM firsts"
    sql["cleanse_from_csv"] = f"WITH {_USABLE} SELECT {_TRADE} FROM clean"
    sql["cleanse_from_mixed_headers"] = f"""WITH {_USABLE}, fits AS (
  SELECT * REPLACE (CASE WHEN l_suppkey % 4 = 2 THEN NULL ELSE buy_order_id END AS buy_order_id) FROM usable
  WHERE NOT (l_suppkey % 4 = 3 AND (id LIKE '%1' OR id LIKE '%2'))
), nth AS (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY l_suppkey % 4, {_ARRIVAL}) AS nth FROM fits)
SELECT {_TRADE}, NULL::VARCHAR AS reason FROM nth WHERE nth = 1 AND "timestamp" IS NOT NULL
UNION ALL SELECT NULL, NULL, NULL, count(*)::INTEGER, NULL, NULL, NULL,
  CASE WHEN trade_id LIKE '%1' THEN 'more' ELSE 'fewer' END || ' fields than the header' AS reason
FROM raw WHERE l_suppkey % 4 = 3 AND (trade_id LIKE '%1' OR trade_id LIKE '%2') GROUP BY ALL"""
    sql["cleanse_wide_numbers"] = """
SELECT 'TRD-' || o_orderkey AS trade_id, p AS price, q AS quantity,
  CASE WHEN big_p AND big_q THEN 'price is beyond the store''s range; quantity is beyond the store''s range'
       WHEN big_p THEN 'price is beyond the store''s range' WHEN big_q THEN 'quantity is beyond the store''s range'
       ELSE '' END AS reasons
FROM (SELECT o_orderkey, o_orderkey % 5 = 0 AS big_p, o_orderkey % 7 = 0 AS big_q,
  CASE WHEN o_orderkey % 5 = 0 THEN ('20000000000000' || o_totalprice::DECIMAL(15,2)::VARCHAR)::DOUBLE
       ELSE o_totalprice::DECIMAL(15,2)::DOUBLE END AS p,
  CASE WHEN o_orderkey % 7 = 0 THEN 3000000000 ELSE o_orderkey % 100 + 1 END::DOUBLE AS q FROM orders)"""
    sql["cleanse_trades"] = f"WITH {_USABLE} SELECT {_TRADE} FROM clean"
    sql["cleanse_trades_strict"] = _dirty_cleanse("has_strict_ids")
    sql["cleanse_trades_basic"] = _dirty_cleanse("has_ids")
    sql["rejects_by_rule"] = f"""WITH {_DIRTY}
SELECT CASE WHEN NOT has_strict_ids THEN 'identifier'
            WHEN price_number IS NULL OR quantity_number IS NULL THEN 'number'
            WHEN price_number <= 0 OR quantity_number <= 0 THEN 'positivity'
            ELSE 'usable' END AS rule, count(*) AS "rows"
FROM marked GROUP BY 1"""

    # Projections and checks
    sql["trade_notional"] = f"""WITH {_STORES}
SELECT trade_id, (price * quantity)::DOUBLE AS notional FROM legacy"""
    sql["order_notional"] = f"""WITH {_ORDERS}, c AS (SELECT *, {_reasons(_ORDER_RULES)} FROM o)
SELECT order_id, (price * quantity)::DOUBLE AS notional FROM c WHERE reject_reasons = ''"""
    sql["scalar_functions"] = f"""WITH {_ORDERS}
SELECT trim(order_id) AS stripped, lower(side) AS lower_side, upper(side) AS upper_side,
       abs(quantity - 250)::INTEGER AS absolute, round(price, 1)::DOUBLE AS rounded,
       greatest(1, least(100, quantity - 250))::INTEGER AS clamped,
       coalesce(account_id, 'none') AS account,
       CASE WHEN quantity - 250 > 0 THEN 1000.0::DOUBLE / (quantity - 250) ELSE 0.0 END AS guarded,
       contains(upper(instrument), 'HIGH') AS has_term,
       '00:00:00Z' AS time_of_day, format('{{:,.2f}}', price::DOUBLE) AS money,
       left("timestamp", 10) AS date_part
FROM o"""
    sql["validate_trades"] = f"""WITH {_TYPED}
SELECT {_TRADE}, {_reasons(_TRADE_RULES)} FROM typed"""
    sql["validate_orders"] = f"""WITH {_ORDERS}
SELECT * REPLACE (price::DOUBLE AS price), {_reasons(_ORDER_RULES)} FROM o"""
    sql["validate_instruments"] = f"""WITH i AS (
  SELECT p_partkey AS instrument_key,
         CASE WHEN p_partkey % 19 = 0 THEN ' ' ELSE p_brand END AS symbol,
         CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_name END AS name, p_type AS asset_class,
         CASE WHEN p_partkey % 3 = 0 THEN 0.01 WHEN p_partkey % 17 = 0 THEN 0.0
              ELSE 0.05 END::DOUBLE AS tick_size,
         CASE WHEN p_partkey % 4 = 0 THEN 1 WHEN p_partkey % 13 = 0 THEN -1
              ELSE p_size END::INTEGER AS lot_size
  FROM part)
SELECT *, {_reasons([_filled('symbol'), _filled('name'), _positive('tick_size'), _positive('lot_size')])}
FROM i"""
    split = ", ".join(
        f"CASE WHEN {test} THEN {_text(reason)} END" for reason, test in _TRADE_RULES
    )
    sql["quarantine_split"] = f"""WITH {_TYPED},
r AS (SELECT list_filter([{split}], lambda x: x IS NOT NULL) AS why FROM typed)
SELECT reason, count(*) AS "rows" FROM (
  SELECT unnest(why) AS reason FROM r UNION ALL SELECT 'accepted' FROM r WHERE len(why) = 0
) GROUP BY 1"""

    # Stores
    first_copies = f"""WITH {_USABLE}, held AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_seq) AS nth FROM feed)"""
    sql["idempotent_append"] = f"{first_copies} SELECT {_TRADE} FROM held WHERE nth = 1"
    sql["append_bucketed"] = sql["store_compacted"] = sql["idempotent_append"]
    sql["store_as_of"] = f"""{first_copies}, half AS (
  SELECT held.* FROM held, (SELECT count(*) AS n FROM feed) WHERE nth = 1 AND ingest_seq < n // 2)
SELECT {_TRADE}, count(*) OVER () AS trade_count, sum(price * quantity) OVER ()::DOUBLE AS volume FROM half"""
    sql["parity_by_digest"] = f"""WITH {_STORES}, {_totals('lt', 'legacy')}, {_totals('ct', 'cloud')},
apart AS (SELECT count(*) AS c FROM (SELECT trade_id FROM legacy EXCEPT SELECT trade_id FROM cloud)),
sides AS (SELECT 'cloud' AS against, ct.n, ct.v, c = 0 AS ids FROM ct, apart UNION ALL SELECT 'swapped', lt.n, lt.v, false FROM lt)
SELECT against, lt.n AS legacy_count, lt.v::DOUBLE AS legacy_volume, sides.n AS cloud_count, sides.v::DOUBLE AS cloud_volume,
  ids AS same_ids, lt.n = sides.n AND lt.v = sides.v AS same_totals,
  CASE WHEN ids AND lt.n = sides.n AND lt.v = sides.v THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS status FROM lt, sides"""
    sql["append_counts"] = f"""{first_copies}, h AS (
  SELECT count(*) FILTER (WHERE nth = 1 AND ingest_seq < n // 2) AS a,
         count(*) FILTER (WHERE nth = 1 AND ingest_seq >= n // 2) AS b
  FROM held, (SELECT count(*) AS n FROM feed))
SELECT 0::INTEGER AS batch_id, a AS added FROM h UNION ALL SELECT 1, b FROM h
UNION ALL SELECT 2, 0 UNION ALL SELECT 3, 0"""
    sql["store_point_lookup"] = f"""WITH {_STORES}
SELECT {_TRADE} FROM legacy WHERE trade_id = (SELECT max(trade_id) FROM legacy)"""
    sql["store_reset"] = f"""WITH {_STORES}, {_totals('t', 'legacy')}
SELECT 'loaded' AS step, n AS trade_count, v::DOUBLE AS volume FROM t
UNION ALL SELECT 'reset', 0, 0.0 UNION ALL SELECT 'loaded again', n, v::DOUBLE FROM t"""
    sql["store_totals"] = f"""WITH {_STORES}, {_totals('t', 'legacy')}
SELECT n AS trade_count, v::DOUBLE AS volume FROM t"""
    sql["store_ids"] = f"WITH {_STORES} SELECT DISTINCT trade_id FROM cloud"

    # Parity
    sql["parity_audit"] = _store_audit()
    sql["parity_count_only"] = _store_audit(count_only=True)
    sql["parity_by_batch_totals"] = _store_audit()
    sql["consistency_pct"] = f"""WITH {_STORES}, {_totals('lt', 'legacy')}, {_totals('ct', 'cloud')}
SELECT lt.n AS legacy_count, ct.n AS cloud_count,
       CASE WHEN lt.n = ct.n AND lt.v = ct.v THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS status,
       CASE WHEN lt.n = ct.n AND lt.v = ct.v THEN 100.0::DOUBLE
            ELSE greatest(0.0, least(100.0, 100.0::DOUBLE * ct.n / greatest(lt.n, 1))) END AS consistency_pct
FROM lt, ct"""
    gone = f"""WITH {_STORES}
SELECT trade_id FROM legacy EXCEPT SELECT trade_id FROM cloud"""
    sql["missing_ids"] = gone
    sql["missing_ids_subtract"] = gone
    sql["missing_ids_by_digest"] = gone

    # Outcomes and control state
    sql["feed_positions"] = f"""WITH {_USABLE}
SELECT ingest_seq, trade_id, price::DOUBLE AS price, "timestamp" FROM feed"""
    outcome = "ingest_seq, trade_id, legacy_inserted, cloud_inserted, cloud_status"
    sql["shadow_outcomes"] = f"WITH {_DAY_LEDGER} SELECT {outcome} FROM ledger"
    by_control = _ledger(
        "et",
        "FALSE",
        'EXISTS (SELECT 1 FROM outages WHERE s.ingest_seq >= "start" AND s.ingest_seq < "end")',
    )
    sql["shadow_outcomes_by_control"] = (
        f"WITH {_CONTROL_OUTAGES}, {_EVENT_TRADES}, {by_control} SELECT {outcome} FROM ledger"
    )
    sql["outcome_summary"] = f"""WITH {_DAY_LEDGER}
SELECT cloud_status, count(*) AS trades FROM ledger GROUP BY 1"""
    sql["enriched_feed"] = f"""WITH {_USABLE}
SELECT ingest_seq, {_TRADE}, 'STORED' AS legacy_status,
       CASE WHEN {_HALT} OR {_CUT} THEN 'DROPPED' ELSE 'STORED' END AS cloud_status FROM feed"""
    sql["running_parity"] = f"""WITH {_DAY_LEDGER}, r AS (
  SELECT ingest_seq + 1 AS processed, count(*) OVER () AS total,
         count(*) FILTER (WHERE legacy_inserted) OVER w AS ln,
         count(*) FILTER (WHERE cloud_inserted) OVER w AS cn,
         coalesce(sum(price * quantity) FILTER (WHERE legacy_inserted) OVER w, 0)::DECIMAL(36,2) AS lv,
         coalesce(sum(price * quantity) FILTER (WHERE cloud_inserted) OVER w, 0)::DECIMAL(36,2) AS cv
  FROM ledger WINDOW w AS (ORDER BY ingest_seq ROWS UNBOUNDED PRECEDING))
SELECT processed, {_audit('ln', 'cn', 'lv', 'cv')}
FROM r WHERE processed % {CHECKPOINT_EVERY} = 0 OR processed = total"""
    sql["overlapping_outages"] = f"""WITH {_EVENT_TRADES}, spans AS (
  SELECT ingest_seq AS a, ingest_seq + ingest_seq % 14 AS b FROM et WHERE ingest_seq % 10 = 3)
SELECT trade_id, CASE WHEN ingest_seq % 20 <> 7 THEN ingest_seq END AS ingest_seq,
  ingest_seq % 20 <> 7 AND EXISTS (SELECT 1 FROM spans WHERE ingest_seq >= a AND ingest_seq < b) AS cut_off
FROM et"""
    sql["control_state"] = f"WITH {_CONTROL} SELECT * FROM state"
    sql["outage_intervals"] = f"WITH {_CONTROL_OUTAGES} SELECT * FROM outages"
    sql["audit_tail"] = f"WITH {_LOG} SELECT * FROM log ORDER BY seq DESC LIMIT 8"

    # Reconciliation
    sql["replay_candidates"] = f"""{first_copies},
gone AS (SELECT trade_id FROM clean WHERE {_CUT} OR {_HALT})
SELECT {_TRADE} FROM held WHERE nth = 1 AND trade_id IN (SELECT trade_id FROM gone)"""
    sql["reconcile_from_backlog"] = _reconciled("TRUE")
    sql["reconcile_from_dead_letters"] = _reconciled(_CUT)
    sql["report_after_replay"] = _report(_STORES, "legacy")
    sql["reconcile_message"] = f"""WITH one AS ({_reconciled("TRUE")})
SELECT 1::BIGINT AS seq, 'RECON' AS tag, 'success' AS "type",
  'Idempotent replay restored ' || replayed_count || ' missing trades. Parity: ' || final_status || '.' AS msg FROM one"""
    sql["kafka_records_decoded"] = f"""WITH {_EVENT_TRADES}, r AS (
  SELECT *, ingest_seq % 50 <> 1 AND coalesce(instrument IS NOT NULL AND price > 0, FALSE) AS ok FROM et)
SELECT (ingest_seq % 4) * 281474976710656 + ingest_seq // 4 AS ingest_seq, CASE WHEN ok THEN trade_id END AS trade_id,
  ok AS is_accepted, CASE WHEN ok THEN floor(epoch(ts0))::BIGINT END AS event_seconds
FROM (SELECT *, event_ts AS ts0 FROM r)"""
    columns = "replayed_count, initial_missing_count, final_status, final_drift, legacy_count, cloud_count, legacy_volume, cloud_volume, volume_difference"
    sql["reconcile_repeated"] = f"""WITH one AS ({_reconciled("TRUE")})
SELECT {columns}, 0::INTEGER AS replay FROM one
UNION ALL SELECT 0, 0, final_status, final_drift, legacy_count, cloud_count, legacy_volume, cloud_volume, volume_difference, 1 FROM one
UNION ALL SELECT 0, 0, final_status, final_drift, legacy_count, cloud_count, legacy_volume, cloud_volume, volume_difference, 2 FROM one"""
    sql["reconcile_two_outages"] = f"""WITH one AS ({_reconciled(_CUT)}), whole AS ({_reconciled("TRUE")})
SELECT {columns}, 0::INTEGER AS replay FROM one
UNION ALL SELECT whole.replayed_count - one.replayed_count, whole.replayed_count - one.replayed_count, whole.final_status,
  whole.final_drift, whole.legacy_count, whole.cloud_count, whole.legacy_volume, whole.cloud_volume, whole.volume_difference, 1
FROM one, whole"""
    halted = "ingest_seq >= (SELECT count(*) FROM feed) // 3"
    sql["failback_proof"] = f"""WITH {_USABLE}, {_ledger('feed', halted, 'FALSE')},
c AS (SELECT count(DISTINCT trade_id) AS d, count(*) FILTER (WHERE legacy_inserted) AS p,
             count(*) FILTER (WHERE cloud_inserted) AS s FROM ledger)
SELECT d AS feed_trades, p AS primary_trades, s AS shadow_trades, 0::BIGINT AS lost_trades,
       p - s AS shadow_behind, 0::BIGINT AS shadow_only, p = d AS zero_loss FROM c"""

    # Reports and views
    sql["eod_report"] = _report(_USABLE, "clean")
    sql["eod_report_from_store"] = _report(_STORES, "cloud")
    sql["eod_export"] = f"""WITH {_STORES}, {_totals('t', 'cloud')}
SELECT '{EXPORT_ID_PREFIX}{EXPORTED_AT_MS}' AS report_id, '2026-10-01T09:30:00.250Z' AS generated_at,
       n AS total_executed_trades, v::DOUBLE AS aggregate_notional_volume,
       CASE WHEN n > 0 THEN v::DOUBLE / n ELSE 0.0 END AS average_trade_value,
       0.0::DOUBLE AS data_loss_percentage, {_label_columns(EXPORT_LABELS)} FROM t"""
    sql["recent_trades"] = f"""WITH {_EVENT_TRADES}
SELECT ingest_seq, {_TRADE} FROM et ORDER BY ingest_seq DESC LIMIT 15"""
    sql["recent_per_instrument"] = f"""WITH {_EVENT_TRADES}
SELECT * FROM (SELECT instrument,
    row_number() OVER (PARTITION BY instrument ORDER BY ingest_seq DESC)::INTEGER AS recency,
    ingest_seq, trade_id FROM et) WHERE recency <= 40"""
    sql["stream_prefix"] = f"WITH {_USABLE} SELECT ingest_seq, {_TRADE} FROM feed WHERE ingest_seq < 1000"
    sql["phase_cuts"] = f"""WITH {_USABLE}, c AS (SELECT count(*) AS n FROM feed)
SELECT n AS total, least(150, n // 2)::BIGINT AS outage_start,
       least(250, floor(n * 0.75))::BIGINT AS outage_end FROM c"""
    matches = "contains(upper(instrument), 'BRAND#1')"
    sql["feed_filter"] = f"WITH {_USABLE} SELECT ingest_seq, trade_id, instrument FROM feed WHERE {matches}"
    sql["feed_filter_count"] = f"WITH {_USABLE} SELECT count(*) AS executions FROM feed WHERE {matches}"
    sql["feed_display"] = f"""WITH {_STORES}
SELECT trade_id, instrument, '$' || price::VARCHAR AS price_text, quantity,
       '$' || format('{{:,.2f}}', (price * quantity)::DOUBLE) AS volume_text,
       split_part("timestamp", 'T', 2) AS time_text FROM legacy"""
    sql["throughput"] = f"WITH {_HOURS} SELECT * FROM hours"
    sql["stream_throughput"] = sql["throughput"]
    sql["stream_throughput_windowed"] = f"""WITH {_EVENT_TRADES}, d AS (
  SELECT date_trunc('hour', event_ts) AS h, event_ts,
    CASE WHEN ingest_seq < n // 2 AND ingest_seq % 10 <> 3 THEN 0 WHEN ingest_seq < 3 * n // 4 THEN 1 ELSE 2 END AS part
  FROM et),
marks AS (SELECT p, (SELECT max(event_ts) FROM d WHERE part <= p) - INTERVAL 1 DAY AS mark FROM range(3) t(p))
SELECT epoch(h)::BIGINT AS bucket_start,
  count(*) FILTER (WHERE mark IS NULL OR h + INTERVAL 1 HOUR > mark) AS trades,
  count(*) FILTER (WHERE h + INTERVAL 1 HOUR <= mark) AS late,
  h + INTERVAL 1 HOUR > (SELECT max(mark) FROM marks) AS is_open
FROM d LEFT JOIN marks ON p = part - 1 GROUP BY h"""
    sql["control_state_incremental"] = sql["control_state"]
    sql["running_parity_incremental"] = sql["running_parity"]
    sql["stream_identity_state"] = f"WITH {_DRILL} SELECT {_TRADE} FROM ledger WHERE legacy_inserted"
    sql["stream_topic_quarantine"] = f"""WITH {_EVENT_TRADES}, r AS (
  SELECT *, (ingest_seq % 4) * 281474976710656 + ingest_seq // 4 AS place,
    ingest_seq % 50 <> 1 AND coalesce(instrument IS NOT NULL AND price > 0, FALSE) AS ok FROM et)
SELECT place AS ingest_seq, CASE WHEN NOT ok THEN 'refused'
  WHEN row_number() OVER (PARTITION BY ok, trade_id ORDER BY place) = 1 THEN 'stored' ELSE 'duplicate' END AS outcome FROM r"""
    sql["throughput_trailing"] = f"""WITH {_HOURS}
SELECT bucket_start, trades, string_agg(trades::VARCHAR, ',' ORDER BY bucket_start) OVER w AS history,
       greatest(max(trades) OVER w, 60) AS peak
FROM hours WINDOW w AS (ORDER BY bucket_start RANGE BETWEEN 104400 PRECEDING AND CURRENT ROW)"""
    sql["transaction_report"] = f"""WITH {_STORES}, isin_of AS (
  SELECT p_brand AS symbol, CASE WHEN p_brand NOT LIKE '%5'
         THEN 'XN' || lpad(min(p_partkey)::VARCHAR, 10, '0') END AS isin FROM part GROUP BY 1)
SELECT trade_id, '{VENUE_MIC}' AS venue_mic, instrument, isin, buy_order_id AS buyer_id,
       sell_order_id AS seller_id, price::DOUBLE AS price, quantity,
       (price * quantity)::DOUBLE AS notional, "timestamp" AS executed_at
FROM legacy LEFT JOIN isin_of ON symbol = instrument"""
    sql["order_audit_trail"] = f"""WITH {_STORES}
SELECT buy_order_id AS order_id, 'BUY' AS side, trade_id, instrument, price::DOUBLE AS price, quantity,
       "timestamp" FROM legacy
UNION ALL SELECT sell_order_id, 'SELL', trade_id, instrument, price::DOUBLE, quantity, "timestamp"
FROM legacy"""
    sql["daily_parity"] = f"""WITH {_PER_DAY}
SELECT day, {_audit('ln', 'cn', 'lv', 'cv')} FROM per_day"""
    sql["cutover_gate"] = f"""WITH {_PER_DAY},
placed AS (SELECT ln = cn AND lv = cv AS good, row_number() OVER (ORDER BY day) AS place FROM per_day),
runs AS (SELECT count(*) AS days FROM (
  SELECT place - row_number() OVER (ORDER BY place) AS island FROM placed WHERE good) GROUP BY island)
SELECT coalesce(max(days), 0) AS longest_run_days, coalesce(max(days), 0) >= 7 AS cutover_ready
FROM runs"""

    # Streams
    sql["dual_ingest_drill"] = f"""WITH {_DRILL}
SELECT trade_id, bool_or(legacy_inserted) AS in_legacy, bool_or(cloud_inserted) AS in_cloud
FROM ledger GROUP BY 1 HAVING bool_or(legacy_inserted)"""
    sql["stream_idempotent_load"] = f"WITH {_DRILL} SELECT {_TRADE} FROM ledger WHERE legacy_inserted"
    sql["stream_shadow_outage"] = f"WITH {_DRILL} SELECT {_TRADE} FROM ledger WHERE cloud_inserted"
    sql["stream_dead_letter"] = f"""WITH {_EVENT_TRADES}
SELECT ingest_seq, {_TRADE} FROM et WHERE ingest_seq >= n // 2 AND ingest_seq < 3 * n // 4"""
    sql["dead_letters_acknowledged"] = f"""WITH {_DRILL}
SELECT ingest_seq, {_TRADE} FROM ledger WHERE cut_off AND NOT halted AND trade_id LIKE '%7'
  AND trade_id NOT IN (SELECT trade_id FROM ledger WHERE cloud_inserted)"""
    sql["stream_dead_letters_replayed"] = f"""WITH {_DRILL},
legacy AS (SELECT * FROM ledger WHERE legacy_inserted),
cloud AS (SELECT * FROM ledger WHERE cloud_inserted),
gone AS (SELECT * FROM legacy WHERE trade_id NOT IN (SELECT trade_id FROM cloud)),
letters AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_seq) AS nth FROM ledger
  WHERE cut_off AND NOT halted),
back AS (SELECT trade_id, price, quantity FROM letters
         WHERE nth = 1 AND trade_id IN (SELECT trade_id FROM gone)),
healed AS (SELECT trade_id, price, quantity FROM cloud UNION ALL SELECT * FROM back),
{_totals('lt', 'legacy')}, {_totals('ct', 'healed')}
SELECT (SELECT count(*) FROM back) AS replayed_count,
       (SELECT count(*) FROM gone) AS initial_missing_count,
       CASE WHEN lt.n = ct.n AND lt.v = ct.v THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS final_status,
       abs(lt.n - ct.n)::BIGINT AS final_drift, lt.n AS legacy_count, ct.n AS cloud_count,
       lt.v::DOUBLE AS legacy_volume, ct.v::DOUBLE AS cloud_volume,
       abs(lt.v - ct.v)::DOUBLE AS volume_difference, 0::BIGINT AS letters_left
FROM lt, ct"""
    sql["dead_letters_retried"] = f"""WITH {_DRILL}, first_in AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY CASE WHEN cloud_inserted THEN 0 ELSE 1 END, ingest_seq) AS nth
  FROM ledger WHERE cloud_inserted OR (cut_off AND NOT halted AND trade_id IN (SELECT trade_id FROM ledger WHERE legacy_inserted)))
SELECT {_TRADE} FROM first_in WHERE nth = 1"""
    sql["stream_two_topics_one_store"] = f"""WITH {_EVENT_TRADES}, given AS (
  SELECT *, 0 AS topic FROM et WHERE ingest_seq < n // 2 UNION ALL SELECT *, 1 FROM et WHERE ingest_seq >= n // 4),
first_in AS (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY topic, ingest_seq) AS nth FROM given
  WHERE instrument IS NOT NULL AND price > 0)
SELECT {_TRADE} FROM first_in WHERE nth = 1"""
    sql["stream_fresh_checkpoint"] = f"""WITH {_EVENT_TRADES}
SELECT DISTINCT trade_id FROM et WHERE instrument IS NOT NULL AND price > 0"""
    sql["stream_outcomes"] = f"""WITH {_DRILL}
SELECT ingest_seq, trade_id, cloud_status FROM ledger WHERE NOT halted AND NOT cut_off
UNION ALL SELECT ingest_seq, trade_id, CASE WHEN ingest_seq >= 7 * n // 8 AND ingest_seq < 15 * n // 16 THEN 'HALTED' ELSE 'DROPPED_BY_CHAOS' END
FROM et WHERE (ingest_seq >= 7 * n // 8 AND ingest_seq < 15 * n // 16) OR (ingest_seq >= n // 2 AND ingest_seq < 3 * n // 4)
UNION ALL SELECT ingest_seq, trade_id, 'REFUSED' FROM et
WHERE NOT (coalesce(instrument IS NOT NULL AND price > 0, FALSE))
  AND NOT (ingest_seq >= 7 * n // 8 AND ingest_seq < 15 * n // 16) AND NOT (ingest_seq >= n // 2 AND ingest_seq < 3 * n // 4)"""
    sql["stream_parity_log"] = f"""WITH {_DRILL}, parts AS (
  SELECT i AS batch_id, (i + 1) * n // 4 AS upto
  FROM range(4) r(i), (SELECT count(*) AS n FROM events)),
sums AS (
  SELECT batch_id, count(*) FILTER (WHERE legacy_inserted) AS ln,
         count(*) FILTER (WHERE cloud_inserted) AS cn,
         coalesce(sum(price * quantity) FILTER (WHERE legacy_inserted), 0)::DECIMAL(36,2) AS lv,
         coalesce(sum(price * quantity) FILTER (WHERE cloud_inserted), 0)::DECIMAL(36,2) AS cv
  FROM parts JOIN ledger ON ingest_seq < upto GROUP BY 1)
SELECT batch_id, {_audit('ln', 'cn', 'lv', 'cv')} FROM sums"""
    whole = f"""WITH {_EVENT_TRADES}, first_copy AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY ingest_seq) AS nth FROM et
  WHERE price > 0),
t AS (SELECT count(*) AS n, coalesce(sum(price * quantity), 0)::DECIMAL(36,2) AS v
      FROM first_copy WHERE nth = 1)"""
    sql["stream_dual_fanout"] = f"{whole} SELECT {_audit('n', 'n', 'v', 'v')} FROM t"
    sql["stream_redelivery"] = f"""{whole}
SELECT 1::INTEGER AS delivery, n AS trade_count, v::DOUBLE AS volume FROM t
UNION ALL SELECT 2, n, v::DOUBLE FROM t"""
    sql["stream_quarantine"] = f"""WITH {_PAYLOADS}
SELECT CASE WHEN reject_reasons = '' THEN 'stored' ELSE reject_reasons END AS outcome,
       count(*) AS "rows" FROM received GROUP BY 1"""
    sql["telemetry_snapshot"] = f"""WITH {_DRILL}, {_LOG.lstrip()},
{_totals('lt', '(SELECT * FROM ledger WHERE legacy_inserted)')},
{_totals('ct', '(SELECT * FROM ledger WHERE cloud_inserted)')},
now_state AS (SELECT * FROM state ORDER BY seq DESC LIMIT 1),
shown AS (
  SELECT trade_id, ingest_seq,
         CASE WHEN (ingest_seq >= n // 2 AND ingest_seq < 3 * n // 4)
                OR (ingest_seq >= 7 * n // 8 AND ingest_seq < 15 * n // 16)
              THEN 'DROPPED' ELSE 'STORED' END AS cloud_status
  FROM et ORDER BY ingest_seq DESC LIMIT 15),
tail AS (SELECT * FROM log ORDER BY seq DESC LIMIT 8),
{_HOURS}
SELECT lt.n AS legacy_count, ct.n AS cloud_count, abs(lt.n - ct.n)::BIGINT AS drift,
       CASE WHEN lt.n = ct.n AND lt.v = ct.v THEN 'IN_PARITY' ELSE 'DRIFT_DETECTED' END AS status,
       lt.v::DOUBLE AS legacy_volume, ct.v::DOUBLE AS cloud_volume,
       abs(lt.v - ct.v)::DOUBLE AS volume_difference,
       is_streaming, is_chaos_active, is_cutover_active,
       (SELECT trades FROM hours ORDER BY bucket_start DESC LIMIT 1) AS tps,
       ct.n AS total_reported_executions, ct.v::DOUBLE AS total_notional_volume,
       round(ct.v::DOUBLE / ct.n, 2) AS average_execution_value,
       (SELECT string_agg(trade_id || ' ' || cloud_status, ', ' ORDER BY ingest_seq DESC) FROM shown)
         AS latest_trades,
       (SELECT string_agg(tag || ':' || type || ':' || msg, ' | ' ORDER BY seq) FROM tail) AS recent_logs
FROM lt, ct, now_state"""
    return sql
