"""Every query by name. Each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import clamp, divide_or_zero, money_text, notional
from twinledger.functions.text import contains_ignore_case, strip_ws, time_of_day
from twinledger.functions.timestamps import normalize_iso8601
from twinledger.operators import cleanse, controls, ledger, outcomes, parity, reconcile, reporting
from twinledger.operators import store as stores
from twinledger.operators import validate
from twinledger.operators.ordering import block_width, keep_first
from twinledger.plans.drills import DrillTables, dual_ingestion, slices_of
from twinledger.schema import RAW_FEED, TRADE_COLUMNS
from twinledger.session import materialize, scratch_dir, use_utc
from twinledger.sources import feeds, payloads, samples, topics
from twinledger.streaming import carried, loads, telemetry

Query = Callable[[SparkSession, str], DataFrame]

ARRIVAL = samples.ARRIVAL
CHECKPOINT_EVERY = 250
LINES_PER_FILE = 1_000_000
TERM = " brand#1 "
EXPORTED_AT_MS = 1_790_847_000_250

_catalog: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query. Decimals are shown as doubles, so that both engines print them alike."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(use_utc(spark), sf_dir.rstrip("/"))
        decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df

    shown.__name__ = build.__name__
    shown.__doc__ = build.__doc__
    _catalog[build.__name__] = shown
    return build


def query_catalog() -> dict[str, Query]:
    return dict(_catalog)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog["eod_report"](spark, sf_dir)


def _reasons_text(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reasons", F.array_join("reject_reasons", "; "))


def _trades(df: DataFrame) -> DataFrame:
    return df.select(*TRADE_COLUMNS)


# --- Scans and sinks --------------------------------------------------------------------------


@query
def scan_raw_feed(spark, sf):
    """Raw CSV, every column as text. CSV does not tell empty from missing; both show as empty."""
    path = scratch_dir(spark, "raw_csv")
    feeds.write_trades(_trades(samples.raw_trades(spark, sf)), path, "csv")
    return feeds.read_raw_csv(spark, path).fillna("", RAW_FEED.fieldNames())


@query
def raw_feed_profile(spark, sf):
    return feeds.dataset_summary(_trades(samples.raw_trades(spark, sf)))


@query
def raw_feed_preview(spark, sf):
    return _trades(feeds.preview(samples.raw_trades(spark, sf), ARRIVAL))


@query
def csv_round_trip(spark, sf):
    """Cleansed trades written as CSV, read back, typed and checked."""
    path = scratch_dir(spark, "cleansed_csv")
    cleanse.write_cleansed_csv(_trades(samples.clean_trades(spark, sf)), path)
    typed = feeds.read_trades_csv(spark, path)
    good, _ = validate.split_checked(validate.with_trade_reasons(typed))
    return good


@query
def cleanse_to_csv(spark, sf):
    """The whole cleansing run with its metrics, taken in the same pass as the write."""
    m = cleanse.cleanse_feed(
        samples.raw_trades(spark, sf), ARRIVAL, scratch_dir(spark, "cleansed_csv")
    )
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(m[c]).cast("long").alias(c) for c in list(m)[:3]],
        F.lit(m["dropped_pct"]).cast("double").alias("dropped_pct"),
    )


@query
def json_payload_ingest(spark, sf):
    parsed = payloads.parse_payloads(samples.payloads(spark, sf))
    return _reasons_text(parsed.select("source_id", *TRADE_COLUMNS, "reject_reasons"))


@query
def kafka_records_decoded(spark, sf):
    """Records as a broker gives them, some cut short: positions by partition and offset, none lost."""
    decoded = topics.decode_records(samples.records(spark, sf))
    good = F.size("reject_reasons") == 0
    return decoded.select(
        "ingest_seq", F.when(good, F.col("trade_id")).alias("trade_id"), good.alias("is_accepted"),
        F.when(good, F.unix_seconds("event_ts")).alias("event_seconds"),
    )


@query
def store_scan(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return legacy.select(*TRADE_COLUMNS, F.col("created_at").isNotNull().alias("is_stamped"))


@query
def eod_json(spark, sf):
    """The report written as JSON and read back."""
    path = scratch_dir(spark, "eod_json")
    _, cloud = samples.stores(spark, sf)
    report = reporting.eod_report(cloud)
    payloads.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


# --- Cleansing --------------------------------------------------------------------------------


@query
def filter_blank_ids(spark, sf):
    return _trades(cleanse.drop_blank_ids(samples.dirty_trades(spark, sf), strict=False))


@query
def filter_blank_ids_strict(spark, sf):
    return _trades(cleanse.drop_blank_ids(samples.dirty_trades(spark, sf), strict=True))


@query
def coerce_numeric(spark, sf):
    dirty = samples.dirty_trades(spark, sf)
    return cleanse.coerce_numbers(dirty).select("arr_order", "arr_line", "price", "quantity")


@query
def positive_trades(spark, sf):
    numbers = cleanse.coerce_numbers(samples.dirty_trades(spark, sf))
    return cleanse.keep_positive(numbers).select("arr_order", "arr_line", "price", "quantity")


@query
def normalize_timestamps(spark, sf):
    texts = samples.text_timestamps(spark, sf)
    return texts.select("event_id", normalize_iso8601(F.col("timestamp")).alias("timestamp"))


@query
def dedup_keep_first(spark, sf):
    usable = cleanse.usable_trades(samples.raw_trades(spark, sf))
    return _trades(keep_first(usable, "trade_id", ARRIVAL))


@query
def cleanse_trades(spark, sf):
    return _trades(samples.clean_trades(spark, sf))


@query
def cleanse_trades_strict(spark, sf):
    """Four identifiers checked, on the dirtier feed."""
    return _trades(cleanse.cleanse_trades(samples.dirty_trades(spark, sf), ARRIVAL, strict=True))


@query
def cleanse_trades_basic(spark, sf):
    """Two identifiers checked, on the dirtier feed."""
    return _trades(cleanse.cleanse_trades(samples.dirty_trades(spark, sf), ARRIVAL, strict=False))


def _in_files(feed: DataFrame, files: int) -> DataFrame:
    """A feed in order of arrival, cut into as many files."""
    return feed.repartitionByRange(files, *ARRIVAL).sortWithinPartitions(*ARRIVAL)


@query
def cleanse_from_csv(spark, sf):
    """Several raw CSV files cleansed into CSV: the first copy of an id is the first by file and line."""
    raw, out = scratch_dir(spark, "raw_csv"), scratch_dir(spark, "cleansed_csv")
    feed = samples.raw_trades(spark, sf)
    ordered = _in_files(feed, max(4, feed.count() // LINES_PER_FILE))
    feeds.write_trades(_trades(ordered), raw, "csv")
    cleanse.cleanse_csv(spark, raw, out)
    return _trades(feeds.read_trades_csv(spark, out))


@query
def cleanse_from_mixed_headers(spark, sf):
    """Four folders of one feed, each with its own header: the usual one, another order and an unknown column, one identifier
    absent, and lines too long or too short. Cleansed trades, and the broken lines with their reasons."""
    raw, out = scratch_dir(spark, "mixed_csv"), scratch_dir(spark, "cleansed_csv")
    feed = samples.raw_trades(spark, sf)
    files = max(1, feed.count() // LINES_PER_FILE // 4)
    dealt = feed.withColumn("part", F.regexp_extract("sell_order_id", "[0-9]+", 0).cast("long") % 4)
    other = ["timestamp", "instrument", "quantity", "trade_id", "venue", "price", "sell_order_id", "buy_order_id"]
    header = {0: TRADE_COLUMNS, 1: other, 2: [c for c in TRADE_COLUMNS if c != "buy_order_id"], 3: TRADE_COLUMNS}
    for part, names in header.items():
        some = _in_files(dealt.filter(F.col("part") == part).withColumn("venue", F.lit("X")), files)
        if part < 3:
            feeds.write_trades(some.select(*names), f"{raw}/{part}", "csv")
        else:
            line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names])
            cut = F.when(F.col("trade_id").endswith("1"), F.concat(line, F.lit(",more"))).when(
                F.col("trade_id").endswith("2"), F.concat_ws(",", "trade_id", "instrument")
            )
            # The header as the name of a single column, and no separator in any line: each file gets its header, lines stay as they are.
            lines = some.select(F.coalesce(cut, line).alias(",".join(names)))
            as_is = {"header": True, "sep": "\x01", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            lines.write.options(**as_is).csv(f"{raw}/{part}")
    cleanse.cleanse_csv(spark, f"{raw}/*", out)
    clean = feeds.read_trades_csv(spark, out).select(*TRADE_COLUMNS, F.lit(None).cast("string").alias("reason"))
    broken = feeds.broken_lines(spark, f"{raw}/*").groupBy(F.col("line_reason").alias("reason")).agg(F.count("*").cast("int").alias("quantity"))
    return clean.unionByName(broken, allowMissingColumns=True)


@query
def cleanse_wide_numbers(spark, sf):
    """Numbers that are good but too large for a store are set aside with a reason, in full."""
    wide = samples.wide_trades(spark, sf)
    aside = cleanse.out_of_range(wide).select(
        "trade_id", F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"),
        F.array_join("reject_reasons", "; ").alias("reasons"),
    )
    kept = cleanse.usable_trades(wide).select(
        "trade_id", F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"),
        F.lit("").alias("reasons"),
    )
    return kept.unionByName(aside)


@query
def cleanse_metrics(spark, sf):
    raw = samples.raw_trades(spark, sf)
    return cleanse.cleanse_metrics(raw, cleanse.cleanse_trades(raw, ARRIVAL))


@query
def rejects_by_rule(spark, sf):
    return cleanse.rejects_by_rule(samples.dirty_trades(spark, sf))


# --- Projections and checks -------------------------------------------------------------------


@query
def trade_notional(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return legacy.select("trade_id", notional().alias("notional"))


@query
def order_notional(spark, sf):
    good = validate.accepted(validate.with_order_reasons(samples.orders(spark, sf)))
    return good.select("order_id", notional().alias("notional"))


@query
def scalar_functions(spark, sf):
    """Each scalar function on the order table."""
    o = samples.orders(spark, sf)
    half = F.col("quantity") - 250
    return o.select(
        strip_ws(F.col("order_id")).alias("stripped"),
        F.lower("side").alias("lower_side"),
        F.upper("side").alias("upper_side"),
        F.abs(half).alias("absolute"),
        F.round(F.col("price"), 1).alias("rounded"),
        clamp(half, 1, 100).alias("clamped"),
        F.coalesce("account_id", F.lit("none")).alias("account"),
        divide_or_zero(F.lit(1000.0), half).alias("guarded"),
        contains_ignore_case(F.col("instrument"), " high ").alias("has_term"),
        time_of_day(F.col("timestamp")).alias("time_of_day"),
        money_text(F.col("price")).alias("money"),
        F.get(F.split("timestamp", "T"), F.lit(0)).alias("date_part"),
    )


@query
def validate_trades(spark, sf):
    typed = feeds.to_trades(_trades(samples.raw_trades(spark, sf)))
    return _reasons_text(validate.with_trade_reasons(typed))


@query
def validate_orders(spark, sf):
    return _reasons_text(validate.with_order_reasons(samples.orders(spark, sf)))


@query
def validate_instruments(spark, sf):
    return _reasons_text(validate.with_instrument_reasons(samples.instruments(spark, sf)))


@query
def quarantine_split(spark, sf):
    """Good and set-aside trades, counted per reason."""
    typed = feeds.to_trades(_trades(samples.raw_trades(spark, sf)))
    good, bad = validate.split_checked(validate.with_trade_reasons(typed))
    sides = good.select(F.lit("accepted").alias("reason")).unionByName(
        bad.select(F.explode("reject_reasons").alias("reason"))
    )
    return sides.groupBy("reason").agg(F.count("*").alias("rows"))


# --- Stores -----------------------------------------------------------------------------------


def _halves(spark, sf):
    feed = samples.delivery_feed(spark, sf)
    n = feed.count()
    return slices_of(feed, [0, n // 2, n])


@query
def idempotent_append(spark, sf):
    """A feed in two batches, the second one tried twice: the first copy of each id is held."""
    path = samples.fresh_store(spark, "append")
    first, second = _halves(spark, sf)
    stores.append_idempotent(first, path, "load", 0, ["ingest_seq"])
    stores.append_idempotent(second, path, "load", 1, ["ingest_seq"])
    stores.append_idempotent(second, path, "load", 1, ["ingest_seq"])
    return _trades(stores.read_store(spark, path))


def _ledger(spark, name):
    path = scratch_dir(spark, name)
    ledger.create(spark, path)
    return path


@query
def append_bucketed(spark, sf):
    """The same in a store dealt into buckets: a half, a half, the first one again under a new number, the second one tried again."""
    path = _ledger(spark, "ledger")
    first, second = _halves(spark, sf)
    for batch, number in ((first, 0), (second, 1), (first, 2), (second, 1)):
        ledger.append(batch, path, "load", number, ["ingest_seq"])
    return _trades(ledger.read(spark, path))


@query
def store_as_of(spark, sf):
    """A store of two batches as it was after the first: its rows, and from the log its totals."""
    path = _ledger(spark, "ledger")
    for number, batch in enumerate(_halves(spark, sf)):
        ledger.append(batch, path, "load", number, ["ingest_seq"])
    then = ledger.read(spark, path, 1).crossJoin(F.broadcast(ledger.totals(spark, path, 1)))  # totals are one row
    return then.select(*TRADE_COLUMNS, "trade_count", "volume")


@query
def store_compacted(spark, sf):
    """A feed in ten batches, small folders written as one on the way and at the end, and what no version needs deleted."""
    path = _ledger(spark, "ledger")
    feed = samples.delivery_feed(spark, sf)
    n = feed.count()
    for number, batch in enumerate(slices_of(feed, [n * i // 10 for i in range(11)])):
        ledger.append(batch, path, "load", number, ["ingest_seq"])
    ledger.compact(spark, path)
    ledger.expire(spark, path, 1)
    return _trades(ledger.read(spark, path))


def _ledgers(spark, sf):
    """Both stores dealt into buckets."""
    paths = _ledger(spark, "legacy"), _ledger(spark, "cloud")
    for path, rows in zip(paths, samples.stores(spark, sf)):
        ledger.append(rows, path, "load", 0)
    return paths


@query
def missing_ids_by_digest(spark, sf):
    """Ids the cloud store lacks, looked for only in buckets whose digests differ."""
    return ledger.missing_ids(spark, *_ledgers(spark, sf))


@query
def parity_by_digest(spark, sf):
    """Both stores by their logs, and the legacy store against one of equal totals in which one id is another."""
    legacy, cloud = _ledgers(spark, sf)
    swapped = _ledger(spark, "swapped")
    rows = ledger.read(spark, legacy)
    least = rows.agg(F.min("trade_id").alias("least"))
    other = F.when(F.col("trade_id") == F.col("least"), F.lit("TRD-OTHER")).otherwise(F.col("trade_id"))
    ledger.append(rows.crossJoin(F.broadcast(least)).withColumn("trade_id", other), swapped, "load", 0)
    audits = [ledger.parity(spark, legacy, at).withColumn("against", F.lit(name)) for name, at in (("cloud", cloud), ("swapped", swapped))]
    return audits[0].unionByName(audits[1])


@query
def append_counts(spark, sf):
    """How many rows each append added; delivering a batch again adds none."""
    path = samples.fresh_store(spark, "append")
    first, second = _halves(spark, sf)
    added = [
        stores.append_idempotent(batch, path, "load", i, ["ingest_seq"])
        for i, batch in enumerate([first, second, first, second])
    ]
    steps = [
        F.struct(F.lit(i).alias("batch_id"), F.lit(n).cast("long").alias("added"))
        for i, n in enumerate(added)
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*steps)))


@query
def store_point_lookup(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    wanted = legacy.agg(F.max("trade_id")).first()[0]
    return _trades(stores.find_by_id(legacy, wanted))


@query
def store_reset(spark, sf):
    """Totals of a store when loaded, after a reset, and loaded again."""
    path = samples.fresh_store(spark, "reset")
    trades = _trades(samples.clean_trades(spark, sf))
    seen = []

    def look(step: str) -> None:
        n, v = parity.store_totals(stores.read_store(spark, path)).first()
        seen.append(
            F.struct(
                F.lit(step).alias("step"),
                F.lit(n).cast("long").alias("trade_count"),
                F.lit(v).cast("decimal(36,2)").cast("double").alias("volume"),
            )
        )

    stores.append_idempotent(trades, path, "load", 0, bulk=True)
    look("loaded")
    stores.reset_store(spark, path)
    look("reset")
    stores.append_idempotent(trades, path, "load", 0, bulk=True)
    look("loaded again")
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*seen)))


@query
def store_totals(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return parity.store_totals(legacy)


@query
def store_ids(spark, sf):
    _, cloud = samples.stores(spark, sf)
    return parity.store_ids(cloud)


# --- Parity -----------------------------------------------------------------------------------


@query
def parity_audit(spark, sf):
    return parity.parity_audit(*samples.stores(spark, sf))


@query
def parity_count_only(spark, sf):
    return parity.parity_audit(*samples.stores(spark, sf), count_only=True)


@query
def parity_by_batch_totals(spark, sf):
    legacy, cloud = samples.store_paths(spark, sf)
    return parity.parity_from_totals(
        stores.read_totals(spark, legacy), stores.read_totals(spark, cloud)
    )


@query
def consistency_pct(spark, sf):
    return parity.consistency_pct(parity.parity_audit(*samples.stores(spark, sf)))


@query
def missing_ids(spark, sf):
    return parity.missing_ids(*samples.stores(spark, sf))


@query
def missing_ids_subtract(spark, sf):
    return parity.missing_ids_by_subtract(*samples.stores(spark, sf))


# --- Outcomes and control state ---------------------------------------------------------------


def _day_ledger(spark, sf):
    feed = samples.delivery_feed(spark, sf)
    flagged = outcomes.flag_outages(feed, samples.outage_days(spark), axis="timestamp")
    return outcomes.outcome_ledger(flagged)


def _control_state(spark, sf):
    events = samples.control_events(spark, sf)
    return controls.control_state(events, block_width(events.count()))


def _control_outages(spark, sf):
    end = samples.table(spark, sf, "events").count()
    return controls.outage_intervals(_control_state(spark, sf), end, block_width(end))


@query
def feed_positions(spark, sf):
    """Usable deliveries numbered in order of arrival."""
    return samples.delivery_feed(spark, sf).select("ingest_seq", "trade_id", "price", "timestamp")


@query
def shadow_outcomes(spark, sf):
    """Outcome of each delivery under outages given as days."""
    return _day_ledger(spark, sf).select(
        "ingest_seq", "trade_id", "legacy_inserted", "cloud_inserted", "cloud_status"
    )


@query
def shadow_outcomes_by_control(spark, sf):
    """Outcome of each event trade under the many outages that the control log starts and ends."""
    feed = samples.event_trades(spark, sf)
    flagged = outcomes.flag_outages(
        feed, _control_outages(spark, sf), width=block_width(2 * feed.count())
    )
    return outcomes.outcome_ledger(flagged).select(
        "ingest_seq", "trade_id", "legacy_inserted", "cloud_inserted", "cloud_status"
    )


@query
def overlapping_outages(spark, sf):
    """Trades inside at least one of many outages that overlap each other, one trade in twenty
    without a position."""
    feed = samples.event_trades(spark, sf).select(
        "trade_id", F.when(F.col("ingest_seq") % 20 != 7, F.col("ingest_seq")).alias("ingest_seq")
    )
    spans = samples.event_trades(spark, sf).filter(F.col("ingest_seq") % 10 == 3).select(
        F.lit(outcomes.PARTITION).alias("kind"),
        F.col("ingest_seq").alias("start"),
        (F.col("ingest_seq") + F.col("ingest_seq") % 14).alias("end"),
    )
    flagged = outcomes.flag_outages(feed, spans)
    return flagged.select("trade_id", "ingest_seq", "cut_off")


@query
def outcome_summary(spark, sf):
    return outcomes.outcome_summary(_day_ledger(spark, sf))


@query
def enriched_feed(spark, sf):
    feed = samples.delivery_feed(spark, sf)
    flagged = outcomes.flag_outages(feed, samples.outage_days(spark), axis="timestamp")
    return outcomes.feed_record(flagged).select(
        "ingest_seq", *TRADE_COLUMNS, "legacy_status", "cloud_status"
    )


@query
def running_parity(spark, sf):
    """The audit after every 250 trades and at the end."""
    return outcomes.running_parity(_day_ledger(spark, sf), CHECKPOINT_EVERY)


@query
def control_state(spark, sf):
    return _control_state(spark, sf)


@query
def outage_intervals(spark, sf):
    return _control_outages(spark, sf)


@query
def audit_tail(spark, sf):
    """The last messages of the operator log."""
    return reporting.audit_log_tail(controls.log_messages(_control_state(spark, sf)))


# --- Reconciliation ---------------------------------------------------------------------------


def _cloud_copy(spark, sf) -> str:
    """A cloud store of the query's own, to replay into."""
    _, cloud = samples.stores(spark, sf)
    path = samples.fresh_store(spark, "cloud")
    stores.append_idempotent(_trades(cloud), path, "load", 0, bulk=True)
    return path


def _flat_summary(summary: DataFrame) -> DataFrame:
    return summary.select(
        "replayed_count",
        "initial_missing_count",
        "final_status",
        "final_drift",
        "final_audit.legacy_count",
        "final_audit.cloud_count",
        "final_audit.legacy_volume",
        "final_audit.cloud_volume",
        "final_audit.volume_difference",
    )


@query
def replay_candidates(spark, sf):
    missing = parity.missing_ids(*samples.stores(spark, sf))
    feed = samples.delivery_feed(spark, sf)
    return _trades(reconcile.replay_candidates(feed, missing, ["ingest_seq"]))


@query
def reconcile_from_backlog(spark, sf):
    """The whole feed as backlog: everything missing comes back."""
    legacy, _ = samples.store_paths(spark, sf)
    backlog = stores.read_store(spark, legacy)
    return _flat_summary(reconcile.reconcile(spark, legacy, _cloud_copy(spark, sf), backlog))


@query
def reconcile_from_dead_letters(spark, sf):
    """Only what an outage dropped: trades that came while the consumer was halted stay missing."""
    legacy, _ = samples.store_paths(spark, sf)
    dropped = stores.read_store(spark, legacy).filter(samples.during("PARTITION"))
    return _flat_summary(reconcile.reconcile(spark, legacy, _cloud_copy(spark, sf), dropped))


@query
def reconcile_repeated(spark, sf):
    """Three replays one after another: the second and third find nothing and lose nothing."""
    legacy, _ = samples.store_paths(spark, sf)
    cloud, backlog = _cloud_copy(spark, sf), stores.read_store(spark, legacy)
    return _flat_each([_done(reconcile.reconcile(spark, legacy, cloud, backlog)) for _ in range(3)])


@query
def reconcile_two_outages(spark, sf):
    """What the outages dropped comes back in one replay, what the halt lost in another."""
    legacy, _ = samples.store_paths(spark, sf)
    cloud, backlog = _cloud_copy(spark, sf), stores.read_store(spark, legacy)
    parts = [backlog.filter(samples.during(kind)) for kind in ("PARTITION", "HALT")]
    return _flat_each([_done(reconcile.reconcile(spark, legacy, cloud, part)) for part in parts])


def _done(summary: DataFrame) -> DataFrame:
    """A summary taken down at once, before the next replay changes the store that it audits."""
    return materialize(summary, "replay")


def _flat_each(summaries: list[DataFrame]) -> DataFrame:
    every = [_flat_summary(s).withColumn("replay", F.lit(i)) for i, s in enumerate(summaries)]
    out = every[0]
    for one in every[1:]:
        out = out.unionByName(one)
    return out


@query
def reconcile_message(spark, sf):
    """The operator log's message after a replay from the backlog."""
    legacy, _ = samples.store_paths(spark, sf)
    done = reconcile.reconcile(spark, legacy, _cloud_copy(spark, sf), stores.read_store(spark, legacy))
    return controls.reconciliation_message(done, 1)


@query
def report_after_replay(spark, sf):
    """Drift, replay, then the report from the shadow store."""
    legacy, _ = samples.store_paths(spark, sf)
    cloud = _cloud_copy(spark, sf)
    reconcile.reconcile(spark, legacy, cloud, stores.read_store(spark, legacy))
    return reporting.eod_report(stores.read_store(spark, cloud))


@query
def failback_proof(spark, sf):
    """The consumer halts a third of the way in; the primary must hold the whole feed."""
    feed = samples.delivery_feed(spark, sf)
    n = feed.count()
    halt = spark.range(0, 1, 1, 1).select(
        F.lit(outcomes.HALT).alias("kind"),
        F.lit(n // 3).cast("long").alias("start"),
        F.lit(n).cast("long").alias("end"),
    )
    ledger = outcomes.outcome_ledger(outcomes.flag_outages(feed, halt))
    ledger = materialize(ledger.select("trade_id", "legacy_inserted", "cloud_inserted"), "ledger")
    return reconcile.failback_proof(
        feed, ledger.filter("legacy_inserted"), ledger.filter("cloud_inserted")
    )


# --- Reports and views ------------------------------------------------------------------------


@query
def eod_report(spark, sf):
    """Cleanse a raw feed and report on it."""
    return reporting.eod_report(samples.clean_trades(spark, sf))


@query
def eod_report_from_store(spark, sf):
    _, cloud = samples.stores(spark, sf)
    return reporting.eod_report(cloud)


@query
def eod_export(spark, sf):
    _, cloud = samples.stores(spark, sf)
    return reporting.eod_export(cloud, EXPORTED_AT_MS)


@query
def recent_trades(spark, sf):
    feed = samples.event_trades(spark, sf)
    return reporting.recent_trades(feed).select("ingest_seq", *TRADE_COLUMNS)


@query
def recent_per_instrument(spark, sf):
    feed = samples.event_trades(spark, sf)
    return reporting.recent_per_group(feed, "instrument").select(
        "instrument", "recency", "ingest_seq", "trade_id"
    )


@query
def stream_prefix(spark, sf):
    """The first 1,000 trades of the stream, as the drill takes them."""
    return reporting.first_in_stream(samples.delivery_feed(spark, sf), 1000).select(
        "ingest_seq", *TRADE_COLUMNS
    )


@query
def phase_cuts(spark, sf):
    return reporting.phase_cuts(samples.delivery_feed(spark, sf))


@query
def feed_filter(spark, sf):
    feed = samples.delivery_feed(spark, sf)
    return reporting.filter_feed(feed, TERM).select("ingest_seq", "trade_id", "instrument")


@query
def feed_filter_count(spark, sf):
    return reporting.filter_feed_count(samples.delivery_feed(spark, sf), TERM)


@query
def feed_display(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return reporting.feed_display(legacy)


@query
def throughput(spark, sf):
    """Trades per hour."""
    buckets = reporting.throughput(samples.event_trades(spark, sf), "1 hour")
    return buckets.select(F.unix_seconds("bucket_start").alias("bucket_start"), "trades")


@query
def throughput_trailing(spark, sf):
    """Trades per hour with the trailing 30 hours and the peak of the trend line."""
    buckets = reporting.throughput(samples.event_trades(spark, sf), "1 hour")
    return reporting.trailing_throughput(buckets, 3600, block=100).select(
        F.unix_seconds("bucket_start").alias("bucket_start"),
        "trades",
        F.array_join(F.col("history").cast("array<string>"), ",").alias("history"),
        "peak",
    )


@query
def transaction_report(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return reporting.transaction_report(legacy, samples.isin_map(spark, sf))


@query
def order_audit_trail(spark, sf):
    legacy, _ = samples.stores(spark, sf)
    return reporting.ordered_audit_trail(legacy)


@query
def daily_parity(spark, sf):
    days = reporting.daily_parity(*samples.stores(spark, sf))
    return days.withColumn("day", F.col("day").cast("string"))


@query
def cutover_gate(spark, sf):
    return reporting.cutover_gate(reporting.daily_parity(*samples.stores(spark, sf)))


# --- Streams ----------------------------------------------------------------------------------


def _drill(spark, sf) -> DrillTables:
    """One dual-ingestion drill per session and folder; several queries read its tables."""

    def run() -> DrillTables:
        feed = samples.event_trades(spark, sf)
        n = feed.count()
        deliveries = slices_of(feed, samples.drill_cuts(n))
        return dual_ingestion(spark, deliveries, samples.drill_outages(spark, n))

    return samples.once(spark, sf, "drill", run)


@query
def dual_ingest_drill(spark, sf):
    """Both consumers over one topic, with an outage and a halt: which store holds which trade."""
    at = _drill(spark, sf)
    legacy = stores.read_store(spark, at.legacy).select("trade_id", F.lit(True).alias("in_legacy"))
    cloud = stores.read_store(spark, at.cloud).select("trade_id", F.lit(True).alias("in_cloud"))
    return legacy.join(cloud, "trade_id", "full").fillna(False, ["in_legacy", "in_cloud"])


@query
def stream_idempotent_load(spark, sf):
    return _trades(stores.read_store(spark, _drill(spark, sf).legacy))


@query
def stream_shadow_outage(spark, sf):
    return _trades(stores.read_store(spark, _drill(spark, sf).cloud))


@query
def stream_dead_letter(spark, sf):
    """Everything the outage dropped, copies included."""
    letters = reconcile.read_dead_letters(spark, _drill(spark, sf).dead_letters)
    return letters.select("ingest_seq", *TRADE_COLUMNS)


@query
def stream_dead_letters_replayed(spark, sf):
    """The drill's dead letters replayed into a copy of its cloud store, and acknowledged."""
    at = _drill(spark, sf)
    cloud, letters = samples.fresh_store(spark, "cloud"), scratch_dir(spark, "letters")
    stores.append_idempotent(_trades(stores.read_store(spark, at.cloud)), cloud, "load", 0, bulk=True)
    reconcile.read_dead_letters(spark, at.dead_letters).write.partitionBy("batch_id").parquet(letters)
    done = reconcile.replay_dead_letters(spark, at.legacy, cloud, letters)
    left = reconcile.read_dead_letters(spark, letters).count()
    return _flat_summary(done).withColumn("letters_left", F.lit(left).cast("long"))


@query
def dead_letters_acknowledged(spark, sf):
    """Letters still open after a replay against a primary that lacks some of their ids as yet."""
    at = _drill(spark, sf)
    cloud, legacy, letters = samples.fresh_store(spark, "cloud"), samples.fresh_store(spark, "legacy"), scratch_dir(spark, "letters")
    stores.append_idempotent(_trades(stores.read_store(spark, at.cloud)), cloud, "load", 0, bulk=True)
    known = _trades(stores.read_store(spark, at.legacy)).filter(~F.col("trade_id").endswith("7"))
    stores.append_idempotent(known, legacy, "load", 0, bulk=True)
    reconcile.read_dead_letters(spark, at.dead_letters).write.partitionBy("batch_id").parquet(letters)
    reconcile.replay_dead_letters(spark, legacy, cloud, letters)
    return reconcile.read_dead_letters(spark, letters).select("ingest_seq", *TRADE_COLUMNS)


@query
def dead_letters_retried(spark, sf):
    """A replay that broke off before the letters were acknowledged is tried again: all is there once."""
    at = _drill(spark, sf)
    cloud, letters = samples.fresh_store(spark, "cloud"), scratch_dir(spark, "letters")
    stores.append_idempotent(_trades(stores.read_store(spark, at.cloud)), cloud, "load", 0, bulk=True)
    kept = reconcile.read_dead_letters(spark, at.dead_letters)
    kept.write.partitionBy("batch_id").parquet(letters)
    reconcile.reconcile(spark, at.legacy, cloud, kept, ["ingest_seq"])
    reconcile.replay_dead_letters(spark, at.legacy, cloud, letters)
    return _trades(stores.read_store(spark, cloud))


@query
def stream_two_topics_one_store(spark, sf):
    """Two topics with a checkpoint each into one store, the second with trades of the first again."""
    feed = samples.event_trades(spark, sf)
    n = feed.count()
    root = scratch_dir(spark, "two_topics")
    path = f"{root}/store"
    stores.create_store(spark, path)
    for name, part in (("a", slices_of(feed, [0, n // 2])[0]), ("b", slices_of(feed, [n // 4, n])[0])):
        topics.publish(part, f"{root}/{name}", spread=True)
        stream = topics.subscribe(spark, f"{root}/{name}")
        loads.drain(loads.load_legacy(stream, path, f"{root}/checkpoint_{name}"))
    return _trades(stores.read_store(spark, path))


@query
def stream_fresh_checkpoint(spark, sf):
    """A topic loaded, more published, and all of it read again from a fresh checkpoint in other batches."""
    feed = samples.event_trades(spark, sf)
    n = feed.count()
    root = scratch_dir(spark, "fresh_checkpoint")
    topic, path = topics.topic_path(root), f"{root}/store"
    stores.create_store(spark, path)
    first, second = slices_of(feed, [0, n // 2, n])
    topics.publish(first.repartitionByRange(3, "ingest_seq"), topic)
    loads.drain(loads.load_legacy(topics.subscribe(spark, topic), path, f"{root}/checkpoint"))
    topics.publish(second, topic)
    stream = topics.subscribe(spark, topic, max_files=2)
    loads.drain(loads.load_legacy(stream, path, f"{root}/checkpoint_again"))
    return stores.read_store(spark, path).select("trade_id")


@query
def stream_outcomes(spark, sf):
    """What became of each trade that the shadow load met, and the trades it set aside."""
    return samples.once(spark, sf, "stream_outcomes", lambda: _stream_outcomes(spark, sf))


def _stream_outcomes(spark, sf) -> DataFrame:
    feed = samples.event_trades(spark, sf)
    n = feed.count()
    root = scratch_dir(spark, "outcomes")
    topic, path = topics.topic_path(root), f"{root}/store"
    stores.create_store(spark, path)
    for part in slices_of(feed, samples.drill_cuts(n)):
        topics.publish(part, topic, spread=True)
        load = loads.load_cloud(
            topics.subscribe(spark, topic), path, f"{root}/letters", lambda: samples.drill_outages(spark, n),
            f"{root}/checkpoint", quarantine=f"{root}/quarantine", outcomes=f"{root}/outcomes",
        )
        loads.drain(load)
    met = spark.read.parquet(f"{root}/outcomes").select("ingest_seq", "trade_id", "cloud_status")
    refused = spark.read.parquet(f"{root}/quarantine").select("ingest_seq", "trade_id", F.lit("REFUSED").alias("cloud_status"))
    return met.unionByName(refused)


@query
def stream_parity_log(spark, sf):
    """The audit after each delivery."""
    return spark.read.parquet(_drill(spark, sf).parity_log).drop("writer").withColumn(
        "batch_id", F.col("batch_id").cast("long")
    )


@query
def stream_dual_fanout(spark, sf):
    """One feed, no outage: both stores end up with every trade."""
    feed = samples.event_trades(spark, sf)
    none = samples.drill_outages(spark, 0)
    at = dual_ingestion(spark, [feed], none)
    legacy, cloud = stores.read_store(spark, at.legacy), stores.read_store(spark, at.cloud)
    return parity.parity_audit(legacy, cloud)


@query
def stream_redelivery(spark, sf):
    """A feed delivered twice with a cap on files per trigger; the second time adds nothing."""
    feed = samples.event_trades(spark, sf)
    root = scratch_dir(spark, "redelivery")
    topic, path = topics.topic_path(root), f"{root}/store"
    stores.create_store(spark, path)
    held = []
    for delivery in (1, 2):
        topics.publish(feed, topic)
        stream = topics.subscribe(spark, topic, max_files=2)
        loads.drain(loads.load_legacy(stream, path, f"{root}/checkpoint"))
        n, v = parity.store_totals(stores.read_store(spark, path)).first()
        held.append(
            F.struct(
                F.lit(delivery).alias("delivery"),
                F.lit(n).cast("long").alias("trade_count"),
                F.lit(v).cast("decimal(36,2)").cast("double").alias("volume"),
            )
        )
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*held)))


@query
def stream_quarantine(spark, sf):
    """JSON payloads as a stream: good trades stored, bad ones set aside with reasons."""
    root = scratch_dir(spark, "quarantine")
    path = f"{root}/store"
    stores.create_store(spark, path)
    samples.payloads(spark, sf).select("payload").write.text(f"{root}/payloads")
    stream = topics.subscribe_payloads(spark, f"{root}/payloads")
    loads.drain(loads.load_payloads(stream, path, f"{root}/quarantine", f"{root}/checkpoint"))
    bad = spark.read.parquet(f"{root}/quarantine").select(
        F.array_join("reject_reasons", "; ").alias("outcome")
    )
    good = stores.read_store(spark, path).select(F.lit("stored").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("rows"))


@query
def stream_throughput(spark, sf):
    """Trades per hour, kept up to date by a stream."""
    root = scratch_dir(spark, "throughput")
    topic = topics.topic_path(root)
    topics.publish(samples.event_trades(spark, sf), topic)
    path = f"{root}/buckets"
    stream = topics.subscribe(spark, topic, max_files=1)
    loads.drain(telemetry.log_throughput(stream, path, f"{root}/checkpoint", "1 hour"))
    return spark.read.parquet(path).select(
        F.unix_seconds("bucket_start").alias("bucket_start"), "trades"
    )


@query
def stream_throughput_windowed(spark, sf):
    """Trades per hour with buckets that close a day behind; a tenth of the first half comes late."""
    feed = samples.event_trades(spark, sf)
    n, at = feed.count(), F.col("ingest_seq")
    held_back = (at < n // 2) & (at % 10 == 3)
    parts = [feed.filter((at < n // 2) & ~held_back), feed.filter(held_back | ((at >= n // 2) & (at < 3 * n // 4))), feed.filter(at >= 3 * n // 4)]
    root = scratch_dir(spark, "windows")
    for part in parts:
        topics.publish(part, f"{root}/topic")
        stream = topics.subscribe(spark, f"{root}/topic")
        loads.drain(carried.log_windows(stream, f"{root}/buckets", f"{root}/checkpoint", "1 hour", "1 day"))
    shown = carried.windows_so_far(spark, f"{root}/buckets")
    return shown.withColumn("bucket_start", F.unix_seconds("bucket_start"))


def _in_three(spark, rows, seq, root, load):
    """Rows as a stream in three deliveries of unequal size, each met by a restarted query."""
    n = rows.count()
    for part, files in zip(slices_of(rows, [0, n // 5, n // 2 + 1, n], seq), (3, 1, 2)):
        part.repartitionByRange(files, seq).write.mode("append").parquet(f"{root}/topic")
        loads.drain(load(spark.readStream.schema(rows.schema).parquet(f"{root}/topic")))


@query
def control_state_incremental(spark, sf):
    """State after each control event, each batch starting from the state that the one before left."""
    root = scratch_dir(spark, "controls")
    events = samples.control_events(spark, sf)
    _in_three(spark, events, "seq", root, lambda s: carried.log_controls(s, f"{root}/log", f"{root}/checkpoint"))
    return carried.control_states(spark, f"{root}/log")


@query
def running_parity_incremental(spark, sf):
    """The audit after every 250 trades and at the end, from running sums carried over batches."""
    root = scratch_dir(spark, "running")
    ledger = _day_ledger(spark, sf).select("ingest_seq", "price", "quantity", "legacy_inserted", "cloud_inserted")
    ledger = materialize(ledger, "outcomes")
    _in_three(
        spark, ledger, "ingest_seq", root,
        lambda s: carried.log_running_parity(s, CHECKPOINT_EVERY, f"{root}/log", f"{root}/checkpoint"),
    )
    return carried.running_parity_so_far(spark, f"{root}/log")


@query
def stream_identity_state(spark, sf):
    """Each trade once, known by the stream's state on disk: three restarts, other file cuts, the first part delivered again."""
    feed = samples.event_trades(spark, sf)
    n = feed.count()
    root = scratch_dir(spark, "identity")
    first, second, third = slices_of(feed, [0, n // 3, n // 2, n])
    for part, files in ((first, 3), (second, 1), (third, 2), (first, 2)):
        topics.publish(part.repartitionByRange(files, "ingest_seq"), f"{root}/topic")
        stream = topics.subscribe(spark, f"{root}/topic")
        loads.drain(loads.load_by_state(stream, f"{root}/store", f"{root}/checkpoint"))
    return _trades(stores.read_store(spark, f"{root}/store"))


@query
def stream_topic_quarantine(spark, sf):
    """What became of each record of a topic: stored, a copy of a stored one, or refused, with its reasons."""
    root = scratch_dir(spark, "topic_quarantine")
    path = f"{root}/store"
    stores.create_store(spark, path)
    decoded = topics.decode_records(samples.records(spark, sf))
    topic = materialize(decoded, "topic_records")
    topic.write.parquet(f"{root}/topic")
    stream = spark.readStream.schema(topic.schema).parquet(f"{root}/topic")
    loads.drain(loads.load_records(stream, path, f"{root}/quarantine", f"{root}/checkpoint"))
    refused = spark.read.parquet(f"{root}/quarantine").select("ingest_seq", F.lit("refused").alias("outcome"))
    accepted = topic.join(refused, "ingest_seq", "left_anti")
    held = stores.read_store(spark, path).select("trade_id", F.col("price").alias("_price"), F.col("sell_order_id").alias("_sell"))
    same = (F.col("price") == F.col("_price")) & (F.col("sell_order_id") == F.col("_sell"))
    met = accepted.join(held, "trade_id").select("ingest_seq", F.when(same, "stored").otherwise("duplicate").alias("outcome"))
    return met.unionByName(refused)


@query
def telemetry_snapshot(spark, sf):
    """The dashboard's record, with its nested parts written out."""
    at = _drill(spark, sf)
    legacy, cloud = stores.read_totals(spark, at.legacy), stores.read_totals(spark, at.cloud)
    feed = samples.event_trades(spark, sf)
    flagged = outcomes.flag_outages(feed, samples.drill_outages(spark, feed.count()))
    record = outcomes.feed_record(flagged).drop("halted", "cut_off", "event_ts")
    state = _control_state(spark, sf)
    snapshot = telemetry.telemetry_snapshot(
        parity.parity_from_totals(legacy, cloud),
        reporting.eod_report_from_totals(cloud),
        record.withColumn("event_ts", F.to_timestamp("timestamp")),
        state,
        controls.log_messages(state),
        "1 hour",
    )
    trade = F.transform(
        "latest_trades", lambda t: F.concat_ws(" ", t["trade_id"], t["cloud_status"])
    )
    message = F.transform("recent_logs", lambda m: F.concat_ws(":", m["tag"], m["type"], m["msg"]))
    return snapshot.select(
        *[c for c in snapshot.columns if c not in ("reporting", "latest_trades", "recent_logs")],
        "reporting.total_reported_executions",
        "reporting.total_notional_volume",
        "reporting.average_execution_value",
        F.array_join(trade, ", ").alias("latest_trades"),
        F.array_join(message, " | ").alias("recent_logs"),
    )
