"""The state that a log of control events leads to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.numbers import clamp
from twinledger.operators.ordering import scan_forward
from twinledger.operators.outcomes import PARTITION
from twinledger.schema import (
    LOG_CHAOS_OFF,
    LOG_CHAOS_ON,
    LOG_CUTOVER,
    LOG_RECONCILED,
    LOG_RESET,
    LOG_ROLLBACK,
    LOG_STREAM_PAUSED,
    LOG_STREAM_RESUMED,
    PRIMARY_CLOUD,
    PRIMARY_LEGACY,
    RATE_DEFAULT,
    RATE_MAX,
    RATE_MIN,
)
from twinledger.session import materialize


def clamp_rate(c: Column) -> Column:
    return clamp(c, RATE_MIN, RATE_MAX)


def control_state(events: DataFrame, width: int | None = None) -> DataFrame:
    """State after each event of a log with ``seq`` (unique, whole), ``action`` and ``rate``.

    ``stream_toggle`` and ``chaos_toggle`` flip their switch. ``cutover`` and ``rollback`` set one
    flag and clear the other; ``rollback`` also ends the outage. ``reset`` puts every flag back
    to off. ``set_rate`` sets the target rate within its limits.

    A switch is on when it was flipped an odd number of times since it was last cleared; the
    flags come from the last event that decided them.
    """
    action = F.col("action")
    state = scan_forward(
        events,
        "seq",
        sums_since={
            "_stream_flips": ((action == "stream_toggle").cast("long"), action == "reset"),
            "_chaos_flips": (
                (action == "chaos_toggle").cast("long"),
                action.isin("reset", "rollback"),
            ),
        },
        lasts={
            "_cutover": F.when(action == "cutover", True).when(
                action.isin("rollback", "reset"), False
            ),
            "_rollback": F.when(action == "rollback", True).when(
                action.isin("cutover", "reset"), False
            ),
            "_rate": F.when(action == "set_rate", clamp_rate(F.col("rate"))),
        },
        width=width,
    )

    cutover = F.coalesce(F.col("_cutover"), F.lit(False))
    return state.select(
        "seq",
        "action",
        (F.col("_stream_flips") % 2 == 1).alias("is_streaming"),
        (F.col("_chaos_flips") % 2 == 1).alias("is_chaos_active"),
        cutover.alias("is_cutover_active"),
        F.coalesce(F.col("_rollback"), F.lit(False)).alias("is_rollback_active"),
        F.coalesce(F.col("_rate"), F.lit(RATE_DEFAULT)).cast("int").alias("target_rate"),
        F.when(cutover, PRIMARY_CLOUD).otherwise(PRIMARY_LEGACY).alias("active_primary"),
    )


def latest_state(state: DataFrame) -> DataFrame:
    return state.orderBy(F.desc("seq")).limit(1)


def as_events(state: DataFrame, before: int) -> DataFrame:
    """The shortest log that leads to a state of one row, at the places just before ``before``."""
    steps = [
        ("rollback", F.col("is_rollback_active"), None),  # first, as it ends an outage
        ("cutover", F.col("is_cutover_active"), None),
        ("stream_toggle", F.col("is_streaming"), None),
        ("chaos_toggle", F.col("is_chaos_active"), None),
        ("set_rate", F.lit(True), F.col("target_rate")),
    ]
    events = [
        F.when(
            needed,
            F.struct(
                F.lit(before - len(steps) + i).cast("long").alias("seq"),
                F.lit(action).alias("action"),
                (F.lit(None) if rate is None else rate).cast("int").alias("rate"),
            ),
        )
        for i, (action, needed, rate) in enumerate(steps)
    ]
    return state.select(F.inline(F.array_compact(F.array(*events))))


def outage_intervals(state: DataFrame, end_of_feed: int, width: int | None = None) -> DataFrame:
    """Outages as intervals: from each event that starts one to the event that ends it.

    Turning points alternate between start and end, so they pair up by their running number; an
    outage still open runs to ``end_of_feed``.
    """
    on = F.col("is_chaos_active")
    known = state.select("seq", on.cast("int").alias("_on"))
    # The state just before an event is the state just after the previous one.
    shifted = known.select((F.col("seq") + 1).alias("seq"), F.col("_on").alias("_was"))
    lined_up = scan_forward(
        known.join(shifted, "seq", "full"), "seq", lasts={"_before": F.col("_was")}, width=width
    ).filter(F.col("_on").isNotNull())
    turns = lined_up.filter(F.col("_on") != F.coalesce(F.col("_before"), F.lit(0)))
    numbered = scan_forward(turns, "seq", sums={"_turn": F.lit(1)}, width=width)
    pairs = numbered.groupBy(F.expr("(_turn - 1) div 2").alias("_pair")).agg(
        F.min("seq").alias("start"),
        F.coalesce(F.max(F.when(F.col("_on") == 0, F.col("seq"))), F.lit(end_of_feed)).alias("end"),
    )
    return materialize(pairs.select(F.lit(PARTITION).alias("kind"), "start", "end"), "outages")


def reconciliation_message(summary: DataFrame, seq: int) -> DataFrame:
    """The operator log's message for a replay, from its one-row summary."""
    tag, kind, text = LOG_RECONCILED
    message = F.format_string(text, F.col("replayed_count"), F.col("final_status"))
    return summary.select(
        F.lit(seq).cast("long").alias("seq"), F.lit(tag).alias("tag"), F.lit(kind).alias("type"), message.alias("msg")
    )


def log_messages(state: DataFrame) -> DataFrame:
    """The operator log: one message per event that has one (a change of rate has none)."""
    action = F.col("action")

    def entry(parts: tuple[str, str, str]) -> Column:
        names = ("tag", "type", "msg")
        return F.struct(*[F.lit(text).alias(name) for name, text in zip(names, parts)])

    message = (
        F.when((action == "stream_toggle") & F.col("is_streaming"), entry(LOG_STREAM_RESUMED))
        .when(action == "stream_toggle", entry(LOG_STREAM_PAUSED))
        .when((action == "chaos_toggle") & F.col("is_chaos_active"), entry(LOG_CHAOS_ON))
        .when(action == "chaos_toggle", entry(LOG_CHAOS_OFF))
        .when(action == "cutover", entry(LOG_CUTOVER))
        .when(action == "rollback", entry(LOG_ROLLBACK))
        .when(action == "reset", entry(LOG_RESET))
    )
    return (
        state.select("seq", message.alias("_m")).filter(F.col("_m").isNotNull()).select("seq", "_m.*")
    )
