"""Positions, running values, intervals, outcomes and control state against brute force, with
one key or one value holding a third of the rows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from twinledger.operators import controls, outcomes, reporting
from twinledger.operators.intervals import FEW_INTERVALS, flag_intervals
from twinledger.operators.ordering import keep_first, scan_forward, with_position
from twinledger.plans.joins import fits_broadcast, join_dimension

N = 900


def feed_rows(seed=1):
    """(trade_id, instrument, price, quantity, ingest_seq); a third of the rows share an id."""
    rnd = random.Random(seed)
    return [
        (
            "HOT" if rnd.random() < 1 / 3 else f"T{rnd.randrange(N // 2)}",
            rnd.choice("ABC"),
            Decimal(rnd.randrange(1, 10_000)) / 100,
            rnd.randrange(1, 50),
            i,
        )
        for i in range(N)
    ]


def feed(spark, rows):
    schema = "trade_id string, instrument string, price decimal(15,2), quantity int, ingest_seq long"
    return spark.createDataFrame(random.Random(2).sample(rows, len(rows)), schema)


def test_positions_follow_the_order_whatever_the_skew(spark):
    rnd = random.Random(3)
    rows = [(7 if rnd.random() < 0.5 else rnd.randrange(100), i) for i in range(N)]
    df = spark.createDataFrame(random.Random(4).sample(rows, N), "a int, b int")
    got = with_position(df, ["a", "b"], "p").orderBy("p").collect()
    assert [(r.a, r.b) for r in got] == sorted(rows)
    assert [r.p for r in got] == list(range(N))


def test_running_values_over_gaps_and_blocks(spark):
    rnd = random.Random(5)
    at = sorted(rnd.sample(range(5000), N))
    rows = [(s, rnd.randrange(-9, 9), rnd.choice([None, None, "x", "y"])) for s in at]
    df = spark.createDataFrame(random.Random(6).sample(rows, N), "s long, v int, t string")
    for width in (1, 7, 64, 10_000):
        got = scan_forward(
            df,
            "s",
            sums={"total": F.col("v")},
            lasts={"seen": F.col("t")},
            sums_since={
                "since": (F.col("v"), F.col("v") == 8),
                "since_x": (F.col("v"), F.coalesce(F.col("t") == "x", F.lit(False))),
                "never": (F.col("v"), F.lit(False)),
            },
            width=width,
        )
        total, seen, since, since_x, want = 0, None, 0, 0, []
        for s, v, t in rows:
            total, seen = total + v, t or seen
            since = 0 if v == 8 else since + v
            since_x = 0 if t == "x" else since_x + v
            want.append((s, total, seen, since, since_x, total))
        names = ["s", "total", "seen", "since", "since_x", "never"]
        assert [tuple(r[n] for n in names) for r in got.orderBy("s").collect()] == want


def test_keep_first_limits_before_the_shuffle(spark, capsys):
    rows = feed_rows()
    got = keep_first(feed(spark, rows), "trade_id", ["ingest_seq"])
    want = {}
    for r in rows:
        want.setdefault(r[0], r[4])
    assert {r.trade_id: r.ingest_seq for r in got.collect()} == want
    got.explain()
    plan = capsys.readouterr().out
    below_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def intervals(spark, rows):
    return spark.createDataFrame(rows, "kind string, start long, end long")


@pytest.mark.parametrize("spans", [3, 32, 33, 256, 257])
def test_intervals_agree_whatever_their_number(spark, spans):
    """Overlaps, equal borders, empty intervals and rows without a position, by both plans."""
    rng = random.Random(spans)
    given = [("PARTITION", s, s + rng.randint(0, 9)) for s in rng.choices(range(N), k=spans - 2)]
    given += [("PARTITION", 10, 20), ("PARTITION", 20, 25), ("HALT", 0, N)]
    df = feed(spark, feed_rows()).withColumn(
        "ingest_seq", F.when(F.col("ingest_seq") % 11 != 5, F.col("ingest_seq"))
    )
    inside = {s for k, a, b in given if k == "PARTITION" for s in range(a, b)}
    want = sorted((str(r.ingest_seq), r.ingest_seq in inside) for r in df.select("ingest_seq").collect())
    for few, unique in ((10_000, None), (0, True), (0, False), (FEW_INTERVALS, None)):
        got = flag_intervals(df, intervals(spark, given), "PARTITION", "hit", few=few, width=50, unique_axis=unique)
        assert sorted((str(r.ingest_seq), r.hit) for r in got.collect()) == want


def test_no_nested_loops_over_intervals(spark, capsys):
    df = feed(spark, feed_rows())
    for spans in (5, 300):
        given = intervals(spark, [("PARTITION", s, s + 2) for s in range(spans)])
        flag_intervals(df, given, "PARTITION", "hit").explain()
        plan = capsys.readouterr().out
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_intervals_on_an_axis_with_ties(spark):
    rows = [(100 if i % 3 == 0 else i % 200, i) for i in range(N)]
    df = spark.createDataFrame(rows, "t long, ingest_seq long")
    spans = [("PARTITION", s, s + 5) for s in range(0, 200, 10)]
    for few in (256, 3):
        got = flag_intervals(
            df, intervals(spark, spans), "PARTITION", "hit", "t", ["ingest_seq"], few, 50
        )
        assert {(r.t, r.hit) for r in got.collect()} == {(t, t % 10 < 5) for t, _ in rows}
        assert got.count() == N


def brute_ledger(rows, halts, cuts, legacy=(), cloud=()):
    legacy, cloud, out = set(legacy), set(cloud), []
    for trade_id, _, _, _, seq in rows:
        first = trade_id not in legacy
        legacy.add(trade_id)
        inserted = False
        if any(a <= seq < b for a, b in halts):
            status = "HALTED"
        elif any(a <= seq < b for a, b in cuts):
            status = "DROPPED_BY_CHAOS"
        else:
            inserted = trade_id not in cloud
            status = "STORED" if inserted else "DUPLICATE_SKIPPED"
            cloud.add(trade_id)
        out.append((seq, first, inserted, status))
    return out


def ledger_of(spark, rows, halts, cuts, **held):
    spans = [("HALT", *h) for h in halts] + [("PARTITION", *c) for c in cuts]
    flagged = outcomes.flag_outages(feed(spark, rows), intervals(spark, spans))
    return outcomes.outcome_ledger(flagged, **held)


def test_outcomes_match_one_by_one_ingestion(spark):
    rows, halts, cuts = feed_rows(), [(600, 700)], [(0, 40), (300, 650)]
    got = ledger_of(spark, rows, halts, cuts).orderBy("ingest_seq").collect()
    want = brute_ledger(rows, halts, cuts)
    assert [(r.ingest_seq, r.legacy_inserted, r.cloud_inserted, r.cloud_status) for r in got] == want
    by_status = {
        r.cloud_status: r.trades
        for r in outcomes.outcome_summary(ledger_of(spark, rows, halts, cuts)).collect()
    }
    assert by_status == {s: sum(w[3] == s for w in want) for s in {w[3] for w in want}}


def test_outcomes_against_stores_that_hold_something(spark):
    rows = feed_rows()
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "trade_id string")
    got = ledger_of(spark, rows, [], [(0, 100)], legacy=ids("HOT", "T3"), cloud=ids("T5"))
    want = brute_ledger(rows, [], [(0, 100)], {"HOT", "T3"}, {"T5"})
    assert [
        (r.ingest_seq, r.legacy_inserted, r.cloud_inserted, r.cloud_status)
        for r in got.orderBy("ingest_seq").collect()
    ] == want


def test_stored_dropped_and_the_copy_after_the_outage(spark):
    rows = [("T1", "A", Decimal(1), 1, 0), ("T2", "A", Decimal(1), 1, 1), ("T2", "A", Decimal(1), 1, 2)]
    got = ledger_of(spark, rows, [], [(1, 2)]).orderBy("ingest_seq").collect()
    assert [r.cloud_status for r in got] == ["STORED", "DROPPED_BY_CHAOS", "STORED"]
    assert [r.legacy_inserted for r in got] == [True, True, False]


def test_running_parity_at_every_step_and_at_the_end(spark):
    rows, cuts = feed_rows(), [(300, 650)]
    ledger = ledger_of(spark, rows, [], cuts)
    for every, width in ((100, 4), (70, 1000)):
        got = outcomes.running_parity(ledger, every, width=width).orderBy("processed").collect()
        brute = brute_ledger(rows, [], cuts)
        want = []
        for upto in [*range(every, N, every), N]:
            value = {w[0]: r[2] * r[3] for w, r in zip(brute, rows)}
            lv = sum(value[w[0]] for w in brute[:upto] if w[1])
            cv = sum(value[w[0]] for w in brute[:upto] if w[2])
            want.append((upto, sum(w[1] for w in brute[:upto]), sum(w[2] for w in brute[:upto]),
                         float(lv), float(cv)))
        assert [
            (r.processed, r.legacy_count, r.cloud_count, r.legacy_volume, r.cloud_volume) for r in got
        ] == want


ACTIONS = ["stream_toggle", "chaos_toggle", "cutover", "rollback", "reset", "set_rate"]


def brute_state(events):
    stream = chaos = cut = back = False
    rate, out = 20, []
    for seq, action, value in events:
        if action == "stream_toggle":
            stream = not stream
        elif action == "chaos_toggle":
            chaos = not chaos
        elif action == "cutover":
            cut, back = True, False
        elif action == "rollback":
            cut, back, chaos = False, True, False
        elif action == "reset":
            stream = chaos = cut = back = False
        else:
            rate = max(1, min(100, value))
        out.append((seq, stream, chaos, cut, back, rate))
    return out


def test_control_state_and_outages(spark):
    rnd = random.Random(9)
    at = sorted(rnd.sample(range(3000), 400))
    events = []
    for s in at:
        a = rnd.choices(ACTIONS, [5, 5, 1, 1, 1, 2])[0]
        events.append((s, a, rnd.randrange(-50, 200) if a == "set_rate" else None))
    log = spark.createDataFrame(random.Random(1).sample(events, 400), "seq long, action string, rate int")
    want = brute_state(events)
    for width in (37, 100_000):
        state = controls.control_state(log, width)
        got = [
            (r.seq, r.is_streaming, r.is_chaos_active, r.is_cutover_active, r.is_rollback_active,
             r.target_rate)
            for r in state.orderBy("seq").collect()
        ]
        assert got == want
    spans, start = [], None
    for seq, _, chaos, *_ in want:
        if chaos and start is None:
            start = seq
        elif not chaos and start is not None:
            spans.append((start, seq))
            start = None
    if start is not None:
        spans.append((start, 3000))
    got = controls.outage_intervals(state, 3000, 37).orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == spans
    last = controls.latest_state(state).first()
    assert last.seq == at[-1]


def test_log_messages(spark):
    events = [(0, "stream_toggle"), (1, "stream_toggle"), (2, "chaos_toggle"), (3, "rollback"),
              (4, "set_rate"), (5, "cutover"), (6, "reset")]
    log = spark.createDataFrame([(s, a, 5) for s, a in events], "seq long, action string, rate int")
    got = controls.log_messages(controls.control_state(log)).orderBy("seq").collect()
    assert [(r.seq, r.tag, r.type) for r in got] == [
        (0, "STREAM", "info"), (1, "STREAM", "info"), (2, "CHAOS", "alert"),
        (3, "ROLLBACK", "alert"), (5, "CUTOVER", "success"), (6, "SYSTEM", "info"),
    ]
    assert got[0].msg.endswith("RESUMED.") and got[1].msg.endswith("PAUSED.")


def test_dimension_join_broadcast_and_salted_agree(spark, monkeypatch):
    facts = feed(spark, feed_rows())
    dim = spark.createDataFrame([("A", "a"), ("B", "b")], "instrument string, isin string")
    assert fits_broadcast(dim) and not fits_broadcast(dim, max_rows=1) and not fits_broadcast(dim, 8)
    small = join_dimension(facts, dim, "instrument").orderBy("ingest_seq").collect()
    monkeypatch.setattr("twinledger.plans.joins.fits_broadcast", lambda df: False)
    for salts in (1, 5):
        large = join_dimension(facts, dim, "instrument", salts=salts).orderBy("ingest_seq")
        assert large.collect() == small
    assert len(small) == N and {r.isin for r in small} == {"a", "b", None}


def test_trailing_throughput_across_blocks(spark):
    rnd = random.Random(11)
    buckets = sorted(rnd.sample(range(10_000), 400))
    rows = [(b, rnd.randrange(200)) for b in buckets]
    df = spark.createDataFrame(rows, "t long, trades long").select(
        F.timestamp_seconds("t").alias("bucket_start"), "trades"
    )
    for block in (31, 64, 3600):
        got = reporting.trailing_throughput(df, block=block).orderBy("bucket_start").collect()
        want = [[v for u, v in rows if t - 29 <= u <= t] for t, _ in rows]
        assert [r.history for r in got] == want
        assert [r.peak for r in got] == [max(60, *w) for w in want]


def test_cutover_gate(spark):
    def gate(good_days):
        days = spark.createDataFrame(
            [(f"2026-01-{d:02d}", "IN_PARITY" if d in good_days else "DRIFT_DETECTED") for d in range(1, 20)],
            "day string, status string",
        ).withColumn("day", F.to_date("day"))
        return reporting.cutover_gate(days).first()

    assert tuple(gate(range(3, 10))) == (7, True)
    assert tuple(gate([1, 2, 3, 5, 6, 7, 8, 9, 10])) == (6, False)
    weekdays = [(f"2026-01-{d:02d}", "IN_PARITY") for d in (5, 6, 7, 8, 9, 12, 13)]
    closed = spark.createDataFrame(weekdays, "day string, status string").withColumn("day", F.to_date("day"))
    assert tuple(reporting.cutover_gate(closed).first()) == (7, True)
    assert tuple(gate([])) == (0, False)


def test_recent_and_views(spark):
    df = feed(spark, feed_rows())
    assert [r.ingest_seq for r in reporting.recent_trades(df).collect()] == list(range(N - 1, N - 16, -1))
    assert reporting.recent_trades(df, shown=99).count() == 99
    assert reporting.first_in_stream(df, 10).count() == 10
    cuts = reporting.phase_cuts(df).first()
    assert (cuts.total, cuts.outage_start, cuts.outage_end) == (N, 150, 250)
    small = reporting.phase_cuts(df.filter("ingest_seq < 101")).first()
    assert (small.outage_start, small.outage_end) == (50, 75)
    assert reporting.filter_feed_count(df, " a ").first()[0] == df.filter("instrument = 'A'").count()
    per = reporting.recent_per_group(df, "instrument", 2).collect()
    assert len(per) == 6
