"""State carried over batches gives what one batch over everything gives, wherever the batches are cut."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from twinledger.operators import controls, outcomes
from twinledger.operators import store as stores
from twinledger.streaming import carried, loads
from tests.test_streams import trades

ACTIONS = ["stream_toggle", "chaos_toggle", "cutover", "set_rate", "rollback", "chaos_toggle", "reset", "stream_toggle"]


def deliver(spark, rows, root, cuts, seq, load):
    for lo, hi in zip(cuts, cuts[1:]):
        rows.filter((F.col(seq) >= lo) & (F.col(seq) < hi)).write.mode("append").parquet(f"{root}/topic")
        loads.drain(load(spark.readStream.schema(rows.schema).parquet(f"{root}/topic")))


def as_set(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("cuts", [[0, 30], [0, 1, 2, 9, 9, 30], [0, 13, 30, 30]])
def test_control_state_over_any_cut(spark, tmp_path, cuts):
    events = spark.createDataFrame([(i, ACTIONS[i * 5 % 8], i * 9 if i % 3 else None) for i in range(30)], "seq long, action string, rate int")
    root = str(tmp_path)
    deliver(spark, events, root, cuts, "seq", lambda s: carried.log_controls(s, f"{root}/log", f"{root}/ck"))
    # Delivered again, nothing is folded twice.
    events.filter("seq < 7").write.mode("append").parquet(f"{root}/topic")
    loads.drain(carried.log_controls(spark.readStream.schema(events.schema).parquet(f"{root}/topic"), f"{root}/log", f"{root}/ck"))
    assert as_set(carried.control_states(spark, f"{root}/log")) == as_set(controls.control_state(events))
    assert len(list(Path(f"{root}/log/state").glob("slot=*"))) <= 2


def test_shortest_log_leads_to_the_state(spark):
    events = spark.createDataFrame([(i, ACTIONS[i * 3 % 8], i) for i in range(24)], "seq long, action string, rate int")
    for row in controls.control_state(events).filter("seq % 5 = 1").collect():
        one = spark.createDataFrame([row])
        again = controls.latest_state(controls.control_state(controls.as_events(one, row.seq))).first()
        assert {k: v for k, v in again.asDict().items() if k not in ("seq", "action")} == {
            k: v for k, v in row.asDict().items() if k not in ("seq", "action")
        }


def test_running_parity_over_any_cut(spark, tmp_path):
    i = F.col("ingest_seq")
    ledger = trades(spark, 47).select(
        "ingest_seq", "price", "quantity", (i % 7 != 3).alias("legacy_inserted"), (i % 5 != 2).alias("cloud_inserted")
    )
    root = str(tmp_path)
    load = lambda s: carried.log_running_parity(s, 10, f"{root}/log", f"{root}/ck")
    deliver(spark, ledger, root, [0, 3, 20, 21, 47], "ingest_seq", load)
    assert as_set(carried.running_parity_so_far(spark, f"{root}/log")) == as_set(outcomes.running_parity(ledger, 10))
    with pytest.raises(Exception, match="positions 47 to 60"):
        deliver(spark, ledger.limit(1).withColumn("ingest_seq", F.lit(60).cast("long")), root, [0, 99], "ingest_seq", load)


def test_a_batch_tried_again_and_a_foreign_state(spark, tmp_path):
    path = str(tmp_path / "sums")
    tries = []

    def fold(batch, before):
        base = 0 if before is None else before.first().total
        total = base + batch.count()
        rows = batch.sparkSession.range(1).select(F.lit(total).cast("long").alias("total"))
        if len(tries) < 1 and base:
            # Breaks off when its rows are out and its state is written.
            tries.append(1)
            rows.withColumn("at", F.lit(1).cast("long")).write.parquet(f"{path}/state/slot=1")
            raise RuntimeError("lost")
        return {"totals": rows, "state": rows}

    feed, root = trades(spark, 20), str(tmp_path)
    load = lambda s: carried.carry(s, path, f"{root}/ck", fold)
    deliver(spark, feed, root, [0, 8], "ingest_seq", load)
    with pytest.raises(Exception, match="lost"):
        deliver(spark, feed, root, [8, 20], "ingest_seq", load)
    loads.drain(load(spark.readStream.schema(feed.schema).parquet(f"{root}/topic")))
    assert sorted(r.total for r in carried.finished(spark, path, "totals").collect()) == [8, 20]


def test_windows_close_and_late_trades_are_counted_apart(spark, tmp_path):
    root = str(tmp_path)
    feed = trades(spark, 60).withColumn("delivery", F.when(F.col("ingest_seq").isin(5, 27), 2).when(F.col("ingest_seq") < 30, 1).otherwise(3))
    load = lambda s: carried.log_windows(s, f"{root}/w", f"{root}/ck", "10 seconds", "5 seconds")
    deliver(spark, feed, root, [1, 2, 3, 4], "delivery", load)
    got = {r.bucket_start.second: (r.trades, r.late, r.is_open) for r in carried.windows_so_far(spark, f"{root}/w").collect()}
    # The watermark stands at 24 s when trade 5 comes, and trade 27 is still in time.
    assert got == {0: (9, 1, False), 10: (10, 0, False), 20: (10, 0, False), 30: (10, 0, False), 40: (10, 0, False), 50: (10, 0, True)}
    assert carried.last_state(spark, f"{root}/w").count() == 2  # the mark and one open bucket


def test_identity_in_the_state_store(spark, tmp_path):
    root, store = str(tmp_path), str(tmp_path / "store")
    feed = trades(spark).withColumn("quantity", F.when(F.col("ingest_seq") == 3, 0).otherwise(F.col("quantity")))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    deliver(spark, feed, root, [0, 50, 51, 120], "ingest_seq", lambda s: loads.load_by_state(s, store, f"{root}/ck"))
    feed.filter("ingest_seq < 70").write.mode("append").parquet(f"{root}/topic")
    stream = spark.readStream.schema(feed.schema).parquet(f"{root}/topic")
    loads.drain(loads.load_by_state(stream, store, f"{root}/ck"))
    loads.drain(loads.load_refused(stream, f"{root}/refused", f"{root}/ck_refused"))
    assert spark.conf.get(key, None) == before
    assert any(Path(root, "ck", "state").rglob("*.changelog"))
    firsts = stores.first_copies(feed.filter("quantity > 0"), ["ingest_seq"])
    held = stores.read_store(spark, store)
    assert as_set(held.select("trade_id", "price")) == as_set(firsts.select("trade_id", "price"))
    assert {r.trade_id for r in spark.read.parquet(f"{root}/refused").collect()} == {"T3"}


def test_loads_keep_what_they_refuse(spark, tmp_path):
    store = str(tmp_path / "store")
    feed = trades(spark, 9).withColumn("quantity", F.when(F.col("ingest_seq") == 3, 0).otherwise(F.col("quantity")))
    stores.create_store(spark, store)
    deliver(spark, feed, str(tmp_path), [0, 9], "ingest_seq", lambda s: loads.load_legacy(s, store, str(tmp_path / "ck")))
    assert [r.trade_id for r in spark.read.parquet(loads.refused_path(store)).collect()] == ["T3"]
