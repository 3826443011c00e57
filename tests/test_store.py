"""Idempotent stores, parity, reconciliation."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from twinledger.operators import parity
from twinledger.operators import store as stores
from twinledger.operators.reconcile import (
    failback_proof,
    read_dead_letters,
    reconcile,
    refused_letters,
    replay_candidates,
    replay_dead_letters,
)
from twinledger.operators.reporting import eod_export, eod_report
from twinledger.schema import AUDIT, DEAD_LETTERS, REPORT_LABELS, TRADE
from twinledger.sources.jdbc import jdbc_options

T1 = ("TRD-001", "AAPL", Decimal("150.00"), 10, "BUY-101", "SELL-101", "2026-10-01T10:00:00Z")
T2 = ("TRD-002", "GOOGL", Decimal("200.00"), 5, "BUY-102", "SELL-102", "2026-10-01T10:01:00Z")


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), TRADE)


def total(spark, path):
    row = parity.store_totals(stores.read_store(spark, path)).first()
    return row.trade_count, float(row.volume)


@pytest.mark.parametrize("bulk", [False, True])
def test_append_is_idempotent(spark, tmp_path, bulk):
    path = str(tmp_path / "store")
    assert stores.append_idempotent(trades(spark, T1), path, "load", 0, bulk=bulk) == 1
    assert stores.append_idempotent(trades(spark, T1), path, "load", 1, bulk=bulk) == 0
    assert total(spark, path) == (1, 1500.0)
    assert stores.append_idempotent(trades(spark, T1, T2, T2), path, "load", 2, bulk=bulk) == 1
    assert total(spark, path) == (2, 2500.0)
    store = stores.read_store(spark, path)
    assert {r.trade_id for r in parity.store_ids(store).collect()} == {"TRD-001", "TRD-002"}
    assert stores.find_by_id(store, "TRD-002").first().instrument == "GOOGL"
    assert stores.find_by_id(store, "TRD-999").count() == 0
    assert store.filter("created_at is null").count() == 0


def test_a_batch_tried_again_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "store")
    stores.append_idempotent(trades(spark, T1), path, "stream", 0)
    assert stores.append_idempotent(trades(spark, T1, T2), path, "stream", 0) == 2
    assert total(spark, path) == (2, 2500.0)
    # Another writer has its own folders, and sees the rows of this one.
    assert stores.append_idempotent(trades(spark, T1), path, "replay", 0) == 0
    assert stores.append_idempotent(trades(spark), path, "stream", 0) == 0
    assert total(spark, path) == (0, 0.0)
    by_batch = stores.read_totals(spark, path)
    assert by_batch.agg({"trade_count": "sum"}).first()[0] == 0


def test_rows_that_break_the_checks_stay_out(spark, tmp_path):
    path = str(tmp_path / "store")
    bad = ("TRD-003", "X", Decimal("1.00"), 0, "B", "S", "2026-10-01T10:01:00Z")
    assert stores.append_idempotent(trades(spark, T1, bad), path, "load", 0) == 1


def test_first_copy_wins(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(*T1[:2], Decimal(p), *T1[3:], seq) for p, seq in (("3.00", 3), ("1.00", 1), ("2.00", 2))]
    batch = spark.createDataFrame(rows, StructType([*TRADE.fields, StructField("ingest_seq", LongType())]))
    stores.append_idempotent(batch, path, "load", 0, ["ingest_seq"])
    assert float(stores.read_store(spark, path).first().price) == 1.0


def test_reset(spark, tmp_path):
    path = str(tmp_path / "store")
    stores.append_idempotent(trades(spark, T1), path, "load", 0)
    stores.reset_store(spark, path)
    assert total(spark, path) == (0, 0.0)
    assert stores.read_totals(spark, path).count() == 0
    assert stores.append_idempotent(trades(spark, T1), path, "load", 0) == 1


def test_reset_under_dynamic_overwrite(spark, tmp_path):
    path, key = str(tmp_path / "store"), "spark.sql.sources.partitionOverwriteMode"
    stores.append_idempotent(trades(spark, T1), path, "load", 0)
    spark.conf.set(key, "dynamic")
    try:
        stores.reset_store(spark, path)
        assert total(spark, path) == (0, 0.0)
        assert stores.append_idempotent(trades(spark, T1), path, "load", 0) == 1
        assert stores.append_idempotent(trades(spark), path, "load", 0) == 0
        assert total(spark, path) == (0, 0.0)
    finally:
        spark.conf.unset(key)


def audit_of(spark, legacy, cloud, **how):
    df = parity.parity_audit(trades(spark, *legacy), trades(spark, *cloud), **how)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in AUDIT]
    return df.first().asDict()


def test_identical_stores_are_in_parity(spark):
    a = audit_of(spark, [T1], [T1])
    assert (a["status"], a["drift"], a["data_loss_percentage"]) == ("IN_PARITY", 0, 0.0)
    assert audit_of(spark, [], [])["legacy_volume"] == 0.0


def test_drift_replay_parity(spark, tmp_path):
    legacy, cloud = str(tmp_path / "legacy"), str(tmp_path / "cloud")
    stores.append_idempotent(trades(spark, T1, T2), legacy, "load", 0)
    stores.append_idempotent(trades(spark, T1), cloud, "load", 0)
    a, b = stores.read_store(spark, legacy), stores.read_store(spark, cloud)
    audit = parity.parity_audit(a, b).first()
    assert (audit.status, audit.drift, audit.volume_difference) == ("DRIFT_DETECTED", 1, 1000.0)
    assert [r.trade_id for r in parity.missing_ids(a, b).collect()] == ["TRD-002"]
    assert [r.trade_id for r in parity.missing_ids_by_subtract(a, b).collect()] == ["TRD-002"]
    assert parity.consistency_pct(parity.parity_audit(a, b)).first().consistency_pct == 50.0
    done = reconcile(spark, legacy, cloud, trades(spark, T2, T2, T1)).first()
    assert (done.replayed_count, done.initial_missing_count) == (1, 1)
    assert (done.final_status, done.final_drift, done.final_audit.cloud_count) == ("IN_PARITY", 0, 2)
    again = reconcile(spark, legacy, cloud, trades(spark, T2)).first()
    assert (again.replayed_count, again.initial_missing_count) == (0, 0)
    by_batch = parity.parity_from_totals(
        stores.read_totals(spark, legacy), stores.read_totals(spark, cloud)
    )
    assert by_batch.first() == done.final_audit


def test_equal_totals_over_other_ids_count_as_parity(spark):
    other = ("TRD-009", *T1[1:])
    assert audit_of(spark, [T1], [other])["status"] == "IN_PARITY"


def test_surplus_and_count_only(spark):
    assert audit_of(spark, [T1], [T1, T2])["drift"] == 1
    dearer = (*T1[:2], Decimal("150.01"), *T1[3:])
    assert audit_of(spark, [T1], [dearer])["status"] == "DRIFT_DETECTED"
    assert audit_of(spark, [T1], [dearer], count_only=True)["status"] == "IN_PARITY"
    pct = parity.consistency_pct(
        parity.parity_audit(trades(spark, T1), trades(spark, T1, T2))
    ).first()
    assert pct.consistency_pct == 100.0
    assert parity.consistency_pct(
        parity.parity_audit(trades(spark), trades(spark, T1))
    ).first().consistency_pct == 100.0


def test_replay_takes_the_first_copy(spark):
    rows = [(*T2[:2], Decimal(p), *T2[3:], s) for p, s in (("9.00", 2), ("8.00", 1))]
    backlog = spark.createDataFrame(rows, "trade_id string, instrument string, price decimal(15,2), "
                                    "quantity int, buy_order_id string, sell_order_id string, "
                                    "timestamp string, seq int")
    missing = spark.createDataFrame([("TRD-002",)], "trade_id string")
    assert float(replay_candidates(backlog, missing, ["seq"]).first().price) == 8.0


def test_report_and_export(spark):
    row = eod_report(trades(spark, T1, T2)).first()
    assert (row.total_reported_executions, row.total_notional_volume) == (2, 2500.0)
    assert row.average_execution_value == 1250.0 and row.workload_name == REPORT_LABELS["workload_name"]
    empty = eod_report(trades(spark)).first()
    assert (empty.total_reported_executions, empty.average_execution_value) == (0, 0.0)
    out = eod_export(trades(spark, T1), 1_790_847_000_250).first()
    assert out.report_id == "FINRA_CAT_EOD_1790847000250"
    assert out.generated_at == "2026-10-01T09:30:00.250Z" and out.average_trade_value == 1500.0


def test_failback(spark):
    proof = failback_proof(trades(spark, T1, T2, T2), trades(spark, T1, T2), trades(spark, T1)).first()
    assert proof.zero_loss and (proof.shadow_behind, proof.shadow_only) == (1, 0)
    lost = failback_proof(trades(spark, T1, T2), trades(spark, T1), trades(spark, T2)).first()
    assert not lost.zero_loss and (lost.lost_trades, lost.shadow_only) == (1, 1)


def test_jdbc_options():
    o = jdbc_options("jdbc:x", partition_column="created_at", lower="2026-01-01", upper="2026-12-31", user="u")
    assert o["partitionColumn"] == "created_at" and o["numPartitions"] == "64" and o["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x")


def test_replays_lose_nothing(spark, tmp_path):
    """Three replays in a row, and a second drift replayed after the first."""
    legacy, cloud = str(tmp_path / "legacy"), str(tmp_path / "cloud")
    every = [("T%d" % i, *T1[1:]) for i in range(10)]
    stores.append_idempotent(trades(spark, *every), legacy, "load", 0)
    stores.append_idempotent(trades(spark, *every[:5]), cloud, "load", 0)
    backlog = trades(spark, *every)
    done = [reconcile(spark, legacy, cloud, trades(spark, *every[5:8])).first()]
    done += [reconcile(spark, legacy, cloud, backlog).first() for _ in range(3)]
    assert [d.replayed_count for d in done] == [3, 2, 0, 0]
    assert [d.final_audit.cloud_count for d in done] == [8, 10, 10, 10]
    assert stores.read_store(spark, cloud).select("trade_id").distinct().count() == 10


def test_a_replay_number_is_never_used_twice(spark, tmp_path):
    path = str(tmp_path / "store")
    assert stores.next_batch_id(spark, path, "replay") == 0
    stores.append_idempotent(trades(spark, T1), path, "replay", 0)
    assert stores.next_batch_id(spark, path, "replay") == 1
    # Rows without totals, as a crash between the two writes leaves them, count as used.
    stores.append_idempotent(trades(spark, T2), path, "replay", 7)
    import shutil

    shutil.rmtree(f"{stores.totals_path(path)}/writer=replay/batch_id=7")
    assert stores.next_batch_id(spark, path, "replay") == 8


def test_totals_are_healed_after_a_crash(spark, tmp_path):
    import shutil

    path = str(tmp_path / "store")
    stores.append_idempotent(trades(spark, T1), path, "load", 0)
    stores.append_idempotent(trades(spark, T2), path, "load", 1)
    want = sorted(map(tuple, stores.read_totals(spark, path).collect()))
    shutil.rmtree(f"{stores.totals_path(path)}/writer=load/batch_id=1")
    for _ in range(2):
        stores.heal_totals(spark, path)
        assert sorted(map(tuple, stores.read_totals(spark, path).collect())) == want


def test_refused_letters_do_not_stay_open(spark, tmp_path):
    """A letter that breaks a rule is settled and kept with its reasons, and a later good copy of its id is replayed."""
    legacy, cloud, letters = (str(tmp_path / n) for n in ("legacy", "cloud", "letters"))
    stores.append_idempotent(trades(spark, T1, T2), legacy, "load", 0)
    stores.append_idempotent(trades(spark, T1), cloud, "load", 0)
    free = ("TRD-003", T1[1], Decimal("0.00"), *T1[3:])
    unnamed, unusable = (None, *T1[1:]), (*T2[:2], Decimal("0.00"), *T2[3:])
    rows = [(*row, i, None, 0) for i, row in enumerate([free, unnamed, unusable, T2])]
    spark.createDataFrame(rows, DEAD_LETTERS).write.partitionBy("batch_id").parquet(letters)
    done = replay_dead_letters(spark, legacy, cloud, letters).first()
    assert (done.replayed_count, done.final_status) == (1, "IN_PARITY")
    assert read_dead_letters(spark, letters).count() == 0
    assert {r.ingest_seq for r in refused_letters(spark, letters).collect()} == {0, 1, 2}
