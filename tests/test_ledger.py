"""The bucketed store: appends without a shuffle of the store, its log, compaction, digests."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest

from twinledger.operators import ledger
from twinledger.schema import TRADE


def trades(spark, ids, price="1.50"):
    rows = [(f"T{i}", "AAPL", Decimal(price), 2, f"B{i}", "S", "2026-10-01T10:00:00Z") for i in ids]
    return spark.createDataFrame(rows, TRADE)


@pytest.fixture
def path(spark, tmp_path):
    where = str(tmp_path / "store")
    ledger.create(spark, where, 4)
    return where


def ids_of(df):
    return sorted(r.trade_id for r in df.select("trade_id").collect())


def names(ids):
    return sorted(f"T{i}" for i in ids)


def total(spark, path, as_of=None):
    row = ledger.totals(spark, path, as_of).first()
    return row.trade_count, float(row.volume)


def test_repeats_within_and_between_batches(spark, path):
    assert ledger.append(trades(spark, [1, 2, 2, 3]), path, "load", 0) == 3
    assert ledger.append(trades(spark, [3, 4]), path, "load", 1) == 1
    assert ledger.append(trades(spark, [1, 4]), path, "other", 0) == 0
    assert ids_of(ledger.read(spark, path)) == names([1, 2, 3, 4])
    assert total(spark, path) == (4, 12.0)


def test_a_batch_tried_again_returns_what_it_added(spark, path):
    assert ledger.append(trades(spark, [1, 2]), path, "load", 0) == 2
    assert ledger.append(trades(spark, [1, 2]), path, "load", 0) == 2
    assert ledger.version(spark, path) == 1 and total(spark, path) == (2, 6.0)


def test_versions_stay_readable(spark, path):
    for k in range(3):
        ledger.append(trades(spark, [k, 10 + k]), path, "load", k)
    for k in range(4):
        want = [i for j in range(k) for i in (j, 10 + j)]
        assert ids_of(ledger.read(spark, path, k)) == names(want)
        assert total(spark, path, k) == (len(want), 3.0 * len(want))
    with pytest.raises(ValueError, match="no version 9"):
        ledger.read(spark, path, 9)


def test_a_batch_that_breaks_off_was_never_there(spark, path, monkeypatch):
    """Broken off between rows and log, and again while the log is written."""
    ledger.append(trades(spark, [1]), path, "load", 0)
    commit = ledger._State.commit

    def breaks(self, folders, last):
        raise RuntimeError("lost")

    monkeypatch.setattr(ledger._State, "commit", breaks)
    with pytest.raises(RuntimeError):
        ledger.append(trades(spark, [2, 3]), path, "load", 1)
    assert ids_of(ledger.read(spark, path)) == ["T1"] and total(spark, path) == (1, 3.0)
    Path(path, "log", "version=2", "_temporary").mkdir(parents=True)
    assert ledger.version(spark, path) == 1
    monkeypatch.setattr(ledger._State, "commit", commit)
    assert ledger.append(trades(spark, [2, 3]), path, "load", 1) == 2
    assert ids_of(ledger.read(spark, path)) == names([1, 2, 3]) and total(spark, path) == (3, 9.0)


def test_an_append_shuffles_only_the_batch(spark, path):
    """One exchange, that of the batch; the folders are read as bucketed tables, ids only."""
    ledger.append(trades(spark, range(50)), path, "load", 0)
    ledger.append(trades(spark, range(40, 90)), path, "load", 1)
    state = ledger._State(spark, path)
    plan = ledger.new_trades(trades(spark, [1, 200]), state)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Broadcast" not in plan
    assert plan.count("Bucketed: true") == 2 and plan.count("ReadSchema: struct<trade_id:string>") == 2
    assert plan.count("SortMergeJoin") == 2


def test_files_stay_bounded_over_many_batches(spark, path, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_FOLDERS", 3)
    for k in range(14):
        assert ledger.append(trades(spark, range(k * 5 - 1, k * 5 + 5)), path, "load", k) == (6 if k == 0 else 5)
        ledger.expire(spark, path, 2)
    assert ids_of(ledger.read(spark, path)) == names(range(-1, 70))
    assert total(spark, path) == (71, 213.0)
    assert len(ledger._State(spark, path).folders) <= 4
    assert len(list(Path(path, "data").iterdir())) <= 10 and len(list(Path(path, "log").iterdir())) <= 3
    # A batch from before the compaction is still known as done.
    assert ledger.append(trades(spark, [500]), path, "load", 3) == 0


def test_a_running_reader_outlives_compaction(spark, path):
    for k in range(3):
        ledger.append(trades(spark, [k]), path, "load", k)
    before = ledger.read(spark, path)
    digests = sorted(map(tuple, ledger.bucket_digests(spark, path).collect()))
    assert ledger.compact(spark, path) == 3
    assert ids_of(before) == ids_of(ledger.read(spark, path)) == names(range(3))
    assert sorted(map(tuple, ledger.bucket_digests(spark, path).collect())) == digests


def test_another_session_reads_it(spark, path):
    ledger.append(trades(spark, [1, 2]), path, "load", 0)
    for t in spark.catalog.listTables():
        if t.name.startswith("ledger_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert ids_of(ledger.read(spark.newSession(), path)) == names([1, 2])


def test_digests_find_differences(spark, path, tmp_path):
    other = str(tmp_path / "cloud")
    ledger.create(spark, other, 4)
    ledger.append(trades(spark, range(100)), path, "load", 0)
    ledger.append(trades(spark, range(60)), other, "load", 0)
    ledger.append(trades(spark, range(60, 100)), other, "load", 1)
    row = ledger.parity(spark, path, other).first()
    assert row.status == "IN_PARITY" and ledger.missing_ids(spark, path, other).count() == 0

    # Equal totals over different ids.
    ledger.append(trades(spark, [777]), path, "load", 1)
    ledger.append(trades(spark, [778]), other, "load", 2)
    row = ledger.parity(spark, path, other).first()
    assert row.same_totals and not row.same_ids and row.status == "DRIFT_DETECTED"
    assert ids_of(ledger.missing_ids(spark, path, other)) == ["T777"]
    assert ids_of(ledger.missing_ids(spark, other, path)) == ["T778"]


def test_equal_buckets_are_not_opened(spark, path, tmp_path):
    other = str(tmp_path / "cloud")
    ledger.create(spark, other, 4)
    ledger.append(trades(spark, range(100)), path, "load", 0)
    ledger.append(trades(spark, range(99)), other, "load", 0)
    buckets = [r[0] for r in ledger.differing_buckets(spark, path, other).collect()]
    assert len(buckets) == 1
    ids = ledger._ids_in(ledger._State(spark, path), buckets)
    assert {f.rsplit("_", 1)[1].split(".")[0] for f in files_read(ids)} == {f"{buckets[0]:05d}"}
    scans = ids._jdf.queryExecution().sparkPlan().collectLeaves()
    opened = [scans.apply(i).selectedPartitions().totalNumberOfFiles() for i in range(scans.size()) if "FileScan" in scans.apply(i).toString()]
    assert opened == [1]


def files_read(ids):
    from pyspark.sql import functions as F

    return {r[0] for r in ids.select(F.input_file_name()).distinct().collect()}


def test_stores_of_other_buckets_are_refused(spark, path, tmp_path):
    other = str(tmp_path / "cloud")
    ledger.create(spark, other, 8)
    with pytest.raises(ValueError, match="buckets"):
        ledger.parity(spark, path, other)
