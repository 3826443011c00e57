"""Streams give what the batch operators give, survive restarts, and never stop at a bad row."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from twinledger.operators import outcomes, parity, reconcile
from twinledger.operators import store as stores
from twinledger.operators import validate
from twinledger.plans.drills import dual_ingestion, slices_of
from twinledger.schema import FEED, TRADE_COLUMNS
from twinledger.sources import topics
from twinledger.streaming import loads, telemetry

N = 120


def trades(spark, n=N):
    i = F.col("id")
    repeated = F.when(i % 10 == 9, F.floor(i / 2)).otherwise(i)
    return spark.range(0, n, 1, 2).select(
        F.concat(F.lit("T"), repeated.cast("string")).alias("trade_id"),
        F.lit("AAPL").alias("instrument"),
        (i + 1).cast("decimal(15,2)").alias("price"),
        F.lit(2).cast("int").alias("quantity"),
        F.lit("B").alias("buy_order_id"),
        F.lit("S").alias("sell_order_id"),
        F.date_format(F.timestamp_seconds(i), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        i.alias("ingest_seq"),
        F.timestamp_seconds(i).alias("event_ts"),
    )


def outages(spark, *rows):
    return spark.createDataFrame(list(rows), "kind string, start long, end long")


@pytest.fixture(scope="module")
def drill(spark, tmp_path_factory):
    feed = trades(spark)
    windows = outages(spark, ("PARTITION", 60, 90), ("HALT", 100, 110))
    root = str(tmp_path_factory.mktemp("drill"))
    at = dual_ingestion(spark, slices_of(feed, [0, 50, N]), windows, root)
    ledger = outcomes.outcome_ledger(outcomes.flag_outages(feed, windows))
    return at, ledger, windows, root


def held(spark, path):
    return {(r.trade_id, r.price) for r in stores.read_store(spark, path).collect()}


def test_a_delivery_is_dealt_evenly_over_its_files(spark, tmp_path):
    """Each half of the feed lies in one split of the input; its consumers are to read it in several tasks."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        feed = trades(spark, 4000)
        at = dual_ingestion(spark, slices_of(feed, [0, 2000, 4000]), outages(spark, ("PARTITION", 0, 0)), str(tmp_path))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    files = spark.read.schema(FEED).parquet(at.topic).groupBy(
        F.floor(F.col("ingest_seq") / 2000).alias("delivery"), F.input_file_name().alias("file")
    ).count().collect()
    for delivery in (0, 1):
        rows = [r["count"] for r in files if r.delivery == delivery]
        assert sum(rows) == 2000 and max(rows) < 1000
    assert stores.read_store(spark, at.legacy).count() == len({r.trade_id for r in feed.collect()})


def test_set_aside_splits_as_the_reasons_do(spark, tmp_path):
    texts = ["T1", " T", "\t", "", None, "\u2003", "\u200b", "\u00e9", "\x7f", "\x1f", "~ "]
    rows = [(t, "A", p, q, "B", "S", "x") for t in texts for p in ("1.00", "0.00", None) for q in (1, 0, None)]
    given = spark.createDataFrame(rows, "trade_id string, instrument string, p string, quantity int, buy_order_id string, sell_order_id string, timestamp string")
    given = given.withColumn("price", F.col("p").cast("decimal(15,2)")).drop("p").repartition(1)
    good = loads.set_aside(given, str(tmp_path), "w", 0)
    want_good, want_bad = validate.split_checked(validate.with_trade_reasons(given))
    bad = spark.read.parquet(f"{tmp_path}/writer=w/batch_id=0")
    assert sorted(map(str, good.collect())) == sorted(map(str, want_good.collect()))
    assert sorted(map(str, bad.select(*want_bad.columns).collect())) == sorted(map(str, want_bad.collect()))
    assert {r.trade_id for r in good.collect()} == {"T1", " T", "\u200b", "\u00e9", "\x7f", "~ "}


def test_both_consumers_match_the_batch_ledger(spark, drill):
    at, ledger, _, _ = drill
    rows = ledger.collect()
    assert held(spark, at.legacy) == {(r.trade_id, r.price) for r in rows if r.legacy_inserted}
    assert held(spark, at.cloud) == {(r.trade_id, r.price) for r in rows if r.cloud_inserted}
    letters = spark.read.parquet(at.dead_letters)
    assert sorted(r.ingest_seq for r in letters.collect()) == list(range(60, 90))


def test_dead_letters_heal_the_outage_but_not_the_halt(spark, drill, tmp_path):
    at, _, _, _ = drill
    cloud, letters = str(tmp_path / "cloud"), str(tmp_path / "letters")
    stores.append_idempotent(stores.read_store(spark, at.cloud).select(*TRADE_COLUMNS), cloud, "load", 0)
    reconcile.read_dead_letters(spark, at.dead_letters).write.partitionBy("batch_id").parquet(letters)
    done = reconcile.replay_dead_letters(spark, at.legacy, cloud, letters).first()
    lacking = parity.missing_ids(stores.read_store(spark, at.legacy), stores.read_store(spark, cloud))
    assert done.initial_missing_count - done.replayed_count == lacking.count() == done.final_drift > 0
    assert reconcile.read_dead_letters(spark, letters).count() == 0


def test_letters_stay_open_until_their_trade_is_there(spark, drill, tmp_path, monkeypatch):
    """One that comes while a replay runs, and those whose ids the primary lacks as yet."""
    at, _, _, _ = drill
    cloud, legacy, letters = (str(tmp_path / n) for n in ("cloud", "legacy", "letters"))
    stores.append_idempotent(stores.read_store(spark, at.cloud).select(*TRADE_COLUMNS), cloud, "load", 0)
    all_letters = reconcile.read_dead_letters(spark, at.dead_letters)
    late = all_letters.filter("ingest_seq = 60")
    all_letters.filter("ingest_seq != 60").write.partitionBy("batch_id").parquet(letters)
    first, other = [r.trade_id for r in all_letters.filter("ingest_seq in (61, 62)").orderBy("ingest_seq").collect()]
    primary = stores.read_store(spark, at.legacy).select(*TRADE_COLUMNS)
    stores.append_idempotent(primary.filter(f"trade_id not in ('{first}', '{other}')"), legacy, "load", 0)

    replay = reconcile.reconcile

    def with_a_late_letter(*args):
        late.withColumn("batch_id", late.batch_id + 100).write.mode("append").partitionBy("batch_id").parquet(letters)
        return replay(*args)

    monkeypatch.setattr(reconcile, "reconcile", with_a_late_letter)
    reconcile.replay_dead_letters(spark, legacy, cloud, letters)
    monkeypatch.undo()
    holding = {r.trade_id for r in stores.read_store(spark, cloud).collect()}
    left = reconcile.read_dead_letters(spark, letters).collect()
    assert 60 in {r.ingest_seq for r in left}
    assert {r.trade_id for r in left} - {late.first().trade_id} == {first, other} - holding

    stores.append_idempotent(primary, legacy, "load", 1)
    reconcile.replay_dead_letters(spark, legacy, cloud, letters)
    assert reconcile.read_dead_letters(spark, letters).count() == 0


def test_parity_log_has_a_row_per_tick(spark, drill):
    at, ledger, _, _ = drill
    log = spark.read.parquet(at.parity_log).orderBy("batch_id").collect()
    assert [r.status for r in log] == ["IN_PARITY", "DRIFT_DETECTED"]
    whole = parity.parity_audit(stores.read_store(spark, at.legacy), stores.read_store(spark, at.cloud))
    assert whole.first().asDict() == {k: log[1][k] for k in whole.columns}


def test_restart_takes_up_where_it_stopped(spark, drill):
    at, _, windows, root = drill
    before = held(spark, at.legacy), held(spark, at.cloud)
    loads.drain(loads.load_legacy(topics.subscribe(spark, at.topic), at.legacy, f"{root}/checkpoints/legacy"))
    # A new checkpoint delivers the whole topic again, as another writer's rows would be kept.
    loads.drain(loads.load_legacy(topics.subscribe(spark, at.topic), at.legacy, f"{root}/again"))
    assert held(spark, at.legacy) == before[0]
    loads.drain(
        loads.load_cloud(topics.subscribe(spark, at.topic), at.cloud, at.dead_letters, windows,
                         f"{root}/checkpoints/cloud")
    )
    assert held(spark, at.cloud) == before[1]


def test_redelivery_adds_nothing_and_the_cap_splits_batches(spark, tmp_path):
    topic, store = topics.topic_path(str(tmp_path)), str(tmp_path / "store")
    for _ in range(2):
        topics.publish(trades(spark), topic)
    stores.create_store(spark, store)
    stream = topics.subscribe(spark, topic, max_files=1)
    loads.drain(loads.load_legacy(stream, store, str(tmp_path / "ck")))
    df = stores.read_store(spark, store)
    assert df.count() == df.select("trade_id").distinct().count() == trades(spark).select("trade_id").distinct().count()
    assert stores.read_totals(spark, store).count() == 4


def test_bad_payloads_go_to_quarantine_and_the_load_goes_on(spark, tmp_path):
    good = {"trade_id": "P1", "instrument": "A", "price": 1.5, "quantity": 2, "buy_order_id": "B",
            "sell_order_id": "S", "timestamp": "2026-10-01T10:00:00Z"}
    lines = [json.dumps(good), "{broken", json.dumps({**good, "trade_id": "P2", "price": 0}),
             json.dumps({**good, "trade_id": "P3"})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    store = str(tmp_path / "store")
    stores.create_store(spark, store)
    stream = topics.subscribe_payloads(spark, str(tmp_path / "in"))
    loads.drain(loads.load_payloads(stream, store, str(tmp_path / "q"), str(tmp_path / "ck")))
    assert {r.trade_id for r in stores.read_store(spark, store).collect()} == {"P1", "P3"}
    bad = spark.read.parquet(str(tmp_path / "q")).collect()
    assert sorted(r.reject_reasons[0] for r in bad) == ["malformed payload", "price must be strictly positive"]


def test_typed_rows_that_break_a_rule(spark, tmp_path):
    topic, store = topics.topic_path(str(tmp_path)), str(tmp_path / "store")
    feed = trades(spark).withColumn("quantity", F.when(F.col("ingest_seq") == 3, 0).otherwise(F.col("quantity")))
    topics.publish(feed, topic)
    stores.create_store(spark, store)
    loads.drain(loads.load_checked(topics.subscribe(spark, topic), store, str(tmp_path / "q"), str(tmp_path / "ck")))
    assert [r.trade_id for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["T3"]
    assert stores.read_store(spark, store).filter("trade_id = 'T3'").count() == 0


def test_a_failing_batch_fails_the_caller(spark, tmp_path):
    topic = topics.topic_path(str(tmp_path))
    topics.publish(trades(spark), topic)

    def fail(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(Exception):
        loads.drain(loads.start(topics.subscribe(spark, topic), fail, str(tmp_path / "ck")))


@pytest.mark.parametrize("late_by", [None, "5 seconds"])
def test_throughput_of_a_stream(spark, tmp_path, late_by):
    topic, path = topics.topic_path(str(tmp_path)), str(tmp_path / "buckets")
    topics.publish(trades(spark), topic)
    stream = topics.subscribe(spark, topic)
    loads.drain(telemetry.log_throughput(stream, path, str(tmp_path / "ck"), "10 seconds", late_by))
    got = spark.read.parquet(path).collect()
    assert all(r.trades == 10 for r in got)
    # With a watermark the buckets it has not passed are still open.
    assert len(got) == (12 if late_by is None else 11)


def test_kafka_options():
    options = topics.kafka_options("h:9092", max_offsets=5)
    assert options["subscribe"] == "market.trades" and options["maxOffsetsPerTrigger"] == "5"
    assert "maxOffsetsPerTrigger" not in topics.kafka_options("h:9092")


def test_two_topics_into_one_store(spark, tmp_path):
    store = str(tmp_path / "store")
    stores.create_store(spark, store)
    feed = trades(spark, 40)
    for name, part in (("a", feed.filter("ingest_seq < 20")), ("b", feed.filter("ingest_seq >= 10"))):
        topics.publish(part, str(tmp_path / name))
        stream = topics.subscribe(spark, str(tmp_path / name))
        loads.drain(loads.load_legacy(stream, store, str(tmp_path / f"ck_{name}")))
    assert stores.read_store(spark, store).count() == feed.select("trade_id").distinct().count()


def test_each_delivered_trade_is_accounted_for(spark, tmp_path):
    """Accepted, duplicate, dropped, halted and refused add up to what was delivered; an outage that
    begins between two batches counts from then on."""
    topic, store = topics.topic_path(str(tmp_path)), str(tmp_path / "store")
    stores.create_store(spark, store)
    feed = trades(spark).withColumn("quantity", F.when(F.col("ingest_seq") % 13 == 3, 0).otherwise(F.col("quantity")))
    known = []
    for lo, hi in ((0, 60), (60, N)):
        topics.publish(feed.filter(f"ingest_seq >= {lo} AND ingest_seq < {hi}"), topic)
        stream = topics.subscribe(spark, topic)
        load = loads.load_cloud(
            stream, store, str(tmp_path / "letters"), lambda: outages(spark, *known) if known else outages(spark, ("HALT", -2, -1)),
            str(tmp_path / "ck"), quarantine=str(tmp_path / "q"), outcomes=str(tmp_path / "o"),
        )
        loads.drain(load)
        known.append(("PARTITION", 0, 90))
    met = spark.read.parquet(str(tmp_path / "o")).collect()
    refused = spark.read.parquet(str(tmp_path / "q")).collect()
    assert sorted(r.ingest_seq for r in met + refused) == list(range(N))
    assert {r.ingest_seq for r in met if r.cloud_status == "DROPPED_BY_CHAOS"} == set(range(60, 90))
    assert all(r.reject_reasons for r in refused)
    assert stores.read_store(spark, store).count() == sum(r.cloud_status == "STORED" for r in met)


def test_rate_cap():
    assert [topics.rate_cap(r) for r in (-3, 0, 20, 1000)] == [1, 1, 20, 100]
    assert topics.rate_cap(20, 5) == 100


def test_records_are_decoded_or_set_aside(spark, tmp_path):
    good = {"trade_id": "K1", "instrument": "A", "price": 1.5, "quantity": 2, "buy_order_id": "B",
            "sell_order_id": "S", "timestamp": "2026-10-01T10:00:00Z"}
    values = [json.dumps(good), "{broken", json.dumps({**good, "trade_id": "K2", "price": 0}), json.dumps({**good, "trade_id": "K3"}), None]
    records = spark.createDataFrame([(v, i % 2, i) for i, v in enumerate(values)], "v string, partition int, offset long").select(
        F.col("v").cast("binary").alias("value"), "partition", "offset", F.lit("2026-01-01 00:00:00").cast("timestamp").alias("timestamp")
    )
    rows = topics.decode_records(records).collect()
    assert len(rows) == len(values) and len({r.ingest_seq for r in rows}) == len(values)
    assert {r.trade_id for r in rows if not r.reject_reasons} == {"K1", "K3"}
    assert all(r.event_ts is not None for r in rows)
    assert topics.rate_cap(20) == int(topics.kafka_options("h", max_offsets=topics.rate_cap(20))["maxOffsetsPerTrigger"])


def test_jdbc_options_of_both_sides():
    from twinledger.sources.jdbc import jdbc_options, write_options

    login = {"user": "u", "password": "p", "driver": "d"}
    how = {**login, "partition_column": "batch", "lower": 0, "upper": 9, "partitions": 4, "fetch_size": 5}
    reading, writing = jdbc_options("jdbc:x", "t", **how), write_options("jdbc:x", "t", **how)
    assert login.items() <= reading.items() and reading["numPartitions"] == "4"
    assert writing == {"url": "jdbc:x", "dbtable": "t", **login}


def test_a_dimension_is_joined_left_or_inner(spark):
    from twinledger.plans.joins import join_dimension

    with pytest.raises(ValueError):
        join_dimension(spark.range(3), spark.range(3), "id", "full")
