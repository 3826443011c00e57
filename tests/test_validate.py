"""Invariants of trades, orders and instruments; payloads; quarantine or failure."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from twinledger.functions.numbers import notional
from twinledger.operators.store import storable
from twinledger.operators.validate import (
    accepted,
    rejected,
    split_checked,
    with_instrument_reasons,
    with_order_reasons,
    with_trade_reasons,
)
from twinledger.schema import INSTRUMENT, ORDER, TRADE, TRADE_COLUMNS
from twinledger.sources.payloads import parse_payloads, to_json_payload

GOOD = ("TRD-1001", "AAPL", Decimal("150.50"), 10, "BUY-001", "SELL-002", "2026-10-01T10:00:00Z")


def trade(**changes):
    return tuple(changes.get(c, v) for c, v in zip(TRADE_COLUMNS, GOOD))


def reasons(spark, row):
    return with_trade_reasons(spark.createDataFrame([row], TRADE)).first().reject_reasons


def test_good_trade_and_notional(spark):
    assert reasons(spark, GOOD) == []
    df = spark.createDataFrame([trade(price=Decimal("120.00"), quantity=50)], TRADE)
    assert float(df.select(notional()).first()[0]) == 6000.0


@pytest.mark.parametrize("price", ["0.0", "-1.0", "-99.99", None])
def test_bad_price(spark, price):
    bad = trade(price=None if price is None else Decimal(price))
    assert reasons(spark, bad) == ["price must be strictly positive"]


@pytest.mark.parametrize("quantity", [0, -1, -500, None])
def test_bad_quantity(spark, quantity):
    assert reasons(spark, trade(quantity=quantity)) == ["quantity must be strictly positive"]


@pytest.mark.parametrize(
    "field", ["trade_id", "instrument", "buy_order_id", "sell_order_id", "timestamp"]
)
@pytest.mark.parametrize("text", ["   ", "", "\t ", None])
def test_blank_text(spark, field, text):
    assert reasons(spark, trade(**{field: text})) == [f"{field} must be a non-empty string"]


def test_nan_price_is_rejected(spark):
    df = spark.createDataFrame([GOOD], TRADE).withColumn("price", F.lit(float("nan")))
    assert with_trade_reasons(df).first().reject_reasons == ["price must be strictly positive"]


def test_all_reasons_are_listed_and_store_check_agrees(spark):
    rows = [GOOD, trade(trade_id=" ", price=Decimal(0), quantity=-1), trade(quantity=0)]
    df = spark.createDataFrame(rows, TRADE)
    checked = with_trade_reasons(df)
    assert rejected(checked).count() == 2
    assert len(rejected(checked).filter("trade_id = ' '").first().reject_reasons) == 3
    assert storable(df).collect() == accepted(checked).collect()


def order(**changes):
    base = {
        "order_id": "ORD-101", "side": "BUY", "instrument": "AAPL", "price": Decimal("150.00"),
        "quantity": 20, "timestamp": "2026-10-01T10:00:00Z", "account_id": None, "status": None,
    }
    return tuple({**base, **changes}[f.name] for f in ORDER.fields)


def test_orders(spark):
    rows = [order(), order(side="sell"), order(side="HOLD"), order(side=" BUY"), order(side=None)]
    got = with_order_reasons(spark.createDataFrame(rows, ORDER)).collect()
    assert [bool(r.reject_reasons) for r in got] == [False, False, True, True, True]
    assert got[0].status == "FILLED"
    df = spark.createDataFrame([order()], ORDER)
    assert float(df.select(notional()).first()[0]) == 3000.0


def test_instruments(spark):
    rows = [
        ("AAPL", "Apple Inc.", "EQUITY", None, None),
        ("AAPL", "Apple Inc.", "EQUITY", 0.0, 1),
        ("AAPL", " ", "EQUITY", 0.5, 0),
    ]
    got = with_instrument_reasons(spark.createDataFrame(rows, INSTRUMENT)).collect()
    assert (got[0].tick_size, got[0].lot_size, got[0].reject_reasons) == (0.01, 1, [])
    assert got[1].reject_reasons == ["tick_size must be strictly positive"]
    assert len(got[2].reject_reasons) == 2


def test_fail_mode_stops_the_job(spark):
    checked = with_trade_reasons(spark.createDataFrame([GOOD, trade(quantity=0)], TRADE))
    good, bad = split_checked(checked)
    assert (good.count(), bad.count()) == (1, 1)
    strict, _ = split_checked(checked, mode="fail")
    with pytest.raises(Exception, match="quantity must be strictly positive"):
        strict.collect()
    all_good = with_trade_reasons(spark.createDataFrame([GOOD], TRADE))
    assert split_checked(all_good, mode="fail")[0].count() == 1
    with pytest.raises(ValueError):
        split_checked(checked, mode="other")


def test_payloads(spark):
    good = {
        "trade_id": "TRD-API-001", "instrument": "AAPL", "price": 175.0, "quantity": 20,
        "buy_order_id": "BUY-1", "sell_order_id": "SELL-1", "timestamp": "2026-10-01T10:00:00Z",
    }
    texts = [
        json.dumps(good),
        json.dumps({**good, "price": "175.0", "quantity": "20"}),
        json.dumps({k: v for k, v in good.items() if k != "price"}),
        json.dumps({**good, "price": -1}),
        json.dumps({**good, "price": "abc"}),
        json.dumps(good)[:-20],
        "not json",
        "",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    got = [r.reject_reasons for r in parse_payloads(df).orderBy("i").collect()]
    assert got[:2] == [[], []]
    assert got[2] == ["missing price"]
    assert got[3] == got[4] == ["price must be strictly positive"]
    assert got[5:] == [["malformed payload"]] * 4


def test_payload_round_trip(spark):
    df = spark.createDataFrame([GOOD], TRADE).withColumn(
        "payload", to_json_payload()
    ).select("payload")
    row = parse_payloads(df).first()
    assert tuple(row[c] for c in TRADE_COLUMNS) == GOOD and row.reject_reasons == []
