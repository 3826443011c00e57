"""Invariants of trades, orders and instruments, as reasons for rejection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.text import is_blank
from twinledger.schema import DEFAULT_LOT_SIZE, DEFAULT_ORDER_STATUS, DEFAULT_TICK_SIZE


def _reasons(rules: dict[str, Column]) -> Column:
    """The broken rules of a row, in order; an unknown outcome counts as broken."""
    broken = [
        F.when(F.coalesce(bad, F.lit(True)), F.lit(reason)) for reason, bad in rules.items()
    ]
    return F.array_compact(F.array(*broken))


def _passes(rules: dict[str, Column]) -> Column:
    """Whether no rule is broken; stops at the first that is."""
    return reduce(lambda a, b: a & b, [F.coalesce(~bad, F.lit(False)) for bad in rules.values()])


def _blank(names: list[str]) -> dict[str, Column]:
    return {f"{n} must be a non-empty string": is_blank(F.col(n)) for n in names}


def _not_positive(name: str, fractional: bool = False) -> dict[str, Column]:
    """NaN compares as larger than any number, so it is excluded by name."""
    bad = F.col(name) <= 0
    if fractional:
        bad = bad | F.isnan(F.col(name).cast("double"))
    return {f"{name} must be strictly positive": bad}


def _trade_rules() -> dict[str, Column]:
    return {
        **_blank(["trade_id", "instrument"]),
        **_not_positive("price", fractional=True),
        **_not_positive("quantity"),
        **_blank(["buy_order_id", "sell_order_id", "timestamp"]),
    }


def trade_reject_reasons() -> Column:
    return _reasons(_trade_rules())


def trade_is_valid() -> Column:
    return _passes(_trade_rules())


def order_reject_reasons() -> Column:
    # The side is compared in upper case and not trimmed.
    return _reasons(
        {
            **_blank(["order_id"]),
            "side must be BUY or SELL": ~F.upper("side").isin("BUY", "SELL"),
            **_blank(["instrument"]),
            **_not_positive("price", fractional=True),
            **_not_positive("quantity"),
            **_blank(["timestamp"]),
        }
    )


def instrument_reject_reasons() -> Column:
    return _reasons(
        {
            **_blank(["symbol", "name"]),
            **_not_positive("tick_size", fractional=True),
            **_not_positive("lot_size"),
        }
    )


def with_order_defaults(orders: DataFrame) -> DataFrame:
    return orders.withColumn("status", F.coalesce("status", F.lit(DEFAULT_ORDER_STATUS)))


def with_instrument_defaults(instruments: DataFrame) -> DataFrame:
    return instruments.withColumns(
        {
            "tick_size": F.coalesce("tick_size", F.lit(DEFAULT_TICK_SIZE)),
            "lot_size": F.coalesce("lot_size", F.lit(DEFAULT_LOT_SIZE)),
        }
    )


def with_trade_reasons(trades: DataFrame) -> DataFrame:
    return trades.withColumn("reject_reasons", trade_reject_reasons())


def with_order_reasons(orders: DataFrame) -> DataFrame:
    return with_order_defaults(orders).withColumn("reject_reasons", order_reject_reasons())


def with_instrument_reasons(instruments: DataFrame) -> DataFrame:
    return with_instrument_defaults(instruments).withColumn(
        "reject_reasons", instrument_reject_reasons()
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reasons") > 0)


def split_checked(checked: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows.

    ``quarantine`` sets bad rows aside; ``fail`` makes the job fail on the first bad row it meets.
    """
    if mode == "quarantine":
        return accepted(checked), rejected(checked)
    if mode != "fail":
        raise ValueError("mode must be 'quarantine' or 'fail'")
    message = F.concat(F.lit("rejected row: "), F.array_join("reject_reasons", "; "))
    strict = checked.withColumn(
        "reject_reasons",
        F.when(F.size("reject_reasons") == 0, F.col("reject_reasons")).otherwise(
            F.raise_error(message)
        ),
    )
    return accepted(strict), rejected(checked)
