"""Numeric coercion, clamping, guarded division and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for every price and quantity a store can hold.
_NUMBER_TYPE = "decimal(38,18)"


def to_number(c: Column) -> Column:
    """Text to an exact number; NULL for anything else.

    Decimal text is read strictly: ``1e3`` and `` 12.5 `` are numbers; ``10d``, ``1_000``, ``inf``
    and ``nan`` are not, although a cast to double would take some of them.
    """
    return c.try_cast(_NUMBER_TYPE)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def divide_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def notional(price: str = "price", quantity: str = "quantity") -> Column:
    """Cash value of a trade or an order, exact in decimals."""
    return F.col(price) * F.col(quantity)


def money_text(c: Column) -> Column:
    """``1234567.5`` as ``1,234,567.50``."""
    return F.format_number(c, 2)
