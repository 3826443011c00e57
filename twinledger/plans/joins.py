"""Joins to tables whose size is checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 32 * 1024 * 1024
BROADCAST_MAX_ROWS = 500_000

# How many ways a frequent key is split when the other side is too large to broadcast.
SALTS = 16


def fits_broadcast(
    df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, max_rows: int = BROADCAST_MAX_ROWS
) -> bool:
    """Measure a table: its rows and the text length of its values, in one aggregate."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        F.lit(0),
    )
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def join_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join a large table to a reference table on ``key`` ('left' or 'inner').

    A dimension that fits is broadcast. A larger one is shuffled on the key and a salt: each
    dimension row is repeated once per salt, so a frequent key spreads over that many tasks.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a dimension is joined 'left' or 'inner', not {how!r}")
    if fits_broadcast(dimension):
        return facts.join(F.broadcast(dimension), key, how)
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    right = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], how).drop("_salt")
