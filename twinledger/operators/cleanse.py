"""Cleansing of raw trade feeds.

The order of the steps matters: identifiers, numbers, positivity, keep-first, timestamps. An id
whose first usable copy has a bad timestamp disappears, even when a later copy is good.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.numbers import to_number
from twinledger.functions.text import strip_ws
from twinledger.functions.timestamps import normalize_iso8601
from twinledger.operators.ordering import keep_first
from twinledger.schema import NULL_TOKENS, PRICE_TYPE
from twinledger.sources.feeds import ABSENT, ARRIVAL, read_arriving_csv

STRICT_IDS = ["trade_id", "instrument", "buy_order_id", "sell_order_id"]
BASIC_IDS = ["trade_id", "instrument"]


def _id_present(name: str, strict: bool) -> Column:
    """Not missing, not blank, not the word ``nan`` (in any case when strict)."""
    text = strip_ws(F.col(name))
    word = F.lower(text) if strict else text
    return ~F.col(name).isin(NULL_TOKENS) & ~word.isin("", "nan")


def _id_checked(raw: DataFrame, name: str, strict: bool) -> Column:
    """Present, or not asked for as the row's own file has no such column. A trade id is always asked for."""
    present = _id_present(name, strict)
    if name == "trade_id" or ABSENT not in raw.columns:
        return present
    return F.array_contains(ABSENT, name) | present


def drop_blank_ids(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Keep rows whose identifiers are present, and strip them.

    ``strict`` checks those of the four identifier columns that exist, ignoring case; otherwise
    only the trade id and the instrument are checked.
    """
    ids = [c for c in (STRICT_IDS if strict else BASIC_IDS) if c in raw.columns]
    unchecked = [c for c in STRICT_IDS if c in raw.columns and c not in ids]
    present = reduce(lambda a, b: a & b, [_id_checked(raw, c, strict) for c in ids])
    return raw.filter(present).withColumns(
        {
            **{c: strip_ws(F.col(c)) for c in ids},
            **{c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in unchecked},
        }
    )


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Price and quantity to numbers; NULL where the text is not one. No null token is one."""
    return df.withColumns({c: to_number(F.col(c)) for c in ("price", "quantity")})


def keep_positive(df: DataFrame) -> DataFrame:
    """Drop missing and non-positive numbers, then give them their stored types.

    Quantity is cut to a whole number after the test, so 0.5 passes here and is left as 0 for
    validation to reject. Numbers beyond what a store holds are dropped too, never turned into
    NULL; ``out_of_range`` has those rows with their reasons.
    """
    return (
        df.dropna(subset=["price", "quantity"])
        .filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .withColumns(_stored_numbers())
        .dropna(subset=["price", "quantity"])
    )


def _stored_numbers() -> dict[str, Column]:
    return {
        "price": F.col("price").try_cast(PRICE_TYPE),
        "quantity": F.col("quantity").try_cast("int"),
    }


def out_of_range(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with usable ids and positive numbers that no store can hold, with ``reject_reasons``.

    Price and quantity are left as they were read, in full.
    """
    numbers = coerce_numbers(drop_blank_ids(raw, strict)).filter(
        (F.col("price") > 0) & (F.col("quantity") > 0)
    )
    reasons = [
        F.when(stored.isNull(), F.lit(f"{name} is beyond the store's range"))
        for name, stored in _stored_numbers().items()
    ]
    return numbers.withColumn("reject_reasons", F.array_compact(F.array(*reasons))).filter(
        F.size("reject_reasons") > 0
    )


def with_iso_timestamp(df: DataFrame) -> DataFrame:
    """Timestamps to ISO-8601 UTC text, NULL where they cannot be read."""
    return df.withColumn("timestamp", normalize_iso8601(F.col("timestamp")))


def usable_trades(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with usable ids and numbers, every copy, timestamps rewritten: NULL where they could not be read."""
    return with_iso_timestamp(_before_dedup(raw, strict))


def _before_dedup(raw: DataFrame, strict: bool) -> DataFrame:
    return keep_positive(coerce_numbers(drop_blank_ids(raw, strict)))


def cleanse_trades(raw: DataFrame, order_by: list[str], strict: bool = True) -> DataFrame:
    """A raw feed cleansed. ``order_by`` is the order of arrival among copies of an id, by columns other than ``timestamp``."""
    # Timestamps are parsed for the rows that stay, behind the shuffle, and not for every copy.
    first = keep_first(_before_dedup(raw, strict), "trade_id", order_by)
    return drop_missing(with_iso_timestamp(first), "timestamp")


def drop_missing(df: DataFrame, name: str) -> DataFrame:
    """Drop rows whose ``name`` is NULL, for a column that is costly to compute.

    A filter would be moved below the column's expression and would compute it a second time; unnesting stays above.
    """
    return df.withColumn(name, F.explode(F.array_compact(F.array(name))))


def cleanse_metrics(raw: DataFrame, cleansed: DataFrame) -> DataFrame:
    """Rows in, rows kept, rows dropped and the share dropped, as one row."""
    sides = raw.select(F.lit(1).alias("_in"), F.lit(0).alias("_kept")).unionByName(
        cleansed.select(F.lit(0).alias("_in"), F.lit(1).alias("_kept"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("_in"), F.lit(0)).alias("initial_records"),
        F.coalesce(F.sum("_kept"), F.lit(0)).alias("retained_records"),
    )
    dropped = F.col("initial_records") - F.col("retained_records")
    share = F.when(F.col("initial_records") > 0, 100.0 * dropped / F.col("initial_records"))
    return counts.withColumns({"dropped_records": dropped, "dropped_pct": F.round(share, 2)})


def rejects_by_rule(raw: DataFrame, strict: bool = True) -> DataFrame:
    """How many rows each rule stops, in the order the rules run, before deduplication."""
    ids = [c for c in (STRICT_IDS if strict else BASIC_IDS) if c in raw.columns]
    present = F.coalesce(
        reduce(lambda a, b: a & b, [_id_checked(raw, c, strict) for c in ids]), F.lit(False)
    )
    price = to_number(F.col("price"))
    quantity = to_number(F.col("quantity"))
    rule = (
        F.when(~present, "identifier")
        .when(price.isNull() | quantity.isNull(), "number")
        .when((price <= 0) | (quantity <= 0), "positivity")
        .when(price.try_cast(PRICE_TYPE).isNull() | quantity.try_cast("int").isNull(), "range")
        .otherwise("usable")
    )
    return raw.select(rule.alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))


def write_cleansed_csv(cleansed: DataFrame, path: str) -> None:
    cleansed.write.mode("overwrite").option("header", True).csv(path)


def cleanse_csv(spark: SparkSession, input_path: str, output_path: str, strict: bool = True) -> dict[str, float]:
    """Cleanse a raw CSV, a file or a folder of them, into a CSV. The first copy of an id is the
    first by file name and line. Lines that do not fit their header are in ``feeds.broken_lines``."""
    return cleanse_feed(read_arriving_csv(spark, input_path), ARRIVAL, output_path, strict)


def cleanse_feed(
    raw: DataFrame, order_by: list[str], output_path: str, strict: bool = True
) -> dict[str, float]:
    """Cleanse a feed, write it as CSV and return its metrics."""
    kept = Observation("rows_kept")
    cleansed = cleanse_trades(raw, order_by, strict).observe(kept, F.count(F.lit(1)).alias("rows"))
    write_cleansed_csv(cleansed.drop(*order_by, ABSENT), output_path)
    # Rows in are counted on their own: below a shuffle a stage that runs again counts twice.
    initial, retained = raw.count(), kept.get["rows"]
    return {
        "initial_records": initial,
        "retained_records": retained,
        "dropped_records": initial - retained,
        "dropped_pct": round(100.0 * (initial - retained) / initial, 2) if initial else None,
    }
