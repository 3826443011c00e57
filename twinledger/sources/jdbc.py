"""Stores kept in a database, where its JDBC driver is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.operators.store import first_copies, not_held, storable
from twinledger.schema import PRICE_TYPE, TRADE_COLUMNS


def jdbc_options(
    url: str,
    table: str = "trades",
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Read options. With a numeric or time ``partition_column`` and its bounds the table is read
    by many tasks; the database does the filtering either way."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if partition_column:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def write_options(url: str, table: str = "trades", **how) -> dict[str, str]:
    """The same connection (user, password, driver, …) without what only concerns reading."""
    reading = ("partition_column", "lower", "upper", "partitions", "fetch_size")
    return {"url": url, "dbtable": table, **{k: v for k, v in how.items() if k not in reading}}


def read_jdbc_store(spark: SparkSession, url: str, table: str = "trades", **how) -> DataFrame:
    rows = spark.read.format("jdbc").options(**jdbc_options(url, table, **how)).load()
    return rows.select(*TRADE_COLUMNS).withColumns(
        {"price": F.col("price").cast(PRICE_TYPE), "quantity": F.col("quantity").cast("int")}
    )


def append_jdbc(
    trades: DataFrame, url: str, table: str = "trades", order_by: list[str] | None = None, **how
) -> None:
    """Add the trades whose ids the table does not hold; its primary key guards against races."""
    held = read_jdbc_store(trades.sparkSession, url, table, **how)
    rows = not_held(first_copies(storable(trades), order_by), held).select(*TRADE_COLUMNS)
    rows.write.format("jdbc").options(**write_options(url, table, **how)).mode("append").save()
