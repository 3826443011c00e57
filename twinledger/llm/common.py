"""What the corpus operators share: columns, tables and hidden rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str | Column = "text") -> Column:
    """A text as UTF-8 bytes; NULL is the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("binary"), F.expr("X''"))


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(c, UPPER, LOWER)


def packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct column ``_row``, so that helper columns clash with none of its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def row_key(columns: list[str]) -> Column:
    """A hash over whole rows; rows that share it are taken to be repeats of one row."""
    return F.xxhash64(*[F.col(f"_row.`{c}`") for c in columns])
