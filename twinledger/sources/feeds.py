"""CSV feeds in and out, and a short profile of a dataset."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import to_number
from twinledger.schema import PRICE_TYPE, RAW_FEED


# The order of arrival of a CSV feed: by file name, then by line.
ARRIVAL = ["arr_file", "arr_block", "arr_row"]
#: Columns that the header of a row's file lacks.
ABSENT = "arr_absent"
#: A feed whose files have more different headers than this is refused.
MOST_HEADERS = 1000
_ROW_IN_PARTITION = (1 << 33) - 1
_LINE, _REASON = "line_text", "line_reason"


def headers(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and its first line, of a CSV file or a folder of them. Only the first part of each file is read."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    return lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("header"))


def _names(header: str) -> list[str]:
    """The column names of a header line; a name that comes again gets its place in the line."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header.lstrip("\ufeff")]))):
        names.append(name if name and name not in names else f"{name}.{i}")
    return names


def read_lines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a raw feed, columns resolved by the header of its own file and all as text.

    A column that a file lacks is NULL, and named in ``arr_absent``; one that the feed does not know is left out. A line with
    more or fewer fields than its header has no values but ``line_text`` and ``line_reason``, which are NULL for all other lines.
    ``ARRIVAL`` orders the lines: those of one block of a file are read in order by one task, so their running
    number orders them, whatever else the task reads.
    """
    layouts = headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files")).limit(MOST_HEADERS + 1).collect()
    if len(layouts) > MOST_HEADERS:
        raise ValueError(f"{path} has more than {MOST_HEADERS} different headers")
    feed = spark.createDataFrame([], T.StructType([*RAW_FEED.fields, *_LINE_FIELDS]))
    for layout in layouts:
        feed = feed.unionByName(_of_layout(spark, _names(layout.header), layout.files))
    return feed


_LINE_FIELDS = [
    T.StructField(ABSENT, T.ArrayType(T.StringType())),
    T.StructField(_LINE, T.StringType()),
    T.StructField(_REASON, T.StringType()),
    T.StructField("arr_file", T.StringType()),
    T.StructField("arr_block", T.LongType()),
    T.StructField("arr_row", T.LongType()),
]


def _of_layout(spark: SparkSession, names: list[str], files: list[str]) -> DataFrame:
    # Positions as names, so that no header can clash with the reader's own column.
    fields = [T.StructField(f"_f{i}", T.StringType()) for i in range(len(names))]
    # All fields are parsed whatever is asked for, or a broken line would not show.
    reader = spark.read.schema(T.StructType([*fields, T.StructField("_broken", T.StringType())])).options(
        header=True, columnNameOfCorruptRecord="_broken", columnPruning=False
    )
    # Spark refuses to read the column of broken lines alone, as a count would. The second part is never anything but NULL.
    broken = F.coalesce("_broken", F.when(F.length("_f0") < 0, F.col("_f0")))
    # One field more than the header; a letter behind the line keeps an empty last field from being NULL.
    longer = F.from_csv(F.concat(broken, F.lit("x")), ", ".join(f"_f{i} string" for i in range(len(names) + 1)))[f"_f{len(names)}"]
    reason = F.when(broken.isNotNull(), F.when(longer.isNull(), "fewer fields than the header").otherwise("more fields than the header"))
    place = {name: f"_f{i}" for i, name in enumerate(names)}
    known = [
        (F.when(broken.isNull(), F.col(place[c])) if c in place else F.lit(None).cast("string")).alias(c) for c in RAW_FEED.fieldNames()
    ]
    absent = F.array(*[F.lit(c) for c in RAW_FEED.fieldNames() if c not in place]).cast("array<string>")
    return reader.csv(files).select(
        *known,
        absent.alias(ABSENT),
        broken.alias(_LINE),
        reason.alias(_REASON),
        F.col("_metadata.file_path").alias("arr_file"),
        F.col("_metadata.file_block_start").alias("arr_block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)).alias("arr_row"),
    )


def read_arriving_csv(spark: SparkSession, path: str) -> DataFrame:
    """A raw feed with ``ARRIVAL``, its order of arrival, and ``arr_absent``. Broken lines are left to ``broken_lines``."""
    return read_lines_csv(spark, path).filter(F.col(_LINE).isNull()).drop(_LINE, _REASON)


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a raw feed that do not fit the header of their file: their text, the reason and where they are."""
    return read_lines_csv(spark, path).filter(F.col(_LINE).isNotNull()).select(_LINE, _REASON, *ARRIVAL)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """A raw feed, every column as text, by the names in the header of each file."""
    return read_arriving_csv(spark, path).select(*RAW_FEED.fieldNames())


def read_trades_csv(spark: SparkSession, path: str) -> DataFrame:
    """A cleansed CSV feed as typed trades. What does not fit a type becomes NULL, for
    validation to reject."""
    return to_trades(read_raw_csv(spark, path))


def to_trades(text: DataFrame) -> DataFrame:
    """Text columns to the types of a trade."""
    return text.withColumns(
        {
            "price": to_number(F.col("price")).try_cast(PRICE_TYPE),
            "quantity": to_number(F.col("quantity")).try_cast("int"),
        }
    )


def write_trades(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite ``path``; Parquet unless another format is asked for."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def dataset_summary(df: DataFrame) -> DataFrame:
    """Row count and, per column, its type and how many values are present: one row per column."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_n_{c}") for c in names]
    )
    per_column = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("column_index"),
                    F.lit(c).alias("column_name"),
                    F.lit(df.schema[c].dataType.simpleString()).alias("column_type"),
                    F.col(f"_n_{c}").alias("present"),
                )
                for i, c in enumerate(names)
            ]
        )
    )
    return counts.select(F.col("_rows").alias("total_rows"), per_column.alias("_c")).select(
        "total_rows", "_c.*"
    )


def preview(df: DataFrame, order_by: list[str], n: int = 3) -> DataFrame:
    """The first rows in feed order."""
    return df.orderBy(*order_by).limit(n)
