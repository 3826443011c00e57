"""Feed positions and running values over a whole feed, without a single-task window.

A window without PARTITION BY puts every row into one task. The operators here work in two
levels instead: rows are cut into blocks, each block is handled in its own task, and only one
row per block is ordered globally.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.session import materialize

# Positions are unique whole numbers, so a block never holds more rows than its width.
_LEAST_WIDTH = 1024

_ROW_IN_PARTITION = (1 << 33) - 1


def with_position(df: DataFrame, order_by: list[str], name: str = "ingest_seq") -> DataFrame:
    """Number all rows 0, 1, 2, … in the order of ``order_by``.

    The rows are range-partitioned on the whole ordering key, so a value that is frequent in one
    column does not gather in one task. The sorted rows are written once, which freezes where
    the ranges were cut; the start of each partition then comes from one count per partition.
    """
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)).alias("_row"),
        )
    )
    table = materialize(ranged, "positions")
    # One row per shuffle partition: bounded by the session's partition count.
    sizes = table.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return table.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_row")).cast("long").alias(name)
    )


def block_width(last_position: int) -> int:
    """The width at which blocks are about as long as there are blocks: a million each way for a
    million million positions."""
    return max(_LEAST_WIDTH, math.isqrt(max(last_position, 0)))


def scan_forward(
    df: DataFrame,
    seq: str,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    sums_since: dict[str, tuple[Column, Column]] | None = None,
    width: int | None = None,
) -> DataFrame:
    """Add running values along ``seq``, the current row included.

    ``sums`` adds up a value; ``lasts`` keeps the last one that is not NULL; ``sums_since`` takes a
    value and a condition, and adds up the value over the rows behind the last one where the
    condition held.

    ``seq`` must be unique and whole. ``width`` is the number of positions per block; left out,
    it follows from the largest position. The values within blocks are written once, and what
    each block hands on is read off its last row.
    """
    sums, lasts, sums_since = sums or {}, lasts or {}, sums_since or {}
    if width is None:
        width = block_width(df.agg(F.max(seq)).first()[0] or 0)
    within = (
        Window.partitionBy("_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    )

    def running_sum(c: Column) -> Column:
        return F.coalesce(F.sum(c).over(within), F.lit(0))

    def last_known(c: Column) -> Column:
        return F.last(c, ignorenulls=True).over(within)

    added = df.withColumn("_block", F.expr(f"`{seq}` div {width}")).select(
        "*",
        *[running_sum(c).alias(f"_in_{n}") for n, c in sums.items()],
        *[last_known(c).alias(f"_in_{n}") for n, c in lasts.items()],
        *[running_sum(c).alias(f"_all_{n}") for n, (c, _) in sums_since.items()],
    )
    local = added.withColumns(
        {
            f"_base_{n}": last_known(F.when(restart, F.col(f"_all_{n}")))
            for n, (_, restart) in sums_since.items()
        }
    ).withColumns(
        {
            f"_in_{n}": F.col(f"_all_{n}") - F.coalesce(f"_base_{n}", F.lit(0))
            for n in sums_since
        }
    )
    local = materialize(local.drop(*[f"_all_{n}" for n in sums_since]), "blocks")

    ends = local.groupBy("_block").agg(
        *[F.max_by(f"_in_{n}", seq).alias(f"_end_{n}") for n in [*sums, *lasts, *sums_since]],
        *[F.max(F.col(f"_base_{n}").isNotNull()).alias(f"_cut_{n}") for n in sums_since],
    )
    so_far = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # A block in which a sum started over hands on its own end; what came before it is taken off.
    ends = ends.withColumns(
        {
            f"_past_{n}": F.sum(f"_end_{n}").over(so_far) - F.col(f"_end_{n}")
            for n in sums_since
        }
    )

    def handed_on(n: str) -> Column:
        past = F.last(F.when(F.col(f"_cut_{n}"), F.col(f"_past_{n}")), ignorenulls=True).over(before)
        return F.col(f"_past_{n}") - F.coalesce(past, F.lit(0))

    carried = ends.select(
        "_block",
        *[F.coalesce(F.sum(f"_end_{n}").over(before), F.lit(0)).alias(f"_to_{n}") for n in sums],
        *[F.last(f"_end_{n}", ignorenulls=True).over(before).alias(f"_to_{n}") for n in lasts],
        *[handed_on(n).alias(f"_to_{n}") for n in sums_since],
    )

    def since(n: str) -> Column:
        inside = F.col(f"_in_{n}")
        return F.when(F.col(f"_base_{n}").isNotNull(), inside).otherwise(F.col(f"_to_{n}") + inside)

    return local.join(carried, "_block").select(
        *df.columns,
        *[(F.col(f"_to_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums],
        *[F.coalesce(f"_in_{n}", f"_to_{n}").alias(n) for n in lasts],
        *[since(n).alias(n) for n in sums_since],
    )


def keep_first(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """The first row of each key.

    Spark limits each group to one row before the shuffle, so a key with very many copies sends
    at most one row per input partition.
    """
    ranked = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
