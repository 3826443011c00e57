"""Which interval a row falls in: outage and halt windows over a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.operators.ordering import scan_forward, with_position

# Up to this many intervals are written into the plan as a list that each row is held against.
FEW_INTERVALS = 32


def flag_intervals(
    feed: DataFrame,
    intervals: DataFrame,
    kind: str,
    flag: str,
    axis: str = "ingest_seq",
    tie_break: list[str] | None = None,
    few: int = FEW_INTERVALS,
    width: int | None = None,
    unique_axis: bool | None = None,
) -> DataFrame:
    """Add a boolean column ``flag``: the row's ``axis`` value lies in an interval of ``kind``.

    ``intervals`` has ``kind``, ``start`` and ``end`` (end excluded). They may overlap; an empty one
    holds nothing. A row without an ``axis`` value is in none. Every row is returned once, whichever
    of two plans is taken: a few intervals are a list in the expression, without any join; more are
    merged into the feed's order, where one opens and closes, and a row is inside while any is open.
    On an axis of unique whole numbers (as feed positions are) the merged order needs no sort.
    """
    wanted = intervals.filter((F.col("kind") == kind) & (F.col("start") < F.col("end")))
    some = wanted.select("start", "end").limit(few + 1).collect()
    if len(some) <= few:
        inside = F.lit(False)
        for span in some:
            inside = inside | ((F.col(axis) >= F.lit(span["start"])) & (F.col(axis) < F.lit(span["end"])))
        return feed.withColumn(flag, F.coalesce(inside, F.lit(False)))

    columns = feed.columns
    # Intervals that open or close at one place are one mark, so marks are unique there.
    marks = (
        wanted.select(F.inline(F.array(
            F.struct(F.col("start").alias("_at"), F.lit(1).alias("_opens")),
            F.struct(F.col("end").alias("_at"), F.lit(-1).alias("_opens")),
        )))
        .groupBy("_at").agg(F.sum("_opens").alias("_opens"))
        .select(
            *[F.lit(None).cast(feed.schema[c].dataType).alias(c) for c in columns if c != axis],
            F.col("_at").cast(feed.schema[axis].dataType).alias(axis),
            "_opens",
            F.lit(0).alias("_is_row"),
        )
    )
    placed = feed.filter(F.col(axis).isNotNull())
    rows = placed.select("*", F.lit(0).cast("long").alias("_opens"), F.lit(1).alias("_is_row"))
    merged = rows.unionByName(marks)
    if unique_axis if unique_axis is not None else axis == "ingest_seq":
        timeline = merged.withColumn("_position", F.col(axis) * 2 + F.col("_is_row"))
    else:
        timeline = with_position(merged, [axis, "_is_row", *(tie_break or [])], "_position")
    opened = scan_forward(timeline, "_position", sums={"_open": F.col("_opens")}, width=width)
    flagged = opened.filter("_is_row = 1").select(*columns, (F.col("_open") > 0).alias(flag))
    nowhere = feed.filter(F.col(axis).isNull()).withColumn(flag, F.lit(False))
    return flagged.unionByName(nowhere)
