"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by its weight, at most ``cap`` times its own words; what goes
beyond is shared out again. A source that is to give ``c`` times its words takes every document
``floor(c)`` times for certain, and samples the rest: documents are ranked by their random odds
divided by their inclusion odds, U / (1 - U) over p / (1 - p), and the first ones are taken, up to the
words that are left. Two more passes along the same order fill what the last document left open.

Random numbers are hashes of id and text, so reruns agree. A running sum over a source is made
of sums over 1024 stretches of the order and one sum inside the stretch where it ends, so a
source with a third of all rows is never one task. At the end one more document may be taken that passes
the target, if that comes closer to it.

NULL text has size 0; NULL is a source of its own, last in order. Rows that are repeats of one
document (same id and text) share their random number and are taken together or not at all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import packed, unpacked, utf8
from twinledger.plans.joins import join_dimension
from twinledger.session import materialize

WEIGHTS = (1, 2, 3)
CAP = 3.0
SEED = 20240607
STRETCHES = 1024
PASSES = 3


def word_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(t.split())).astype("int64")  # bytes split at ASCII white space

    return words(utf8(text))


def source_key(source: Column) -> Column:
    """A key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1, both excluded, that id and text decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``skey``, ``source_size`` and ``target`` of each source, one row per source.

    Sources in the order of their names (by code point, NULL last) have the weights in turn. With
    sources in order of how soon they reach their cap, the ones at their cap are the first k, for
    the smallest k at which the level of the others lies below the next one's cap.
    """
    sums = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    array = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sums.withColumn("weight", F.element_at(array, (place % len(weights) + 1).cast("int"))).withColumn(
        "limit", F.col("source_size") * F.lit(float(cap))
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "skey")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))
    )
    final = F.first("open", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("limit"), F.coalesce(final, F.lit(0.0)) * F.col("weight"))
    return levels.select("skey", "source_size", target.alias("target"))


def _reach(rows: DataFrame, room: DataFrame, name: str) -> DataFrame:
    """How far along the order each source can go within its ``room`` of words.

    ``rows`` has ``skey``, ``stretch``, ``z`` and ``size``; ``room`` has one row per ``skey``. Adds the
    last place in reach as ``{name}_stretch`` and ``{name}_z``, and what was used as ``{name}_used``.
    """
    sums = rows.groupBy("skey", "stretch").agg(F.sum("size").alias("size"))
    so_far = Window.partitionBy("skey").orderBy("stretch")
    totals = join_dimension(sums.withColumn("total", F.sum("size").over(so_far)), room.select("skey", "room"), "skey", "inner")
    fits = F.col("total") <= F.col("room")
    edge = totals.groupBy("skey").agg(
        F.coalesce(F.max(F.when(fits, F.col("total"))), F.lit(0)).alias("base"),
        F.min(F.when(~fits, F.col("stretch"))).alias("edge"),
        F.first("room").alias("room"),
    )
    there = join_dimension(rows, edge, "skey", "inner").filter("stretch = edge")
    # Ties share a value, and a range frame takes all of them or none.
    inside = there.withColumn("total", F.col("base") + F.sum("size").over(Window.partitionBy("skey").orderBy("z")))
    last = inside.filter("total <= room").groupBy("skey").agg(
        F.max("z").alias(f"{name}_z"), F.max("total").alias("reached")
    )
    return edge.join(last, "skey", "left").select(
        "skey",
        F.coalesce("edge", F.lit(STRETCHES)).alias(f"{name}_stretch"),
        F.coalesce(f"{name}_z", F.lit(-1.0)).alias(f"{name}_z"),
        F.coalesce("reached", "base").alias(f"{name}_used"),
    )


def mix(sized: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with ``skey``, ``source``, ``size`` and ``u``.

    ``sized`` should be a table, since it is read once a pass.
    """
    plan = source_targets(sized, weights, cap)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(times + 1e-9)).withColumn(
        "p", F.greatest(F.lit(0.0), times - F.col("whole"))
    ).withColumn("room", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    plan = materialize(plan, "mix_plan")

    odds = F.col("u") / (1 - F.col("u"))
    z = F.when(F.col("p") > 0, odds / (F.col("p") / (1 - F.col("p")))).otherwise(F.lit(float("inf")))
    stretch = F.floor(F.col("u") * STRETCHES).cast("int")  # in a source, z rises with u

    def ranked(plan: DataFrame) -> DataFrame:
        return join_dimension(sized, plan, "skey").withColumn("z", z).withColumn("stretch", stretch)

    taken = F.lit(False)
    for name in [f"cut{i}" for i in range(PASSES)]:
        rows = ranked(plan).filter(~taken & (F.col("p") > 0) & (F.col("size") <= F.col("room")))
        far = _reach(rows.select("skey", "stretch", "z", "size"), plan, name)
        plan = materialize(
            plan.join(far, "skey", "left")
            .withColumn(f"{name}_room", F.col("room"))
            .withColumn("room", F.col("room") - F.coalesce(F.col(f"{name}_used"), F.lit(0))),
            "mix_plan",
        )
        reached = (F.col("stretch") < F.col(f"{name}_stretch")) | (
            (F.col("stretch") == F.col(f"{name}_stretch")) & (F.col("z") <= F.col(f"{name}_z"))
        )
        taken = taken | F.coalesce(
            (F.col("p") > 0) & (F.col("size") <= F.col(f"{name}_room")) & reached, F.lit(False)
        )
    # A last document that comes closer to the target by going past it.
    gap = F.struct(F.abs(F.col("size") - F.col("room")).alias("gap"), "z")
    left = ranked(plan).filter(~taken & (F.col("p") > 0) & (F.col("size") < 2 * F.col("room")))
    last = left.groupBy("skey").agg(F.min(gap).alias("last"))
    plan = materialize(plan.join(last, "skey", "left"), "mix_plan")
    taken = taken | F.coalesce((F.col("p") > 0) & (F.col("z") == F.col("last.z")), F.lit(False))
    copies = (F.col("whole") + F.when(taken, 1).otherwise(0)).cast("long")
    return ranked(plan).select(*sized.columns, "source_size", "target", copies.alias("copies"))


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        source_key(F.col("source")).alias("skey"),
        word_count(F.col("text")).alias("size"),
        uniform(F.col("doc_id"), F.col("text")).alias("u"),
    )


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it.

    Documents taken once or more are joined to their texts on the random number, id and all.
    """
    rows = packed(docs).select(
        "_row",
        source_key(F.col("_row.source")).alias("skey"),
        uniform(F.col("_row.doc_id"), F.col("_row.text")).alias("u"),
    )
    sized = materialize(
        rows.select("skey", F.col("_row.source").alias("source"), word_count(F.col("_row.text")).alias("size"), "u"),
        "mix_sizes",
    )
    copies = mix(sized, weights, cap).filter("copies > 0").groupBy("skey", "u").agg(F.max("copies").alias("copies"))
    chosen = rows.join(copies, ["skey", "u"])
    return unpacked(chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
