"""Near-duplicates by SimHash and pigeonhole blocks.

A fingerprint has a bit for each of 64 positions, set if more than half of a text's shingle hashes
have it. Fingerprints within ``radius`` bits of each other are linked. The 64 bits are cut into
``radius + 3`` blocks; two linked fingerprints differ in ``radius`` of them at most, so they agree on
some three. Rows are joined on each choice of three equal blocks, and the Hamming distance is then
verified in the join. Every link is found: nothing is capped.

Only distinct fingerprints are joined, so copies of a text, however many, are one row there.
Components of linked fingerprints come from alternating star contractions on tables.

NULL and empty texts have fingerprint zero and are linked to each other like any other texts.
Repeated rows keep their own row each. A NULL id never names a component unless all its ids are NULL.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import packed, row_key, unpacked, utf8
from twinledger.session import materialize

WORDS = 3
RADIUS = 2
SEED = 42
# Shingles hashed at a time, so that a very long text needs no more memory than a short one.
CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats counted; 0 without words."""
    tokens = text.lower().split()  # ASCII letters and ASCII white space, as bytes have them
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    size = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - size + 1], ends[size - 1 :] - 1
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        shingles = [joined[a:b] for a, b in zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, words: int = WORDS) -> Column:
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return simhash(utf8(text))


def block_masks(radius: int = RADIUS, agree: int = 3) -> list[int]:
    """Masks over each choice of ``agree`` out of ``radius + agree`` blocks, as signed 64-bit numbers."""
    cuts = [round(64 * i / (radius + agree)) for i in range(radius + agree + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints within ``radius`` bits."""
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(block_masks(radius))
        ]
    )
    rows = fingerprints.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    left, right = rows.withColumnRenamed("fp", "a"), rows.withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return left.join(right, (left.t == right.t) & (left.key == right.key) & near).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """For every node with a link, the smallest node it can reach: ``node``, ``root``.

    Alternates large-star and small-star steps until nothing changes. Smallest neighbours are
    aggregated before the shuffle and joined back, so the links of one node are never gathered.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # Rows (u, v): v is a neighbour of u.
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(smallest, "u")
        if large:
            out = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            rest = joined.filter("v != m").select(F.col("m").alias("a"), F.col("v").alias("b"))
            out = rest.union(smallest.filter("u != m").select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a != b").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = materialize(edges, "links")
    last = state(pairs)
    while last[0]:
        pairs = materialize(star(star(pairs, True), False), "links")
        now = state(pairs)
        if now == last:
            break
        last = now
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))


def with_components(rows: DataFrame, by: str, radius: int = RADIUS) -> DataFrame:
    """Add ``component``, the smallest ``by`` value among the rows that links lead to.

    ``rows`` has a column ``fp`` and should be a table, since it is read more than once.
    """
    nodes = materialize(rows.groupBy("fp").agg(F.min(by).alias("_least")), "fingerprints")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("_root")
    )
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component"))
    named = rooted.join(least, "_root").select("fp", "component")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row of ``docs``."""
    fps = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), words).alias("fp")), "simhash")
    return with_components(fps, "doc_id", radius).withColumnRenamed("component", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component: that of the smallest id (NULL last), then of the smallest row hash."""
    columns = docs.columns
    rows = packed(docs).withColumn("_key", row_key(columns))
    rank = F.struct(F.col("_row.doc_id").isNull().alias("no_id"), F.col("_row.doc_id").alias("id"), F.col("_key").alias("key"))
    fps = materialize(
        rows.select(rank.alias("rank"), fingerprint_column(F.col("_row.text"), words).alias("fp")), "simhash"
    )
    kept = with_components(fps, "rank", radius).select(F.col("component.key").alias("_key")).distinct()
    held = rows.join(kept, "_key", "left_semi")
    # Repeats of the chosen row share its key; any one of them is the row.
    return unpacked(held.dropDuplicates(["_key"]))
