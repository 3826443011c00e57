"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``K`` smallest distinct hashes of a text's five-word shingles. The sketch of a union
is made from the sketches of its parts. Two sketches estimate how much two sets resemble each
other, how much of one the other contains, and one sketch estimates how many distinct shingles there
are; sets of fewer than ``K`` shingles are held whole, and their figures are exact.

Words are what ASCII white space separates, with A-Z in lower case. A text of fewer than five words,
but not none, is one shingle. NULL and empty texts have empty sketches, which resemble each other
fully and nothing else at all.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import utf8
from twinledger.session import materialize

WORDS = 5
K = 128
SEED = 7
PARTITION_BYTES = 32 << 20
_CACHE = 200_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class _Hashes(dict):
    """Word hashes, remembered for the frequent words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < _CACHE:
            self[word] = value
        return value


_hashes = _Hashes()


def sketch(text: bytes, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes of a text, in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - WORDS + 1
    if n < 1:
        mixed = np.zeros(1, np.uint64)
        for i in range(len(h)):
            mixed += h[i : i + 1] * _ODD[i]
        mixed += np.uint64(len(h))
    else:
        mixed = h[:n] * _ODD[0]
        for i in range(1, WORDS):
            mixed += h[i : i + n] * _ODD[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    if len(mixed) > 8 * k:  # repeats are few, or the short list is not enough and all are sorted
        least = np.unique(np.partition(mixed, 2 * k)[: 2 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(mixed)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both sets together."""
    return np.union1d(a, b)[:k]


def _known(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Both sketches up to the largest hash below which both are complete."""
    ends = [s[-1] for s in (a, b) if len(s) >= k]
    return (a[a <= min(ends)], b[b <= min(ends)]) if ends else (a, b)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The estimated share of common shingles in the union."""
    a, b = _known(a, b, k)
    union = len(np.union1d(a, b))
    return len(np.intersect1d(a, b, assume_unique=True)) / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The estimated share of the first set's shingles that the second has."""
    a, b = _known(a, b, k)
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """The estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketch_column(text: Column) -> Column:
    """The sketch of a text, as text."""

    @F.pandas_udf("string")
    def sketches(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(sketch(t)) for t in texts], dtype=object)

    return sketches(utf8(text))


def merged(parts: DataFrame, key: str, fingerprint: str, k: int = K) -> DataFrame:
    """One sketch per ``key`` from the sketches of its parts: ``key`` and ``fingerprint``.

    The smallest ``k`` hashes of each key are picked before and after the shuffle, so a key with very
    many parts sends ``k`` rows per task.
    """
    split = F.udf(lambda t: [int(v) - (1 << 63) for v in decode(t)] if t else [], "array<bigint>")
    values = parts.select(key, F.explode(split(fingerprint)).alias("v"))
    # dense_rank lets repeats of a hash share a place.
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy("v"))
    least = values.distinct().withColumn("_rank", rank).filter(F.col("_rank") <= k)
    join = F.udf(lambda vs: encode(np.array(sorted(v + (1 << 63) for v in vs), np.uint64)), "string")
    found = least.groupBy(key).agg(join(F.collect_list("v")).alias(fingerprint))
    every = parts.select(key).distinct()
    return every.join(found, every[key].eqNullSafe(found[key]), "left").select(every[key], F.coalesce(found[fingerprint], F.lit("")).alias(fingerprint))


_COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one stretch in order, and behind them the first row of the next stretch."""
    rows: list[tuple] = []
    last = None

    def compared(row: tuple, following: tuple) -> tuple:
        doc_id, text, own = row
        cut = len(text) // 4
        edited = (text[: len(text) - cut] + following[1][:cut]).encode()
        other = sketch(edited)
        return (
            doc_id, len(text), hashlib.sha256(edited).hexdigest(), encode(own), encode(other),
            resemblance(own, other), resemblance(own, following[2]),
        )

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _COMPARED.types)], schema=_COMPARED)

    done = False
    for part in batches:
        ids, texts, guests = (part.column(i) for i in range(3))
        for i in range(part.num_rows):
            raw = texts[i].as_py()
            row = (ids[i].as_py(), raw.decode("utf-8", "replace"), sketch(raw))
            if last is not None and not done:
                rows.append(compared(last, row))
            if guests[i].as_py():
                done = True  # repeats of the guest change nothing
                break
            last = row
            if len(rows) >= 1000:
                yield batch()
                rows.clear()
    if rows:
        yield batch()


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the text edited with the next one's beginning, and likenesses.

    The order is that of ``doc_id`` (NULL last), rows with the same id by a hash of their text. Stretches
    of the order are cut at keys that the driver knows, one key per stretch, and texts are shuffled
    to their stretch once. The first row of each stretch is also sent to the one before as a guest.
    """
    spark = docs.sparkSession
    place = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64("text").alias("hash")]
    keys = materialize(docs.select(*place, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")), "order_keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    stretches = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_BYTES)
    ranged = keys.repartitionByRange(stretches, "no_id", "id", "hash").groupBy(F.spark_partition_id()).agg(
        F.min(F.struct("no_id", "id", "hash")).alias("least")
    )
    # One key per partition.
    bounds = sorted(tuple(r.least) for r in ranged.collect())
    if not bounds:
        return docs.sparkSession.createDataFrame([], _ddl())

    @F.pandas_udf("stretch int, first boolean")
    def stretch_of(no_id: pd.Series, ids: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        found = [(bool(a), int(b), int(c)) for a, b, c in zip(no_id, ids, hashes)]
        at = [bisect.bisect_right(bounds, key) - 1 for key in found]
        return pd.DataFrame({"stretch": pd.Series(at, dtype="int32"), "first": [bounds[i] == key for i, key in zip(at, found)]})

    here = F.struct(F.col("s.stretch").alias("to"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("s.stretch") - 1, F.lit(len(bounds))).alias("to"), F.lit(True).alias("guest"))
    sent = (
        docs.select("doc_id", "text", *place).withColumn("s", stretch_of("no_id", "id", "hash"))
        .withColumn("e", F.explode(F.when(F.col("s.first"), F.array(here, before)).otherwise(F.array(here))))
        .select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"), "e.guest", "e.to", "no_id", "id", "hash")
    )
    placed = sent.repartitionById(len(bounds), F.col("to")).sortWithinPartitions("guest", "no_id", "id", "hash")
    return placed.select("doc_id", "text", "guest").mapInArrow(_compare, _ddl())


def _ddl() -> str:
    return "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
