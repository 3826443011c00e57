"""Token ids in training order, as binary shards of fixed stride.

Texts become token ids, end of text included, and are cut into sequences of ``SEQUENCE`` ids. A keyed
Feistel permutation of 0 .. n-1 gives every sequence its global slot: the network permutes the next power
of four, and a number that falls outside walks on along its cycle until it is inside. Sequences are
range-partitioned by slot and packed: shard s holds slots ``s * PER_SHARD`` onwards, each as exactly
``stride`` bytes of little-endian ids, padded at its end. A reader finds any slot by arithmetic, reads on in
training order, and goes on after a stop from the slot it had reached.

Shards are rows of a Parquet table, so that Spark's committer makes them appear as a whole or not at all,
on any store. The tokens are shuffled once; numbering counts rows per written file instead.

NULL texts and empty texts are one sequence of the end mark alone. Repeated rows are sequences of
their own. The vocabulary file is a parameter; ids must fit two bytes, the end mark included.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinledger.llm.common import utf8
from twinledger.plans.joins import join_dimension
from twinledger.session import scratch_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own way to cut texts, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
SEQUENCE = 512
PER_SHARD = 2048
KEY = 0x5EED
ROUNDS = 4
_CACHE = 200_000
_UNSAFE = re.compile(r" (?:\s|$)")


def _bytes(ids: list[int]) -> bytes:
    own = array("H", ids)
    if sys.byteorder == "big":
        own.byteswap()
    return own.tobytes()


class Tokenizer:
    """Byte-level BPE; ids as little-endian 16-bit numbers."""

    def __init__(self, ranks: bytes):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        self._coder = tiktoken.Encoding(
            "corpus", pat_str=PATTERN, mergeable_ranks={base64.b64decode(t): int(i) for t, i in pairs}, special_tokens={}
        )
        self._known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = _bytes(self._coder.encode_ordinary(piece))
        if len(self._known) < _CACHE:
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The pattern never cuts inside `` word``, so such pieces are looked up on their own; a text
        where a space precedes other white space or ends it is encoded whole."""
        if _UNSAFE.search(text):
            return _bytes(self._coder.encode_ordinary(text))
        pieces = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
        get = self._known.get
        return b"".join([get(p) or self._piece(p) for p in pieces])


_tokenizers: dict[int, Tokenizer] = {}


def _tokenize(ranks) -> callable:  # noqa: ANN001 - a broadcast variable
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = ranks.value
        known = _tokenizers.setdefault(zlib.crc32(data), None) or Tokenizer(data)
        _tokenizers[zlib.crc32(data)] = known
        width = 2 * SEQUENCE
        end = np.array([END_OF_TEXT], "<u2").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = known.encode(text.as_py().decode("utf-8", "replace")) + end
                for part, at in enumerate(range(0, len(ids), width)):
                    piece = ids[at : at + width]
                    rows.append((doc_id, part, len(piece) // 2, zlib.crc32(piece), piece))
                    size += len(piece)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    names = ["doc_id", "part", "n_tokens", "tokens_crc32", "tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``part``, ``n_tokens``, ``tokens_crc32`` and ``tokens`` of every sequence."""
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())  # a file of about a megabyte
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return texts.mapInArrow(
        _tokenize(ranks), "doc_id long, part int, n_tokens int, tokens_crc32 long, tokens binary"
    )


def numbered(path: str, spark: SparkSession) -> DataFrame:
    """A written table with ``number``, 0 .. n-1, by file name and row: rows in earlier files come first."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = rows.groupBy("file").agg(F.count("*").alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return join_dimension(rows, starts, "file", "inner").withColumn("number", F.col("start") + F.col("row")).drop("file", "row", "start")


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


def permuted(numbers: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """Where the keyed permutation of 0 .. size-1 puts each number."""
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for r in range(rounds):
            left, right = right, left ^ (_scramble(right, key * 0x10001 + r) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def slot_column(number: Column, size: int, key: int = KEY) -> Column:
    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(np.int64), size, key))

    return slot(number)


def _pack(per_shard: int) -> callable:
    stride = 2 * SEQUENCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, parts = None, 0, []

        def row() -> pa.RecordBatch:
            payload = b"".join(parts)
            columns = [[shard], [first], [len(parts)], [stride], [zlib.crc32(payload)], [payload]]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            names = ["shard", "first_slot", "n_sequences", "stride", "payload_crc32", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        pad = np.full(SEQUENCE, END_OF_TEXT, "<u2").tobytes()
        for batch in batches:
            for slot, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if slot // per_shard != shard:
                    if parts:
                        yield row()
                    shard, first, parts = slot // per_shard, slot, []
                parts.append(tokens + pad[: stride - len(tokens)])
        if parts:
            yield row()

    return run


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, key: int = KEY, per_shard: int = PER_SHARD) -> DataFrame:
    """Write ``path/shards`` and return the index: a row per sequence with its slot, shard and offset."""
    spark = docs.sparkSession
    table = scratch_dir(spark, "sequences")
    sequences(docs, vocabulary).write.option("compression", "zstd").parquet(table)
    rows = numbered(table, spark)
    size = spark.read.parquet(table).count()
    rows = rows.withColumn("slot", slot_column(F.col("number"), size, key))
    shards = max(1, -(-size // per_shard))
    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    to = F.floor(F.floor(F.col("slot") / per_shard) * tasks / shards).cast("int")
    placed = rows.select("slot", "tokens", to.alias("to")).repartitionById(tasks, F.col("to")).sortWithinPartitions("slot")
    packed = placed.select("slot", "tokens").mapInArrow(
        _pack(per_shard), "shard long, first_slot long, n_sequences int, stride int, payload_crc32 long, payload binary"
    )
    packed.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/shards")
    return rows.select(
        "doc_id",
        "part",
        "n_tokens",
        "tokens_crc32",
        "number",
        "slot",
        F.floor(F.col("slot") / per_shard).alias("shard"),
        (F.col("slot") % per_shard * (2 * SEQUENCE)).alias("offset"),
    )


def read_from(spark: SparkSession, path: str, slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """All sequences from ``slot`` on: ``slot`` and padded ``tokens``. Sort by slot, or read shard by shard."""
    shards = spark.read.parquet(f"{path}/shards").filter(F.col("shard") >= slot // per_shard)
    places = shards.select("first_slot", "stride", "payload", F.explode(F.sequence(F.lit(0), F.col("n_sequences") - 1)).alias("i"))
    tokens = F.substring(F.col("payload"), F.col("i") * F.col("stride") + 1, F.col("stride"))
    return places.select((F.col("first_slot") + F.col("i")).alias("slot"), tokens.alias("tokens")).filter(F.col("slot") >= slot)
