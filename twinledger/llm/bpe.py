"""Byte-level BPE encoding and decoding with the tiktoken library.

A rank file is read once on the driver and broadcast (``RANKS_MAX_BYTES`` at most); each Python worker builds one coder
from it. Texts are encoded as the library's own ``encode_ordinary`` would: every match of the pattern on its own, no
special tokens. Decoding joins the bytes of the ids and yields bytes, since an id may end inside a character.

Long texts are cut before they reach the library, and only where no match of the pattern can span the cut: behind a
letter, a number or any other visible character, before one of another kind. So a text of any length is encoded
in stretches of about ``STRETCH`` characters with the ids of the whole. A run of ``LONG_BLANK`` or more blanks, on which the
library's regular expression runs out of stack, is one match by rule (without its last blank if text follows) and
goes to the merge step directly. A single match longer than a stretch is encoded as one, as it must be.

* NULL and empty texts have no ids; a NULL list of ids decodes to no bytes.
* Bytes that are not UTF-8 become the ids of the single bytes, so that decoding gives back every text byte by byte.
* Repeated rows and ties are rows of their own; empty tables give empty tables.
* ``encode`` and ``decode`` keep all columns of their input; the column they add replaces one of that name.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm.common import utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The vocabulary's own way to cut texts, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS_MAX_BYTES = 64 << 20
STRETCH = 1 << 18
LONG_BLANK = 4096

# No match of the pattern has a letter before a non-letter, a number before another kind, or visible before blank.
_SAFE = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=\P{White_Space})(?=\p{White_Space})")
_BLANKS = regex.compile(r"\p{White_Space}{%d,}" % LONG_BLANK)


def read_ranks(path: str) -> dict[bytes, int]:
    """A local rank file: one token in base 64 and its rank per line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


class Coder:
    """The library's coder, guarded against long texts, long blank runs and bytes that are not UTF-8."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, stretch: int = STRETCH):
        import tiktoken

        self._bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._stretch = stretch

    def encode(self, text: bytes) -> list[int]:
        ids: list[int] = []
        while text:
            try:
                known, bad, text = text.decode("utf-8"), b"", b""
            except UnicodeDecodeError as e:
                known, bad, text = text[: e.start].decode("utf-8"), text[e.start : e.end], text[e.end :]
            for piece in stretches(known, self._stretch):
                ids += self._encode_stretch(piece)
            for i in range(len(bad)):
                ids.append(self._bpe.encode_single_token(bad[i : i + 1]))
        return ids

    def _encode_stretch(self, text: str) -> list[int]:
        if len(text) < LONG_BLANK:
            return self._bpe.encode_ordinary(text)
        ids, at = [], 0
        for run in _BLANKS.finditer(text):
            # A run at the end is one match; before text its last blank belongs to what follows.
            end = run.end() - (run.end() < len(text))
            ids += self._bpe.encode_ordinary(text[at : run.start()])
            ids += self._bpe._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self._bpe.encode_ordinary(text[at:])

    def decode(self, ids: list[int]) -> bytes:
        return self._bpe.decode_bytes(ids)


_coders: dict[int, Coder] = {}


def _coder(ranks) -> Coder:  # noqa: ANN001 - a broadcast variable
    data = ranks.value
    key = zlib.crc32(data)
    if key not in _coders:
        pairs = (line.split() for line in data.splitlines() if line)
        _coders[key] = Coder({base64.b64decode(token): int(rank) for token, rank in pairs})
    return _coders[key]


class Codec:
    """Column functions for one rank file."""

    def __init__(self, spark: SparkSession, vocabulary: str = VOCABULARY):
        data = Path(vocabulary).read_bytes()
        if len(data) > RANKS_MAX_BYTES:
            raise ValueError(f"{vocabulary} has {len(data)} bytes, more than RANKS_MAX_BYTES")
        self._ranks = spark.sparkContext.broadcast(data)

    def encode(self, text: Column) -> Column:
        """The ids of a text, ``array<int>``."""
        ranks = self._ranks

        @F.arrow_udf("array<int>")
        def encoded(texts: pa.Array) -> pa.Array:
            coder = _coder(ranks)
            return pa.array((coder.encode(t.as_py()) for t in texts), pa.list_(pa.int32()))

        return encoded(utf8(text))

    def decode(self, ids: Column) -> Column:
        """The bytes of a list of ids, ``binary``."""
        ranks = self._ranks

        @F.arrow_udf("binary")
        def decoded(lists: pa.Array) -> pa.Array:
            coder = _coder(ranks)
            return pa.array((coder.decode(ids.as_py() or []) for ids in lists), pa.binary())

        return decoded(ids)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``ids``, the token ids of ``text``."""
    codec = Codec(docs.sparkSession, vocabulary)
    return docs.withColumn("ids", codec.encode(F.col("text")))


def decode(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``bytes``, what ``ids`` stand for."""
    codec = Codec(rows.sparkSession, vocabulary)
    return rows.withColumn("bytes", codec.decode(F.col("ids")))
