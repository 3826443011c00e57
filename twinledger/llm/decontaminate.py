"""Benchmark decontamination with suffix arrays over the training texts.

Each batch of documents is one shard: its words become numbers, and a suffix array orders the
shard's suffixes by their first ``WINDOW`` words. Every suffix of every benchmark text is searched in
it by bisection. The interval found holds all places where the next ``WINDOW`` words of the benchmark
stand verbatim; matches that follow each other on one diagonal are one longer match, so the longest
matches and where they lie come out of the same search. Documents with enough hit words go.

The corpus is never shuffled. Only suffixes that begin with a word pair of the benchmark are put in
order, as no other can match. The benchmark is a query set: it is dealt into blocks of a bounded
size, each held in memory while all shards pass by.

A benchmark text of fewer than ``WINDOW`` words, but not none, is one window. NULL and empty
texts have no words. A benchmark row without an id marks words but names no item. Repeated rows
of either table change nothing but the number of rows returned.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import packed, unpacked, utf8

WINDOW = 13
# A document is contaminated if at least one word in this many is hit.
PARTS = 20
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 4 << 20

# Words in lower-cased UTF-8: ASCII digits and letters, and every byte of a longer character.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOUND = (
    "n_words long, n_hit long, hits binary, items array<string>, "
    "matches array<struct<item_id:string, item_word:int, doc_word:int, n_words:int>>"
)


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Probes:
    """A block of benchmark texts as numbered words and distinct windows."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window, self.names = window, [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, list[tuple[int, int]]] = {}
        for item, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), []).append((item, at))
        self.bits = 16 if len(self.vocabulary) < 1 << 16 else 21
        self.per_key = 64 // self.bits
        self.uses = list(found.values())
        self.lengths = np.array([len(k) for k in found], np.int64)
        width = -(-window // self.per_key) * self.per_key
        table = np.zeros((len(found), width), np.uint64)
        for row, key in zip(table, found):
            row[: len(key)] = key
        self.low = self._packed(table)
        table[np.arange(width) >= self.lengths[:, None]] = (1 << self.bits) - 1
        self.high = self._packed(table)
        size = len(self.vocabulary) + 1
        pairs = {k[0] * size + k[1] for k in found if len(k) > 1}
        self.pairs, self.size = np.array(sorted(pairs), np.int64), size
        self.single = np.zeros(size, bool)
        self.single[[k[0] for k in found if len(k) == 1]] = True

    def _packed(self, table: np.ndarray) -> list[np.ndarray]:
        """Rows of numbers as a few 64-bit keys, most significant first."""
        keys = []
        for at in range(0, table.shape[1], self.per_key):
            key = np.zeros(len(table), np.uint64)
            for column in table.T[at : at + self.per_key]:
                key = (key << np.uint64(self.bits)) | column
            keys.append(key)
        return keys

    def suffixes(self, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The suffix array of a shard, and its suffixes' keys in that order."""
        following = np.append(ids[1:], 0)
        first = np.flatnonzero(ids)
        code = ids[first] * self.size + following[first]
        at = np.searchsorted(self.pairs, code)
        known = np.zeros(len(first), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == code
        starts = first[known | self.single[ids[first]]]
        padded = np.append(ids, np.zeros(self.window + self.per_key, np.int64)).astype(np.uint64)
        columns = len(self.low) * self.per_key
        keys = []
        for k in range(0, columns, self.per_key):
            key = np.zeros(len(starts), np.uint64)
            for j in range(k, k + self.per_key):
                key = key << np.uint64(self.bits)
                if j < self.window:
                    key |= padded[starts + j]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        return starts[order], [key[order] for key in keys]

    def bisect(self, keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
        """Where each wanted key would stand in a suffix array, all searched at once."""
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(wanted[0]), len(keys[0]), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.minimum(middle, len(keys[0]) - 1)
            less, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
            for have, want in zip(keys, wanted):
                less |= equal & (have[at] < want)
                equal &= have[at] == want
            go_on = (less | equal if right else less) & open_
            low = np.where(go_on, middle + 1, low)
            high = np.where(open_ & ~go_on, middle, high)
        return low


def _runs(places: np.ndarray, spots: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """Matches at ``places`` of a text, of an item's windows at ``spots``, joined along diagonals."""
    order = np.lexsort((spots, places - spots))
    places, spots, lengths = places[order], spots[order], lengths[order]
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (np.diff(spots) != 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(places)) - 1
    size = spots[tails] + lengths[tails] - spots[heads]
    return list(zip(spots[heads].tolist(), places[heads].tolist(), size.tolist()))


def search(probes: Probes, texts: list[bytes], earlier: list[bytes | None]) -> list[tuple]:
    """One shard: for each text its words, hit words, hit bits, items and longest matches."""
    lists = [words_of(t) for t in texts]
    get = probes.vocabulary.get
    sizes = np.array([len(w) for w in lists], np.int64)
    # One empty place behind each text, which no suffix can cross.
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    ids = np.zeros(int(starts[-1]), np.int64)
    for words, at in zip(lists, starts.tolist()):
        ids[at : at + len(words)] = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
    places, keys = probes.suffixes(ids)
    lo = probes.bisect(keys, probes.low, False)
    count = probes.bisect(keys, probes.high, True) - lo
    window = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    place = places[lo[window] + offset] if len(window) else np.zeros(0, np.int64)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + probes.lengths[window], -1)
    hit = np.cumsum(change)[:-1] > 0
    text_of = np.searchsorted(starts, place, side="right") - 1
    order = np.argsort(text_of, kind="stable")
    window, place, text_of = window[order], place[order], text_of[order]
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        a, n = int(starts[i]), int(sizes[i])
        mask = hit[a : a + n]
        if earlier[i]:
            mask = mask | np.unpackbits(np.frombuffer(earlier[i], np.uint8), count=n).astype(bool)
        names: list[str] = []
        matches: list[dict] = []
        if bounds[i] < bounds[i + 1]:
            here, at = window[bounds[i] : bounds[i + 1]], place[bounds[i] : bounds[i + 1]] - a
            by_item: dict[int, list[tuple[int, int, int]]] = {}
            for w, p in zip(here.tolist(), at.tolist()):
                for item, spot in probes.uses[w]:
                    by_item.setdefault(item, []).append((p, spot, int(probes.lengths[w])))
            for item, found in by_item.items():
                if probes.names[item] is None:
                    continue
                names.append(probes.names[item])
                spot, p, size = max(_runs(*np.array(found).T), key=lambda r: (r[2], -r[1]))
                matches.append({"item_id": probes.names[item], "item_word": spot, "doc_word": p, "n_words": size})
        bits = np.packbits(mask).tobytes() if mask.any() else None
        out.append((n, int(mask.sum()), bits, sorted(set(names)), matches))
    return out


def _searched(text: Column, earlier: Column, items: list[tuple[str | None, bytes]], window: int) -> Column:
    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series, hits: pd.Series) -> pd.DataFrame:
        probes = Probes(items, window)
        rows: list[tuple] = []
        shard: list[bytes] = []
        before: list[bytes | None] = []
        size = 0
        for text, hit in zip(texts, hits):
            shard.append(text)
            before.append(hit)
            size += len(text)
            if size >= SHARD_BYTES:
                rows += search(probes, shard, before)
                shard, before, size = [], [], 0
        if shard:
            rows += search(probes, shard, before)
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "hits", "items", "matches"])

    return find(utf8(text), earlier)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str | None, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``, which the driver reads one after the other."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    # Each block is bounded by block_bytes, up to the unevenness of a hash and one whole text.
    return [
        sorted(((r[0], bytes(r[1])) for r in dealt.filter(F.col("_block") == b).select("item_id", "text").collect()), key=str)
        for b in range(blocks)
    ]


def with_hits(rows: DataFrame, text: Column, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``_found``: words, hit words, items by id and each item's longest match and place."""
    nothing = F.lit(None).cast("binary")
    found = None
    for items in benchmark_blocks(benchmark):
        earlier = found["hits"] if found is not None else nothing
        rows = rows.withColumn("_next", _searched(text, earlier, items, window))
        if found is not None:
            rows = rows.withColumn(
                "_next",
                F.col("_next")
                .withField("items", F.sort_array(F.array_union(F.col("_found.items"), F.col("_next.items"))))
                .withField("matches", F.concat(F.col("_found.matches"), F.col("_next.matches"))),
            )
        rows = rows.drop("_found").withColumnRenamed("_next", "_found")
        found = F.col("_found")
    return rows


def is_contaminated(found: Column, parts: int = PARTS) -> Column:
    return (found["n_hit"] > 0) & (found["n_hit"] * parts >= found["n_words"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document's longest verbatim match with each benchmark item, and where it lies, in words."""
    rows = with_hits(docs.select("doc_id", "text"), F.col("text"), benchmark)
    return rows.select("doc_id", F.explode("_found.matches").alias("m")).select("doc_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = with_hits(packed(docs), F.col("_row.text"), benchmark)
    return unpacked(rows.filter(~is_contaminated(F.col("_found"))))
