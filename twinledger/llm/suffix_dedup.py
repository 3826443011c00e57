"""Removal of repeated passages by common prefixes of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.
Common prefixes are derived as on a Burrows-Wheeler transform: starting from the interval of all
suffixes, every interval of suffixes that share a prefix is extended backward by each byte, breadth
first, so prefixes common to neighbouring suffixes come out by increasing length, and the extension
stops at ``LENGTH``. Intervals that are left then are the repeated strings.

One array over all texts would be one task, so the strings are dealt out first. Every string of
``LENGTH`` bytes contains an anchor, the smallest by hash of its pieces of ``PIECE`` bytes (the leftmost if equal).
Equal strings have equal anchors at equal places, so they are compared only within their anchor's group.

1. Each document sends its anchors' hashes. Anchors of one document only cannot matter and are dropped.
2. The text around each remaining anchor, with the strings that it is the anchor of, is a segment. Where the
   same segment stands in a document with a smaller id, all its strings repeat. That is settled by hashes,
   so the inside of long repeats is never sent as text.
3. The first document with a segment may still share some of its strings with other segments of the
   anchor. Their texts are searched by backward extension, which gives the strings that a smaller id has too.
4. The bytes so covered are cut.

Hot anchors and segments: a task reports what it sees in two documents itself and sends one row per hash
or segment. An anchor that stands in very many different segments (``MOST_SEGMENTS``) leaves the
search: its strings are grouped one by one, pre-aggregated, with the same result. Texts are shuffled once; the
three joins to them share that exchange.

A NULL id is larger than all others and no smaller than itself. NULL texts are empty. Documents that share
an id do not remove each other's bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import utf8

LENGTH = 50
PIECE = 20
MOST_SEGMENTS = 20_000
BUCKET_BYTES = 64 << 20
SEARCH_BYTES = 1 << 20
NO_ID = (1 << 63) - 1
MOST_COUNTED = 30_000
_BLOCK_BITS = 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M1
    x ^= b
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all pieces of ``PIECE`` bytes, each from those of pieces half as long."""
    h = {1: (data.astype(np.uint64) + np.uint64(1)) * _M2}
    size = 1
    while 2 * size <= PIECE:
        h[2 * size] = _mix(h[size][:-size], h[size][size:])
        size *= 2
    out, have = h[size], size
    for part in sorted(h, reverse=True):
        if have + part <= PIECE:
            n = len(data) - have - part + 1
            out = _mix(out[:n], h[part][have : have + n])
            have += part
    return out


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of strings that share an anchor: first and last string, anchor, hash of the anchor."""
    last = len(text) - LENGTH
    parts = []
    for at in range(0, last + 1, 1 << _BLOCK_BITS):
        data = np.frombuffer(text, np.uint8)[at : min(len(text), at + (1 << _BLOCK_BITS) + LENGTH - 1)]
        h = _piece_hashes(data)
        low = np.uint64((1 << (_BLOCK_BITS + 1)) - 1)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width, have = LENGTH - PIECE + 1, 1
        while 2 * have <= width:
            best = np.minimum(best[:-have], best[have:])
            have *= 2
        n = len(data) - LENGTH + 1
        best = np.minimum(best[:n], best[width - have : width - have + n])
        place = (best & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        parts.append((first + at, np.append(first[1:], n) - 1 + at, place[first] + at, h[place[first]]))
    if not parts:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and lower half of a hash as one number."""
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return ((bucket << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))).astype(np.int64)


# 1. Anchors that more than one document has


_ANCHOR_ROWS = "bucket int, sure boolean, keys array<int>, counts array<smallint>, uids array<long>"


def _list(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Documents of a batch are numbered in 16 bits.
        for batch in (b.slice(i, 1 << 15) for b in batches for i in range(0, b.num_rows, 1 << 15)):
            uids, keys, owner = batch.column(0).to_numpy(zero_copy_only=False), [], []
            for i, text in enumerate(batch.column(1)):
                own = np.unique(_keys(anchors(text.as_py())[3], buckets))
                keys.append(own)
                owner.append(np.full(len(own), i, np.int32))
            if not keys or not sum(map(len, keys)):
                continue
            key, doc = np.concatenate(keys), np.concatenate(owner)
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            first = np.append(True, key[1:] != key[:-1])
            again = ~first | np.append(~first[1:], False)
            # One row per hash goes to its bucket; what two documents of this task have is known to repeat.
            for sure, pick in ((False, first), (True, again)):
                k, d = key[pick], doc[pick]
                to = (d.astype(np.int64) if sure else k >> 32) % buckets
                # Document by document, so that a row says how many keys each has, not whose each key is.
                order = np.lexsort((d, to))
                k, d, to = k[order], d[order], to[order]
                if not len(k):
                    continue
                cuts = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to))
                # A count is of 16 bits; a document with more keys than that is listed again.
                heads = np.append(True, (d[1:] != d[:-1]) | (to[1:] != to[:-1]))
                since = np.arange(len(d)) - np.maximum.accumulate(np.where(heads, np.arange(len(d)), 0))
                heads = np.flatnonzero(since % MOST_COUNTED == 0)
                counts = np.diff(np.append(heads, len(d))).astype(np.int16)
                homes = np.searchsorted(heads, cuts)
                low = (k & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                # A sure row is told its bucket besides, as it does not lie there.
                if sure:
                    pairs = np.empty(2 * len(k), np.int32)
                    pairs[0::2], pairs[1::2] = low, (k >> 32).astype(np.int32)
                    listed = _list(pairs, 2 * cuts, pa.int32())
                else:
                    listed = _list(low, cuts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to[cuts[:-1]], pa.int32()), pa.array([sure] * (len(cuts) - 1)), listed,
                        _list(counts, homes, pa.int16()), _list(uids[d[heads]], homes, pa.int64()),
                    ],
                    names=["bucket", "sure", "keys", "counts", "uids"],
                )

    return run


def _find_repeated(rows: pa.Table) -> pa.Table:
    """A bucket's hashes that more than one document has, as rows of document and key."""
    bucket = rows.column("bucket")[0].as_py() if rows.num_rows else 0
    key, uid, known_key, known_uid = [], [], [], []
    for batch in rows.to_batches():
        for sure, keys, counts, uids in zip(*(batch.column(n) for n in ("sure", "keys", "counts", "uids"))):
            low = keys.values.to_numpy(zero_copy_only=False)
            owner = np.repeat(uids.values.to_numpy(zero_copy_only=False), counts.values.to_numpy(zero_copy_only=False))
            if sure.as_py():
                known_key.append((low[1::2].astype(np.int64) << 32) | low[0::2].view(np.uint32))
                known_uid.append(owner)
            else:
                key.append(low.view(np.uint32))
                uid.append(owner)
    if key:
        k, u = np.concatenate(key), np.concatenate(uid)
        order = np.argsort(k, kind="stable")
        k, u = k[order], u[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        several = np.minimum.reduceat(u, first) != np.maximum.reduceat(u, first)
        pick = np.repeat(several, np.diff(np.append(first, len(k))))
        known_key.append((np.int64(bucket) << np.int64(32)) | k[pick].astype(np.int64))
        known_uid.append(u[pick])
    return pa.table(
        {
            "uid": pa.array(np.concatenate(known_uid) if known_uid else [], pa.int64()),
            "key": pa.array(np.concatenate(known_key) if known_key else [], pa.int64()),
        }
    )


# 2. Segments


def _segments(text: bytes, wanted: list[int], buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, place of the anchor in it, first string, segment) for each wanted anchor of a text."""
    first, last, place, h = anchors(text)
    keys = _keys(h, buckets)
    pick = np.flatnonzero(np.isin(keys, np.array(wanted, np.int64)))
    for key, at, a, b in zip(keys[pick].tolist(), place[pick].tolist(), first[pick].tolist(), last[pick].tolist()):
        yield key, at - a, a, text[a : b + LENGTH]


# ``span`` is a segment's first string and how many it has, as ``_span``. Where it is negative the place is sure: it is
# -1 less the first byte of a run of segments that repeat, and ``name`` the end of that run.
_PLACE_ROWS = "key long, name long, uid long, place long, span long"
_MOST_STRINGS = LENGTH - PIECE + 1


def _span(at: int, strings: int) -> int:
    return at * _MOST_STRINGS + strings - 1


def _each_place(buckets: int):
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, least = [], {}
            for uid, place, text, wanted in zip(*(batch.column(n) for n in ("uid", "place", "text", "wanted"))):
                home, own = uid.as_py(), place.as_py()
                for key, offset, at, segment in _segments(text.as_py(), wanted.values.to_numpy(zero_copy_only=False), buckets):
                    name = xxhash.xxh3_64_intdigest(segment, offset) - (1 << 63)
                    rows.append((key, name, home, own, at, len(segment) - LENGTH + 1))
                    least[key, name] = min(own, least.get((key, name), own))
            # What stands in an earlier document of this very task needs no more comparing. It goes to any task
            # at all, not to its anchor's, and what overlaps or touches in a document as one.
            sent, run = [], None
            for key, name, home, own, at, strings in rows:
                if own <= least[key, name]:
                    sent.append((key, name, home, own, _span(at, strings)))
                    continue
                end = at + strings + LENGTH - 1
                if run and run[0] == home and run[1] == own and run[2] <= at <= run[3]:
                    run[3] = max(run[3], end)
                    continue
                if run:
                    sent.append((run[0], run[3], run[0], run[1], -1 - run[2]))
                run = [home, own, at, end]
            if run:
                sent.append((run[0], run[3], run[0], run[1], -1 - run[2]))
            if sent:
                labels = ["key", "name", "uid", "place", "span"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sent)], names=labels)

    return run_batches


# 3. Backward extension


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the next ``depth`` bytes at least, by doubling of prefixes."""
    padded = np.append(data, np.zeros(8, np.uint8))
    key = np.zeros(len(data), np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + len(data)]
    size = 8
    while True:
        order = np.argsort(key, kind="stable")
        if size >= depth:
            return order
        ordered = key[order]
        rank = np.empty(len(data), np.uint64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])).astype(np.uint64) + np.uint64(1)
        onward = np.append(rank[size:], np.zeros(min(size, len(data)), np.uint64))[: len(data)]
        key = rank * np.uint64(len(data) + 2) + onward
        size *= 2


def common_prefix_intervals(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """The interval, by number, of each row of a suffix array: rows that share ``length`` bytes.

    Level by level, the interval of c + w is the part of the rows that begin with c whose rest lies in the
    interval of w. A border that shows up first at level n stands between suffixes with a common
    prefix of n - 1; levels end at ``length``.
    """
    row_of = np.empty(len(order), np.int64)
    row_of[order] = np.arange(len(order))
    rest = row_of[np.minimum(order + 1, len(order) - 1)]
    head = data[order]
    other = np.append(True, head[1:] != head[:-1])
    interval = np.zeros(len(order), np.int32)
    for _ in range(length):
        before = interval[rest]
        interval = np.cumsum(other | np.append(True, before[1:] != before[:-1]), dtype=np.int32)
    return interval


def repeated_strings(segments: list[bytes], least: np.ndarray) -> list[np.ndarray | None]:
    """For each segment, which of its strings also stand in a segment of a smaller id; None if none does."""
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.append(0, np.cumsum(sizes + 1))[:-1]
    data = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    order = suffix_array(data, LENGTH)
    interval = common_prefix_intervals(data, order, LENGTH)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    # Only suffixes with LENGTH bytes of their own segment ahead are strings.
    whole = np.arange(len(data)) - starts[owner] + LENGTH <= sizes[owner]
    ids = np.where(whole, least[owner], NO_ID)[order]
    heads = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
    smallest = np.empty(len(data), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.append(heads, len(ids))))
    earlier = whole & (smallest < least[owner])
    any_ = np.logical_or.reduceat(earlier, starts)
    return [earlier[a : a + n - LENGTH + 1] if some else None for a, n, some in zip(starts.tolist(), sizes.tolist(), any_.tolist())]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist()))


_RANGES = "uid long, place long, a int, b int"


def _search(rows: pa.Table) -> pa.Table:
    """Search a bucket of segments, some anchors at a time; the byte ranges of what repeats."""
    rows = rows.sort_by("key")
    key, least = rows.column("key").to_numpy(), rows.column("place").to_numpy()
    segments = rows.column("segment").to_pylist()
    uid, at = rows.column("uid").to_numpy(), rows.column("at").to_numpy()
    found: list[tuple[int, int, int, int]] = []
    cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)) if len(key) else [0]
    batch: list[int] = []
    size = 0

    def flush() -> None:
        for i, flags in zip(batch, repeated_strings([segments[i] for i in batch], least[batch])):
            if flags is not None:
                start = int(at[i])
                found.extend((int(uid[i]), int(least[i]), start + a, start + b + LENGTH - 1) for a, b in _runs(flags))

    for a, b in zip(cuts, cuts[1:]):
        batch += range(a, b)
        size += sum(len(segments[i]) for i in range(a, b))
        if size >= SEARCH_BYTES:
            flush()
            batch, size = [], 0
    if batch:
        flush()
    kinds = [("uid", pa.int64()), ("place", pa.int64()), ("a", pa.int32()), ("b", pa.int32())]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*found) if found else [[]] * 4, kinds)], names=[n for n, _ in kinds])


# 4. Cutting


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal runs removed, and the SHA-256 of what is left."""
    removed, spans, at, left = 0, 0, 0, hashlib.sha256()
    for start, end in sorted(ranges):
        if start > at or not spans:
            left.update(text[at:start])
            spans += 1
        if end > at:
            removed += end - max(at, start)
            at = end
    left.update(text[at:])
    return removed, spans, left.hexdigest()


def remove_repeats(docs: DataFrame, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row, and the cut ``ranges``."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(partitions, size // BUCKET_BYTES)
    texts = docs.select(
        F.coalesce(F.xxhash64("doc_id", "text"), F.lit(0)).alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8("text").alias("text"),
    )
    tasks = max(partitions, size // BUCKET_BYTES)
    sent = texts.filter(F.octet_length("text") >= LENGTH).select("uid", "text").mapInArrow(_send_anchors(buckets), _ANCHOR_ROWS)
    shared = sent.groupBy("bucket").applyInArrow(_find_repeated, "uid long, key long")
    wanted = shared.groupBy("uid").agg(F.collect_set("key").alias("wanted"))

    # Used four times, as one and the same exchange: every use reads all three of its columns.
    dealt = texts.repartition(tasks, "uid").withColumn("place", F.coalesce("doc_id", F.lit(NO_ID)))
    around = dealt.join(wanted, "uid").select("uid", "place", "text", "wanted")
    places = around.mapInArrow(_each_place(buckets), _PLACE_ROWS).repartition(4 * tasks, "key")
    segment, anchor = Window.partitionBy("key", "name"), Window.partitionBy("key")
    marked = places.withColumn("least", F.min("place").over(segment)).withColumn(
        "several", F.min("name").over(anchor) != F.max("name").over(anchor)
    )
    sure = F.col("span") < 0
    a = F.when(sure, -1 - F.col("span")).otherwise(_at()).cast("int")
    b = F.when(sure, F.col("name")).otherwise(_at() + _strings() + (LENGTH - 1)).cast("int")
    later = marked.filter(sure | (F.col("place") > F.col("least"))).select("uid", "place", a.alias("a"), b.alias("b"))
    firsts = (
        marked.filter(~sure & (F.col("place") == F.col("least")) & F.col("several"))
        .withColumn("n", F.count("*").over(anchor))
        .select("key", "uid", F.col("place").alias("first"), "span", (F.col("n") > most_segments).alias("busy"))
    )
    bucket = F.pmod(F.xxhash64("key"), F.lit(4 * tasks)).alias("bucket")
    light = _with_text(firsts.filter(~F.col("busy")), dealt).select(bucket, "key", "uid", "place", "at", "segment")
    searched = light.groupBy("bucket").applyInArrow(_search, _RANGES)
    heavy = _one_by_one(_with_text(firsts.filter("busy"), dealt))
    ranges = (
        later.unionByName(searched).unionByName(heavy)
        .groupBy("uid", F.col("place").alias("owner"))
        .agg(F.collect_list(F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("packed"))
    )

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cutting(texts: pd.Series, packed: pd.Series) -> pd.DataFrame:
        rows = [
            cut(t, [] if r is None else [(x >> 32, x & 0xFFFFFFFF) for x in r.tolist()])
            for t, r in zip(texts, packed)
        ]
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])

    # Ranges name their document's place, should two documents ever share a hash.
    own = (F.col("d.uid") == F.col("r.uid")) & (F.col("place") <= F.col("owner")) & (F.col("place") >= F.col("owner"))
    spans = F.transform("packed", lambda x: F.struct(F.shiftright(x, 32).alias("a"), x.bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")))
    return (
        dealt.alias("d").join(ranges.alias("r"), own, "left")
        .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), cutting("text", "packed").alias("c"), spans.alias("ranges"))
        .select("doc_id", "n_bytes", "c.*", "ranges")
    )


def _at() -> Column:
    """A segment's first string, out of its ``span``."""
    return F.expr(f"span div {_MOST_STRINGS}")


def _strings() -> Column:
    return F.col("span") % _MOST_STRINGS + 1


def _with_text(firsts: DataFrame, dealt: DataFrame) -> DataFrame:
    """Add ``segment``. The places are compared by order, as an equality would deal the texts anew."""
    joined = dealt.join(firsts, "uid").filter((F.col("place") <= F.col("first")) & (F.col("place") >= F.col("first")))
    at, strings = _at().cast("int"), _strings().cast("int")
    text = F.substring(F.col("text"), at + 1, strings + (LENGTH - 1))
    return joined.select("key", "uid", "place", at.alias("at"), strings.alias("strings"), text.alias("segment"))


def _one_by_one(heavy: DataFrame) -> DataFrame:
    """The strings of anchors with very many segments, each grouped by itself."""
    strings = heavy.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("strings") - 1))).select(
        "uid", "place", F.substring(F.col("segment"), F.col("i") + 1, F.lit(LENGTH)).alias("string"), (F.col("at") + F.col("i")).alias("a")
    )
    smallest = strings.groupBy("string").agg(F.min("place").alias("smallest"))
    again = strings.join(smallest, "string").filter(F.col("smallest") < F.col("place"))
    return again.select("uid", "place", "a", (F.col("a") + LENGTH).alias("b"))
