"""How far the sources of a language differ, from one pass over the texts.

* **Blocks.** Each task reads its texts once and keeps postings (language, source, term of a document: occurrences) in memory.
  At ``BLOCK_POSTINGS`` of them the block is spilled as a run: its postings summed, in term order, one row per hash shard.
* **Merge.** A heap merges the runs of each shard in term order; postings of one term are added up, and terms that too few
  documents hold go. Shards follow the size of the texts, so that none grows with the corpus.
* **Corrections.** With ``p = 1 + floor(SCALE * (n + SMOOTH) / (N + SMOOTH * V))`` a term that a source lacks has the source's
  base value. Two sources a and b differ, over all V terms, by the difference of their bases V times, plus for either source
  the terms it holds measured against the other's base, which needs only counts of equal ``p``, plus a correction for each
  term that both hold. The corrections are streamed term by term into small tiles of pairs. No pair is made for a term that
  is missing on a side, and all numbers are whole.

NULL text, language and source are empty strings. An empty text has no terms, but its source still counts. Repeated rows
count as often as they are there. Very long texts are read in stretches of ``STRETCH`` bytes, cut between terms. Equal values
are ranked by the item's UTF-8 bytes. An empty table gives an empty result; columns beside ``lang``, ``source`` and
``text`` are not read, whatever their names. Bytes that are not UTF-8 belong to terms, shown by the replacement character.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import groupby, repeat
from operator import itemgetter, ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import utf8
from twinledger.plans.joins import join_dimension
from twinledger.session import materialize

MIN_DOCUMENTS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP_TERMS = 50
BLOCK_POSTINGS = 2_000_000
SHARD_BYTES = 16 << 20
STRETCH = 1 << 20
TILE = 256
MOST_TILES = 64

# Letters A-Z and every character beyond ASCII; bytes of a character beyond ASCII are 80 to FF.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
_GROUP_SHIFT = 40  # a block holds far fewer terms than 2^40

# A run of one shard: its keys in order (language and term), and of each the documents and the number of its postings.
_RUN = "shard long, keys array<binary>, documents array<bigint>, lengths array<bigint>, sources array<binary>, counts array<bigint>"
_FREQUENCIES = "lang string, term string, sources array<string>, counts array<bigint>, total long"


def terms_of(text: bytes, stretch: int = STRETCH) -> Iterator[list[bytes]]:
    """The terms of a text, stretch by stretch."""
    at = 0
    while at < len(text):
        end = at + stretch
        gap = _GAP.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield _TERM.findall(text[at:end].lower())
        at = end


class _Numbers(dict):
    """Values numbered as they come."""

    def __missing__(self, value) -> int:  # noqa: ANN001
        number = self[value] = len(self)
        return number


def _sums(order_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each new value of a sorted array begins, and how often it is there."""
    first = np.flatnonzero(np.diff(order_by, prepend=order_by[:1] - 1))
    return first, np.diff(first, append=len(order_by))


def _lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


class _Block:
    """Postings in memory: of each document its terms, as (group, term) numbers with their occurrences."""

    def __init__(self):
        self.terms, self.groups = _Numbers(), _Numbers()
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        parts = [np.fromiter(map(self.terms.__getitem__, found), np.int64, len(found)) for found in terms_of(text)]
        if not parts:
            return
        numbers = parts[0] if len(parts) == 1 else np.concatenate(parts)
        numbers.sort()
        first, n = _sums(numbers)
        self.codes.append(self.groups[lang, source] << _GROUP_SHIFT | numbers[first])
        self.counts.append(n)
        self.held += len(first)

    def spill(self, shards: int) -> pa.RecordBatch:
        """The block as a run, one row per shard."""
        code = np.concatenate(self.codes)
        order = np.argsort(code, kind="stable")
        first, documents = _sums(code[order])
        counts = np.add.reduceat(np.concatenate(self.counts)[order], first)
        group, term = code[order][first] >> _GROUP_SHIFT, code[order][first] & ((1 << _GROUP_SHIFT) - 1)

        # Hexadecimal languages are never prefixes of a key that sorts between theirs.
        langs = sorted({lang.hex().encode() for lang, _ in self.groups})
        lang = np.array([langs.index(g[0].hex().encode()) for g in self.groups])[group]
        terms = pa.array(list(self.terms), pa.binary())
        rank = np.empty(len(terms), np.int64)
        rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
        shard = np.fromiter((zlib.crc32(t) % shards for t in self.terms), np.int64, len(terms))[term]
        order = np.lexsort((group, rank[term], lang, shard))
        group, term, lang, shard, documents, counts = (x[order] for x in (group, term, lang, shard, documents, counts))

        entry = np.flatnonzero(np.diff(shard, prepend=-1) | np.diff(lang, prepend=-1) | np.diff(term, prepend=-1))
        keys = pc.binary_join_element_wise(pa.array(langs, pa.binary()).take(pa.array(lang[entry])), terms.take(pa.array(term[entry])), b" ")
        sources = pa.array([source for _, source in self.groups], pa.binary()).take(pa.array(group))
        run = np.flatnonzero(np.diff(shard[entry], prepend=-1))
        columns = [
            pa.array(shard[entry][run]),
            _lists(keys, run),
            _lists(pa.array(np.add.reduceat(documents, entry)), run),
            _lists(pa.array(np.diff(entry, append=len(term))), run),
            _lists(sources, entry[run]),
            _lists(pa.array(counts), entry[run]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "documents", "lengths", "sources", "counts"])


def _index(shards: int, block_postings: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for lang, source, text in zip(*batch.columns):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.held >= block_postings:
                    yield block.spill(shards)
                    block = _Block()
        if block.held:
            yield block.spill(shards)

    return run


def _frequencies(runs: list[tuple], min_documents: int) -> pa.RecordBatch | None:
    """The runs of a shard merged: the terms of enough documents, with their sources."""
    streams = [zip(keys.to_pylist(), repeat(i)) for i, (keys, *_) in enumerate(runs)]
    merged = list(heapq.merge(*streams))
    keys = [key for key, _ in merged]
    run = np.fromiter((i for _, i in merged), np.int64, len(merged))
    # A run's keys come in its own order, so that a stable sort by run gives each merged key its entry.
    entry = np.empty_like(run)
    entry[np.argsort(run, kind="stable")] = np.arange(len(run))
    documents, lengths, counts = (np.concatenate([r[i].to_numpy(zero_copy_only=False) for r in runs]) for i in (1, 2, 4))
    coded = pa.chunked_array([r[3] for r in runs]).dictionary_encode().unify_dictionaries()
    names = coded.chunk(0).dictionary
    codes = np.concatenate([c.indices.to_numpy() for c in coded.chunks]).astype(np.int64)

    new = np.flatnonzero(np.fromiter(map(ne, keys, [None, *keys[:-1]]), bool, len(keys)))
    kept = np.add.reduceat(documents[entry], new) >= min_documents
    if not kept.any():
        return None
    size = np.diff(new, append=len(keys))
    at = entry[np.repeat(kept, size)]  # entries of kept terms, term by term
    term = np.repeat(np.arange(kept.sum()), size[kept])
    length = lengths[at]
    place = np.repeat(np.cumsum(lengths)[at] - np.cumsum(length), length) + np.arange(length.sum())
    posting = np.repeat(term, length) * len(names) + codes[place]
    order = np.argsort(posting, kind="stable")
    first, _ = _sums(posting[order])
    n = np.add.reduceat(counts[place][order], first)
    posting = posting[order][first]
    starts = np.flatnonzero(np.diff(posting // len(names), prepend=-1))
    lang, text = zip(*(keys[i].split(b" ", 1) for i in new[kept].tolist()))
    source = pa.array([s.decode("utf-8", "replace") for s in names.to_pylist()])
    columns = [
        pa.array([bytes.fromhex(x.decode()).decode("utf-8", "replace") for x in lang]),
        pa.array([t.decode("utf-8", "replace") for t in text]),
        _lists(source.take(pa.array(posting % len(names))), starts),
        _lists(pa.array(n), starts),
        pa.array(np.add.reduceat(n, starts)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "sources", "counts", "total"])


def _merge(min_documents: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by shard; one shard's runs are held at a time.
        rows = ((shard.as_py(), *(v.values for v in lists)) for b in batches for shard, *lists in zip(*b.columns))
        for _, runs in groupby(rows, key=itemgetter(0)):
            found = _frequencies([r[1:] for r in runs], min_documents)
            for at in range(0, found.num_rows if found else 0, 10_000):
                yield found.slice(at, 10_000)

    return run


def term_frequencies(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, block_postings: int = BLOCK_POSTINGS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A written table of every kept term: ``lang``, ``term``, its ``sources`` with their ``counts``, and ``total``."""
    texts = docs.select(utf8("lang").alias("lang"), utf8("source").alias("source"), utf8("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // shard_bytes
    runs = materialize(texts.mapInArrow(_index(shards, block_postings), _RUN), "runs")
    dealt = runs.repartition(2 * shards, "shard").sortWithinPartitions("shard")
    return materialize(dealt.mapInArrow(_merge(min_documents), _FREQUENCIES), "frequencies")


def _scaled(n: Column, total: Column, terms: Column) -> Column:
    """``p``, in decimals so that no product overflows; NULL without terms."""
    numerator = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(SMOOTH))
    denominator = total.cast("decimal(20,0)") + F.lit(SMOOTH) * terms.cast("decimal(18,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", numerator, denominator))


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each term and each two sources that hold it, what the bases alone get wrong; summed per pair in tiles."""
    index: dict[tuple[str, str], int] = {}
    names: list[tuple[str, str]] = []
    tiles: dict[tuple[int, int], np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (i, j), tile in tiles.items():
            at, to = np.nonzero(tile)
            rows = [(*names[i * TILE + a], names[j * TILE + b][1], int(tile[a, b])) for a, b in zip(at.tolist(), to.tolist())]
            for k in range(0, len(rows), 50_000):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 50_000]), [pa.string()] * 3 + [pa.int64()])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "v"])

    for batch in batches:
        for lang, held in zip(batch.column(0).to_pylist(), batch.column(1)):
            # Languages share an index, but a term's sources are of one language, so no tile mixes two of them.
            place = []
            for source in held.values.field(0).to_pylist():
                key = (lang, source)
                if key not in index:
                    index[key] = len(names)
                    names.append(key)
                place.append(index[key])
            place = np.array(place)
            order = np.argsort(place)
            place = place[order]
            p, base = (held.values.field(i).to_numpy(zero_copy_only=False)[order] for i in (1, 2))
            parts = np.split(np.arange(len(place)), np.flatnonzero(np.diff(place // TILE)) + 1)
            for u, x in enumerate(parts):
                for y in parts[u:]:
                    px, bx, py, by = p[x, None], base[x, None], p[y], base[y]
                    fix = np.abs(px - py) - np.abs(px - by) - np.abs(bx - py) + np.abs(bx - by)
                    if x is y:
                        fix = np.triu(fix, 1)
                    tile = (int(place[x[0]] // TILE), int(place[y[0]] // TILE))
                    if tile not in tiles:
                        tiles[tile] = np.zeros((TILE, TILE), np.int64)
                    tiles[tile][np.ix_(place[x] % TILE, place[y] % TILE)] += fix
            if len(tiles) > MOST_TILES:
                yield from flush()
                tiles.clear()
    yield from flush()


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, **sizes: int) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: per source, its difference to every other source of
    its language (``pair``), and the terms it uses more than the language does (``term``)."""
    kept = term_frequencies(docs, min_documents, **sizes)
    postings = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    postings = postings.select("lang", "term", "total", F.col("s.sources").alias("source"), F.col("s.counts").alias("n"))

    group = F.struct("lang", "source").alias("group")
    sums = postings.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    found = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    sized = found.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "terms", "lang_size"])
    base = F.coalesce(_scaled(F.lit(0), F.col("size"), F.col("terms")), F.lit(0))
    groups = materialize(sized.select(group, "lang", "source", "size", "terms", "lang_size", base.alias("base")), "groups")

    placed = join_dimension(postings.select(group, "term", "total", "n"), groups, "group", "inner")
    p, q = _scaled(F.col("n"), F.col("size"), F.col("terms")), _scaled(F.col("total"), F.col("lang_size"), F.col("terms"))
    scored = materialize(placed.select("lang", "source", "term", "base", p.alias("p"), q.alias("q")), "scored")

    terms = scored.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    pairs = _pair_values(groups, scored).withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)


def _pair_values(groups: DataFrame, scored: DataFrame) -> DataFrame:
    left = groups.select("lang", F.col("source").alias("a"), "terms", F.col("base").alias("base_a"))
    right = groups.select("lang", F.col("source").alias("b"), F.col("base").alias("base_b"))
    pairs = join_dimension(left, right, "lang", "inner").filter("a != b")

    # Terms of a against the base of b, |d - delta| - |delta| with d = p - base: sums over d up to delta, and over all d.
    steps = scored.groupBy("lang", F.col("source").alias("a"), F.expr("p - base").alias("x")).agg(F.count("*").alias("c"))
    events = steps.select("lang", "a", "x", "c", F.expr("c * x").alias("s"))
    asked = pairs.select("lang", "a", F.expr("base_b - base_a").alias("x"), "b", "terms")
    rows = events.unionByName(asked, allowMissingColumns=True)
    by = Window.partitionBy("lang", "a")
    upto = by.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"{n}{w}": F.coalesce(F.sum(n).over(over), F.lit(0)) for n in ("c", "s") for w, over in (("1", upto), ("2", by))}
    met = rows.withColumns(sums).filter("b is not null")
    one_side = met.select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        # V times the difference of the bases comes with one of the two directions.
        F.expr("x * c1 - s1 + (s2 - s1) - x * (c2 - c1) - abs(x) * c2 + if(a < b, terms * abs(x), 0)").alias("v"),
    )

    held = scored.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("held"))
    fixes = held.select("lang", "held").mapInArrow(_corrections, "lang string, a string, b string, v long")
    fixes = fixes.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "v")
    both = one_side.unionByName(fixes).groupBy("lang", "a", "b").agg(F.sum("v").cast("long").alias("value"))
    way = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return both.select("lang", "value", way.alias("w")).select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
