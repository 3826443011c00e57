"""Phrase collocations per language by SON partitioning.

The corpus is dealt into ``SHARDS`` by a hash of id and text. A phrase with ``SUPPORT`` occurrences in all has, in one shard at
least, its proportional part: ``ceil(SUPPORT * words of the language there / words of the language)``. So:

1. *Mining.* Each shard is mined completely at its own lowered support, first for pairs of words that are themselves frequent,
   then for triples both of whose pairs are frequent in the same shard. A shard is a fixed part of the corpus worked on by
   many tasks. (With a shard per task the lowered support of ten would be one and prune nothing.)
2. *Union.* What was frequent in some shard becomes a bit in a filter of ``2 ** FILTER_BITS`` bits, whatever the corpus; pairs
   have a second filter that knows the shard. Two phrases that share a bit only let more candidates through; none is lost.
3. *Counting.* All candidates, by their words, are counted over the whole corpus in one more pass, exactly.

Mining shuffles hashes that tasks have summed, counting shuffles phrases that tasks have summed. Sharing a hash adds counts, so it
can add candidates as well but cannot lose one, and every final figure is counted on words.

Words are what blanks and tabs separate within a piece; pieces end at ``. , ; : ! ?`` and line ends. A-Z count as a-z.

NULL text is empty, a NULL language is ``und``. A language without words has no rows. Repeated rows count as often as they are there.
Long texts are read in stretches of ``STRETCH`` bytes that carry their last two words on. Equal scores are ranked by count, then by
the phrase's UTF-8 bytes; equal cuts count for the shorter first part. Empty tables give an empty result. Columns beside ``doc_id``,
``lang`` and ``text`` are not read, whatever their names. Bytes that are not UTF-8 are the replacement character.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import LOWER, UPPER, utf8
from twinledger.plans.joins import join_dimension
from twinledger.session import materialize

SUPPORT = 10
SHARDS = 3
#: Candidates inside a longer one that has at least this share of their occurrences (percent) are dropped.
ABSORBED = 50
TOP = 2000
SCALE = 1_000_000
FILTER_BITS = 27
BLOCK_WORDS = 2_000_000
STRETCH = 1 << 20

_CACHE = 200_000
_TOGETHER = 30_000
_END = b"\xff"  # stands for the end of a piece; no byte of UTF-8
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(UPPER.encode() + b"\t" + _ENDS, LOWER.encode() + b" " + _END * len(_ENDS))
_CUT = re.compile(b"[ \xff]")
_WORD, _PAIR, _TRIPLE, _LOCAL = 1, 2, 3, 4
_MOST_WORDS = 1 << 21  # of a block, so that three word numbers fit 63 bits
_HASH = np.uint64((1 << 64) - 256)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _Words(dict):
    """Words numbered as they come, with their hashes; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})
        self.hashes = array("Q", [0])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word) | 1)
        return number

    def numbers(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers and the hashes of some tokens."""
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return found, np.frombuffer(self.hashes, np.uint64)[found]


def stretches(text: bytes, size: int = STRETCH) -> Iterator[tuple[int, list[bytes]]]:
    """The words of a text and the ends of its pieces, in stretches: (how many are carried over, tokens).

    The first ``carried`` tokens of a stretch are the last ones of the stretch before it."""
    try:
        text.decode("utf-8")
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode()
    text = text.translate(_TABLE)
    at, carried = 0, []
    while at < len(text):
        cut = _CUT.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        tokens = carried + text[at:end].replace(_END, b" \xff ").split()
        yield len(carried), tokens
        at, carried = end, tokens[-2:]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M3
    return h ^ (h >> np.uint64(29))


def word_keys(h: np.ndarray, lang: int) -> np.ndarray:
    return _mixed(h * _M1 + np.uint64(lang))


def pair_keys(h: np.ndarray, lang: int) -> np.ndarray:
    return _mixed(_mixed(h[:-1] * _M2 + np.uint64(lang)) + h[1:] * _M1)


def triple_keys(two: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Of the keys of the pairs and the hashes of the words."""
    return _mixed(two[:-1] * _M2 + h[2:] * _M1)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _lang_hash(lang: bytes) -> int:
    return xxhash.xxh64_intdigest(lang, 1)


def _shard_bits(shards: int) -> int:
    return (shards - 1).bit_length()


class _Filters:
    """Which words, pairs and triples are to be looked at; no filter lets all through."""

    def __init__(self, shared: dict, filter_bits: int, shards: int):
        self._bits = {k: np.frombuffer(b.value, np.uint8) for k, b in shared.items()}
        self._shift = np.uint64(64 - filter_bits)
        self._shard_bits = np.uint64(_shard_bits(shards))

    def _pass(self, k: int, ok: np.ndarray, keys: np.ndarray, shard: int = 0) -> np.ndarray:
        if k in self._bits:
            at = np.flatnonzero(ok)
            place = keys[at] >> self._shift
            if k == _LOCAL:
                place = place >> self._shard_bits << self._shard_bits | np.uint64(shard)
            ok = np.zeros_like(ok)
            ok[at] = _has(self._bits[k], place)
        return ok

    def places(self, h: np.ndarray, lang: int, carried: int, k: int, shard: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Where the phrases of ``k`` words begin that are new in this stretch, and the keys of all places."""
        word = self._pass(_WORD, h != 0, word_keys(h, lang))
        two = pair_keys(h, lang)
        ok = word[:-1] & word[1:]
        if k == _PAIR:
            ok[: max(carried - 1, 0)] = False
            return np.flatnonzero(self._pass(_PAIR, ok, two)), two
        ok = self._pass(_PAIR, self._pass(_LOCAL, ok, two, shard), two)
        three = triple_keys(two, h)
        return np.flatnonzero(self._pass(_TRIPLE, ok[:-1] & ok[1:], three)), three


def _sums(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, and how often it is there."""
    key = np.concatenate(keys)
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    return key[first], np.diff(first, append=len(key))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur, per language; and per language and shard the sum, as a row without a word."""
    counts: dict[bytes, dict[bytes, int]] = {}
    sums: dict[tuple[bytes, int], int] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, words in counts.items():
            rows = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.binary()), pa.nulls(rows, pa.int32()), pa.array(list(words), pa.binary()), pa.array(words.values(), pa.int64())],
                names=["lang", "shard", "word", "n"],
            )
        rows = len(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in sums], pa.binary()), pa.array([s for _, s in sums], pa.int32()), pa.nulls(rows, pa.binary()),
             pa.array(sums.values(), pa.int64())],
            names=["lang", "shard", "word", "n"],
        )

    for batch in batches:
        for lang, shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = counts.setdefault(lang, {})
            held -= len(words)
            for carried, tokens in stretches(text.as_py()):
                found = Counter(tokens[carried:])
                found.pop(_END, None)
                for token, n in found.items():
                    words[token] = words.get(token, 0) + n
                sums[lang, shard] = sums.get((lang, shard), 0) + found.total()
            held += len(words)
            if held > _CACHE:
                yield from flush()
                counts, sums, held = {}, {}, 0
    if sums:
        yield from flush()


class _Joined:
    """Short texts of one kind put together, with an end of a piece between them, so that arrays are worth their while."""

    def __init__(self):
        self._held: dict[tuple, list[bytes]] = {}

    def add(self, kind: tuple, text: bytes) -> Iterator[tuple[tuple, int, list[bytes]]]:
        """What is ready to be looked at: stretches of a long text as they are, many short texts at once."""
        if len(text) > STRETCH:
            for carried, tokens in stretches(text):
                yield kind, carried, tokens
            return
        held = self._held.setdefault(kind, [])
        for _, tokens in stretches(text):
            held += tokens
            held.append(_END)
        if len(held) > _TOGETHER:
            yield kind, 0, self._held.pop(kind)

    def rest(self) -> Iterator[tuple[tuple, int, list[bytes]]]:
        for kind, tokens in self._held.items():
            yield kind, 0, tokens
        self._held = {}


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [
            word_keys(np.array([xxhash.xxh64_intdigest(word.as_py()) | 1], np.uint64), _lang_hash(lang.as_py()))[0]
            for lang, word in zip(batch.column(0), batch.column(1))
        ]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], names=["key"])


def _mine(shared: dict, k: int, filter_bits: int, shards: int, block_words: int):  # noqa: ANN202
    """Hashes of the phrases of ``k`` words of each shard, summed per block, with the support asked of them there."""

    def flush(keys: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for support, parts in keys.items():
            key, n = _sums(parts)
            columns = [pa.array(key.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(np.full(len(key), support, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "support"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _Filters(shared, filter_bits, shards)
        words = _Words()
        joined = _Joined()
        keys: dict[int, list] = {}
        held = 0

        def look(lang: bytes, shard: int, support: int, carried: int, tokens: list[bytes]) -> None:
            nonlocal words, held
            if len(tokens) < k:
                return
            if len(words) > _CACHE:
                words = _Words()
            at, key = filters.places(words.numbers(tokens)[1], _lang_hash(lang), carried, k, shard)
            # The shard takes the lowest bits of the hash.
            keys.setdefault(support, []).append(key[at] & _HASH | np.uint64(shard))
            held += len(at)

        for batch in batches:
            for lang, shard, text, support in zip(*(batch.column(i) for i in range(4))):
                rows = joined.add((lang.as_py(), shard.as_py(), support.as_py()), text.as_py())
                for (lang, shard, support), carried, tokens in rows:
                    look(lang, shard, support, carried, tokens)
                if held > block_words:
                    yield from flush(keys)
                    keys, held = {}, 0
        for (lang, shard, support), carried, tokens in joined.rest():
            look(lang, shard, support, carried, tokens)
        yield from flush(keys)

    return run


def _count(shared: dict, filter_bits: int, block_places: int):  # noqa: ANN202
    """Candidates of two and three words and how often they occur, by their words, summed per block."""

    def flush(places: dict[tuple[bytes, int], list], words: _Words) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(words), pa.binary())
        for (lang, k), parts in places.items():
            code, n = _sums(parts)
            for at in range(0, len(code), 100_000):
                some = code[at : at + 100_000]
                numbers = [pa.array((some >> 21 * i) & (_MOST_WORDS - 1)) for i in reversed(range(k))]
                phrase = pc.binary_join_element_wise(*[names.take(x) for x in numbers], b" ")
                rows = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * rows, pa.binary()), pa.array(np.full(rows, k, np.int32)), phrase, pa.array(n[at : at + rows])],
                    names=["lang", "k", "phrase", "n"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _Filters(shared, filter_bits, 1)
        words = _Words()
        places: dict[tuple[bytes, int], list] = {}
        held = 0
        joined = _Joined()
        texts = ((lang, text.as_py()) for b in batches for lang, text in zip(b.column(0).to_pylist(), b.column(2)))
        stretched = chain((row for lang, text in texts for row in joined.add((lang,), text)), joined.rest())
        for (lang,), carried, tokens in stretched:
            if held > block_places or len(words) + len(tokens) >= _MOST_WORDS:
                yield from flush(places, words)
                words, places, held = _Words(), {}, 0
            number, h = words.numbers(tokens)
            for k in (_PAIR, _TRIPLE):
                if len(tokens) < k:
                    continue
                at, _ = filters.places(h, _lang_hash(lang), carried, k)
                if len(at):
                    phrase = number[at]
                    for i in range(1, k):
                        phrase = phrase << 21 | number[at + i]
                    places.setdefault((lang, k), []).append(phrase)
                    held += len(at)
        yield from flush(places, words)

    return run


def _shared_filter(keys: DataFrame, filter_bits: int, shards: int = 1):  # noqa: ANN202
    """A broadcast bit per key; the table has ``2 ** filter_bits / 8`` bytes however many keys there are. With several
    ``shards``, which the lowest bits of a key name, a bit belongs to one of them."""
    low = _shard_bits(shards)
    place = F.shiftrightunsigned("key", 64 - filter_bits + low) * (1 << low)
    if low:
        place = place + F.col("key").bitwiseAND(F.lit((1 << low) - 1))
    parts = keys.select((place + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    bits = bytearray(max(1, 1 << filter_bits - 3))
    for batch in parts.toArrow().to_batches():
        for part, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
            piece = piece.as_py()[: len(bits)]
            bits[(part - 1) * 4096 : (part - 1) * 4096 + len(piece)] = piece
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


def phrase_counts(
    docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS, filter_bits: int = FILTER_BITS, block_words: int = BLOCK_WORDS
) -> tuple[DataFrame, DataFrame]:
    """Two tables: the words of each language (``lang``, ``n``), and ``lang``, ``k``, ``phrase``, ``a`` of every phrase of one to
    three words with ``a >= support``."""
    if not 1 <= shards <= 256:
        raise ValueError("there are 1 to 256 shards")
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    texts = docs.select(utf8(lang).alias("lang"), shard.alias("shard"), utf8("text").alias("text"))
    tallies = texts.mapInArrow(_tally, "lang binary, shard int, word binary, n long")
    tallies = materialize(tallies.groupBy("lang", "shard", "word").agg(F.sum("n").alias("n")), "tallies")
    words = tallies.filter("word is not null").filter(F.col("n") >= support)
    cells = tallies.filter("word is null").select("lang", "shard", F.col("n").alias("here"))
    sizes = cells.groupBy("lang").agg(F.sum("here").alias("n")).filter("n > 0")

    # ceil(support * here / n), in whole numbers.
    lowered = F.expr(f"cast((cast({support} as decimal(10,0)) * here + n - 1) div n as int)")
    cell = F.concat_ws(":", F.col("shard").cast("string"), F.hex("lang"))
    supports = materialize(cells.join(sizes, "lang").select(cell.alias("cell"), lowered.alias("support")), "supports")
    dealt = join_dimension(texts.withColumn("cell", cell), supports, "cell", "inner").select("lang", "shard", "text", "support")

    shared = {_WORD: _shared_filter(words.select("lang", "word").mapInArrow(_word_keys, "key long"), filter_bits)}

    def mined(k: int, known: dict) -> DataFrame:
        hashes = dealt.mapInArrow(_mine(known, k, filter_bits, shards, block_words), "key long, n int, support int")
        local = hashes.groupBy("key").agg(F.sum("n").alias("n"), F.min("support").alias("support")).filter("n >= support")
        return materialize(local.select("key"), "mined")

    pairs = mined(_PAIR, shared)
    triples = mined(_TRIPLE, {**shared, _LOCAL: _shared_filter(pairs, filter_bits, shards)})
    shared = {**shared, _PAIR: _shared_filter(pairs, filter_bits), _TRIPLE: _shared_filter(triples, filter_bits)}
    counted = dealt.mapInArrow(_count(shared, filter_bits, 2 * block_words), "lang binary, k int, phrase binary, n long")
    counted = counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= support)
    single = words.select("lang", F.lit(_WORD).alias("k"), F.col("word").alias("phrase"), F.col("n").alias("a"))
    found = materialize(single.unionByName(counted), "phrases")
    return sizes, found.select(F.col("lang").cast("string").alias("lang"), "k", F.col("phrase").cast("string").alias("phrase"), "a")


def collocations(
    docs: DataFrame, support: int = SUPPORT, absorbed: int = ABSORBED, top: int = TOP, **sizes: int
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of two and three words of each language."""
    words, found = phrase_counts(docs, support, **sizes)
    candidates = found.filter("k > 1").withColumn("w", F.split("phrase", " "))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("w", start, length), " ")

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    cuts = candidates.select("*", cut.alias("c")).select(
        "lang", "phrase", "a", "c", joined(F.lit(1), F.col("c")).alias("first"), joined(F.col("c") + 1, F.col("k") - F.col("c")).alias("rest")
    )
    # Parts are unique among the counts, so a part of many candidates is split where Spark finds it skewed.
    known = cuts
    for part, count in (("first", "l"), ("rest", "r")):
        known = known.join(found.select("lang", F.col("phrase").alias(part), F.col("a").alias(count)), ["lang", part]).drop(part)
    # Products in 38 digits; the score itself is at most SCALE.
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", a * a * F.lit(SCALE).cast("decimal(7,0)"), l * r)
    least = known.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "c", "l", "r", "a")).alias("low")
    )

    # The pairs inside candidates of three words.
    inner = F.explode(F.array(joined(F.lit(1), F.lit(2)), joined(F.lit(2), F.lit(2))))
    longer = candidates.filter(F.col("k") == _TRIPLE).select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = least.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("low.a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "low.*").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    sized = words.select(F.col("lang").cast("string").alias("lang"), "n")
    return ranked.join(sized, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
