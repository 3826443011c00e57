from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import phrases
from tests.llm.conftest import DOC_SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def brute(rows, support, absorbed=50, top=2000):
    out = []
    for lang, f in counts_of(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        scored = []
        for p, a in candidates.items():
            if any(100 * b >= absorbed * a for q, b in candidates.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            phrase = " ".join(p)
            scored.append((-score, -a, phrase.encode(), phrase, l, r))
        out += [(lang, i + 1, p, -a, l, r, n, -s) for i, (s, a, _, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def phrased(seed, n):
    rng = random.Random(seed)
    words = ["new", "York", "city", "of", "the", "a", "Ünï", "x1", "日本", "\x00", "e f"]
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". "]) for _ in range(rng.choice([0, 2, 9, 60])))
        yield rng.choice([i, None]), text, rng.choice(["en", "en", "en", "fr", None]), "s", None


@pytest.mark.parametrize("support", [1, 3, 10])
def test_against_brute_force(spark, docs, rows, support):
    assert result(phrases.collocations(docs, support)) == brute(rows, support)


@pytest.mark.parametrize("sizes", [{}, {"shards": 1}, {"shards": 40, "block_words": 30}, {"filter_bits": 6}])
def test_shards_blocks_and_filters_change_nothing(spark, sizes):
    rows = list(phrased(2, 300))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    assert result(phrases.collocations(docs, 10, top=25, **sizes)) == brute(rows, 10, top=25)


def test_a_shard_with_most_rows_and_copies(spark):
    """A group of copies lies in one shard, whose support rises with it."""
    rows = [(7, "the same few words, the same few words", "en", "s", None)] * 500 + list(phrased(4, 80))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    assert result(phrases.collocations(docs)) == brute(rows, 10)


def test_mining_prunes(spark):
    """Candidates are those that some shard holds its part of: fewer than all, and all that are frequent."""
    rows = list(phrased(9, 300))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    _, found = phrases.phrase_counts(docs, 10)
    want = {(lang, " ".join(p), a) for lang, f in counts_of(rows).items() for p, a in f.items() if a >= 10}
    assert {(r.lang, r.phrase, r.a) for r in found.collect()} == want


def test_long_texts_carry_their_last_words():
    text = ("One two three, four. " * 400 + "five" * 300 + " six").encode()
    whole = next(phrases.stretches(text, 1 << 30))[1]
    filters = phrases._Filters({}, 8, 1)
    for size in (1, 5, 64, 1000):
        for k in (2, 3):
            got: Counter = Counter()
            for carried, tokens in phrases.stretches(text, size):
                if len(tokens) >= k:
                    at, _ = filters.places(phrases._Words().numbers(tokens)[1], 5, carried, k)
                    got.update(tuple(tokens[i : i + k]) for i in at.tolist())
            want = Counter(tuple(whole[i : i + k]) for i in range(len(whole) - k + 1) if b"\xff" not in whole[i : i + k])
            assert got == want


def test_filter_has_every_key(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    shared = phrases._shared_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), 20)
    bits = np.frombuffer(shared.value, np.uint8)
    assert phrases._has(bits, keys.view(np.uint64) >> np.uint64(44)).all()
    assert np.unpackbits(bits).sum() == len(np.unique(keys.view(np.uint64) >> np.uint64(44)))


def test_filter_knows_the_shard(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**64, 5000, np.uint64) & phrases._HASH | rng.integers(0, 3, 5000, np.uint64)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    filters = phrases._Filters({phrases._LOCAL: phrases._shared_filter(table, 22, 3)}, 22, 3)
    for shard in range(3):
        held = filters._pass(phrases._LOCAL, np.ones(5000, bool), keys, shard)
        own = (keys & np.uint64(3)) == shard
        assert held[own].all() and held[~own].mean() < 0.05


def test_large_counts_stay_exact(spark):
    """Scores of counts whose products pass 64 bits."""
    a, l, r = 3_000_000_017, 3_100_000_019, 3_000_000_021
    row = spark.range(1).select(*[F.lit(v).cast("decimal(15,0)").alias(n) for n, v in (("a", a), ("l", l), ("r", r))])
    score = F.call_function("div", F.col("a") * F.col("a") * F.lit(phrases.SCALE).cast("decimal(7,0)"), F.col("l") * F.col("r"))
    assert row.select(score).first()[0] == 1_000_000 * a * a // (l * r)


def test_empty_and_clashing(spark, no_docs, docs, clashing):
    assert phrases.collocations(no_docs).count() == 0
    extra = clashing.withColumns({c: F.lit(1) for c in ("shard", "cell", "support", "word", "n", "k", "phrase", "a", "l", "r")})
    assert result(phrases.collocations(extra, 3)) == result(phrases.collocations(docs, 3))
