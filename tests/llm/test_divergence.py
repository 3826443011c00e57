from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from twinledger.llm import divergence
from tests.llm.conftest import DOC_SCHEMA

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=50):
    tf, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        tf[lang, source].update(terms)
        df[lang].update(terms.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]
        whole = sum((tf[lang, s] for s in sources), Counter())

        def p(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        ps, q = {s: p(tf[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - ps[s][t], t.encode(), t) for t in kept if tf[lang, s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, i[2], -i[0], k + 1) for k, i in enumerate(sorted(items)[:most])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def mixed(seed, n, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdéßЖ" for b in ("", "x", "Y", "zz")]
    for i in range(n):
        s = rng.randrange(sources)
        text = " ".join(rng.choices(words, [1 + (j * (s + 2)) % 7 for j in range(len(words))], k=rng.choice([0, 3, 40]))) + rng.choice(["", ".", " 12-3"])
        yield i, text, rng.choice(["en", "en", "de", None]), None if s == 0 else f"s{s}", None


@pytest.mark.parametrize("least", [1, 3, 30])
def test_against_brute_force(spark, docs, rows, least):
    assert result(divergence.audit(docs, least)) == brute(rows, least)


@pytest.mark.parametrize("sizes", [{}, {"block_postings": 50, "shard_bytes": 500}])
def test_many_sources_and_runs(spark, sizes):
    rows = list(mixed(3, 400, 9))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(7)
    assert result(divergence.audit(docs, 5, 4, **sizes)) == brute(rows, 5, 4)


def test_tiles_of_pairs(spark, monkeypatch):
    """More sources than a tile, and more tiles than are held at a time."""
    rows = list(mixed(5, 600, 40))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    small = divergence.term_frequencies(docs, 3)
    assert small.count() > 0
    import pyarrow as pa

    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "MOST_TILES", 2)
    rng = random.Random(1)
    want: Counter = Counter()
    lists = []
    base = {f"s{i}": 5 + i for i in range(23)}
    for _ in range(30):
        held = [(s, base[s] + rng.randint(0, 20), base[s]) for s in rng.sample(sorted(base), rng.randint(1, 23))]
        lists.append([{"source": s, "p": p, "base": b} for s, p, b in held])
        for i, (s, p, b) in enumerate(held):
            for t, r, c in held[i + 1 :]:
                want[min(s, t), max(s, t)] += abs(p - r) - abs(p - c) - abs(b - r) + abs(b - c)
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("base", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 30), pa.array(lists, kind)], names=["lang", "held"])
    got: Counter = Counter()
    for out in divergence._corrections(iter([batch])):
        for r in out.to_pylist():
            got[min(r["a"], r["b"]), max(r["a"], r["b"])] += r["v"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_long_texts_are_cut_between_terms():
    text = b"Alpha beta-gamma " * 1000 + b"x" * 5000 + b" end"
    for stretch in (1, 7, 64, 4096):
        assert [t for part in divergence.terms_of(text, stretch) for t in part] == divergence._TERM.findall(text.lower())


def test_empty_and_clashing(spark, no_docs, docs, clashing):
    assert divergence.audit(no_docs).count() == 0
    extra = clashing.withColumns({c: F.lit(1) for c in ("shard", "group", "base", "size", "terms", "term", "total", "p", "q", "n") if c not in clashing.columns})
    assert result(divergence.audit(extra, 3)) == result(divergence.audit(docs, 3))


def test_no_terms_kept(spark):
    rows = [(1, "one two", "en", "a", 0), (2, "three", "en", "b", 0), (3, None, "en", None, 0)]
    assert result(divergence.audit(spark.createDataFrame(rows, DOC_SCHEMA))) == brute(rows, 30)
