from __future__ import annotations

import hashlib
import random

import numpy as np

from twinledger.llm import queries, suffix_dedup
from tests.llm.conftest import DOC_SCHEMA, write_tables


def brute(rows, length=50):
    least = {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        place = suffix_dedup.NO_ID if doc_id is None else doc_id
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            least[s] = min(place, least.get(s, place))
    out = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        place = suffix_dedup.NO_ID if doc_id is None else doc_id
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if least[raw[i : i + length]] < place:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark, tmp_path, docs, rows):
    path = write_tables(spark, tmp_path, documents=docs)
    assert sorted(map(tuple, queries.op5_suffix_dedup(spark, path).collect()), key=str) == brute(rows)


def test_busy_anchors_give_the_same(spark):
    rng = random.Random(8)
    line = "a line of forty bytes that is in many places"
    rows = [(i, f"{rng.random()} {line} {rng.random()} {'tail ' * (i % 5)} {rng.random()}" * 2, "", "", 0) for i in range(60)]
    rows += [(100, "ab" * 80, "", "", 0), (101, "ba" * 70, "", "", 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    for most in (3, 10_000):
        got = suffix_dedup.remove_repeats(docs, most).drop("ranges").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows)


def test_intervals_are_common_prefixes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    order = suffix_dedup.suffix_array(data, 16)
    text = data.tobytes()
    for length in (1, 3, 8):
        interval = suffix_dedup.common_prefix_intervals(data, order, length)
        names = [text[i : i + length] for i in order]
        for a, b, x, y in zip(names, names[1:], interval, interval[1:]):
            if len(a) == len(b) == length:
                assert (a == b) == (x == y)


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    text = random.Random(2).randbytes(5000)
    whole = [np.repeat(a[2], a[1] - a[0] + 1) for a in [suffix_dedup.anchors(text)]][0]
    monkeypatch.setattr(suffix_dedup, "_BLOCK_BITS", 9)
    parts = [np.repeat(a[2], a[1] - a[0] + 1) for a in [suffix_dedup.anchors(text)]][0]
    assert len(whole) == 5000 - 49 and (np.abs(whole - np.arange(4951)) <= 30).all() and len(parts) == len(whole)


def test_empty(spark, tmp_path, no_docs):
    assert queries.op5_suffix_dedup(spark, write_tables(spark, tmp_path, documents=no_docs)).count() == 0
