from __future__ import annotations

import hashlib
import re

from twinledger.llm import decontaminate, queries
from tests.llm.conftest import write_tables

ITEMS = "item_id long, text string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item_id, passage in items:
            p = words(passage)
            n = min(13, len(p))
            windows = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if p else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        found.add(str(item_id))
        names = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def bench(rows):
    texts = [r[1] for r in rows]
    return [
        (1, texts[5].upper()), (2, " ".join(texts[20].split()[:14])), (10, "bado"), (11, None), (12, ""), (13, "ba do, KI"),
        (None, texts[4]), (1, texts[5].upper()), (14, "Ünï çödé wörds"), (15, " ".join((texts[-4] or "").split()[100:160])),
    ]


def test_against_brute_force(spark, tmp_path, docs, rows):
    items = bench(rows)
    path = write_tables(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame(items, ITEMS))
    got = sorted(map(tuple, queries.op1_decontaminate(spark, path).collect()), key=str)
    assert got == brute(rows, items)


def test_blocks_give_the_same(spark, docs, rows, monkeypatch):
    items = spark.createDataFrame(bench(rows), ITEMS)
    plain = decontaminate.decontaminate(docs, items).collect()
    blocks = decontaminate.benchmark_blocks(items, 200)
    assert len(blocks) > 2
    monkeypatch.setattr(decontaminate, "benchmark_blocks", lambda b: blocks)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 500)
    assert sorted(decontaminate.decontaminate(docs, items).collect(), key=str) == sorted(plain, key=str)


def test_longest_match_and_place(spark):
    text = "zero " + " ".join(f"w{i}" for i in range(30)) + " end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "other " + " ".join(f"w{i}" for i in range(5, 25)) + " tail")], ITEMS)
    m = decontaminate.matches(docs, items).first()
    assert (m.doc_id, m.item_id, m.item_word, m.doc_word, m.n_words) == (1, "7", 1, 6, 20)


def test_empty_tables_and_clashing_names(spark, no_docs, docs, clashing, rows):
    items = spark.createDataFrame(bench(rows), ITEMS)
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.decontaminate(docs, spark.createDataFrame([], ITEMS)).count() == len(rows)
    kept = decontaminate.decontaminate(clashing, items)
    assert kept.columns == clashing.columns and kept.count() == decontaminate.decontaminate(docs, items).count()
