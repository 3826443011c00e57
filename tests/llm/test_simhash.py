from __future__ import annotations

import random
import re

import xxhash

from twinledger.llm import queries, simhash
from twinledger.session import materialize
from tests.llm.conftest import DOC_SCHEMA, write_tables


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, near):
    parent = list(range(len(nodes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if near(nodes[i], nodes[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(nodes))]


def test_against_brute_force(spark, tmp_path, docs, rows):
    path = write_tables(spark, tmp_path, documents=docs)
    prints = [fingerprint(r[1]) for r in rows]
    roots = smallest_reachable(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            least[root] = min(row[0], least.get(root, row[0]))
    want = [(r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots)]
    assert sorted(map(tuple, queries.op2_simhash(spark, path).collect()), key=str) == sorted(want, key=str)


def test_all_links_of_random_neighbours(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(12)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {tuple(r) for r in simhash.links(fps).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


def test_long_chains_are_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a long, b long")).select("node", "root").collect())
    assert all(got[i] == 0 for i in range(1, 201)) and got[1002] == 1000


def test_keep_one_keeps_one_row_of_each_group(spark, docs, rows, clashing):
    kept = simhash.keep_one(docs)
    path_rows = materialize(kept, "kept").collect()
    assert kept.columns == docs.columns
    prints = [fingerprint(r[1]) for r in rows]
    roots = smallest_reachable(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for root, row in zip(roots, rows):
        groups.setdefault(root, []).append(row[0])
    want = sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=str)
    assert sorted((r.doc_id for r in path_rows), key=str) == want
    assert simhash.keep_one(clashing).count() == len(want)


def test_empty(spark, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
