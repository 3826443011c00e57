from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from twinledger.session import materialize
from tests.llm.conftest import DOC_SCHEMA, document_rows, write_tables
from tests.llm.test_decontaminate import ITEMS, bench, brute
from tests.llm.test_simhash import fingerprint, smallest_reachable
from tests.llm.test_toxicity import LABELS, corpus


def tables(spark, path):
    """Clean and toxic texts with labels, and texts with copies and benchmark passages without."""
    texts, labels, _ = corpus(n=400)
    odd = [(None if r[0] is None else 1000 + r[0], *r[1:]) for r in document_rows()]
    docs = spark.createDataFrame(texts + odd, DOC_SCHEMA).repartition(6)
    return texts + odd, write_tables(
        spark, path, documents=docs, labels=spark.createDataFrame(labels, LABELS),
        benchmark=spark.createDataFrame(bench(document_rows()), ITEMS),
    )


def test_every_stage_against_brute_force(spark, tmp_path):
    rows, path = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path), name)
        kept[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
    insults = {r[0] for r in rows if r[1] and ("idiot" in r[1] or "moron" in r[1])}
    assert not insults & {r.doc_id for r in kept["toxicity"]}
    assert len(kept["toxicity"]) >= len(rows) - 90

    prints = [fingerprint(r.text) for r in kept["toxicity"]]
    roots = smallest_reachable(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(kept["simhash_near_dedup"]) == len(set(roots))

    judged = brute([(r.doc_id, r.text) for r in kept["simhash_near_dedup"]], bench(document_rows()))
    clean = sorted(str(r[0]) for r in judged if not r[5])
    assert sorted(str(r.doc_id) for r in kept["decontamination"]) == clean and len(clean) < len(judged)

    assert {r.doc_id for r in kept["mixing"]} <= {r.doc_id for r in kept["decontamination"]}
    assert len(kept["sharding"]) == len(kept["mixing"])
    by = {}
    for r in kept["sharding"]:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_run_is_registered_and_chains_the_stages(spark, tmp_path):
    _, path = tables(spark, tmp_path)
    got = entry.queries()["pipeline"](spark, path)
    assert {"doc_id", "text", "shard", "slot"} <= set(got.columns) and got.count() > 0
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "decontamination", "mixing", "sharding"]
    assert sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()) == 13


def test_empty_and_clashing(spark, tmp_path, clashing):
    _, path = tables(spark, tmp_path)
    none = spark.createDataFrame([], DOC_SCHEMA)
    extra = clashing.withColumns({"shard": F.lit("x"), "slot": F.lit("y")})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, path).count() == 0
        extra = materialize(stage(spark, extra, path), name)
        assert extra.count() > 0 and set(extra.columns) == {*clashing.columns, "shard", "slot"}
