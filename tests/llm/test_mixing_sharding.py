from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from twinledger.llm import mixing, queries, sharding
from twinledger.session import materialize
from tests.llm.conftest import DOC_SCHEMA, sentence, write_tables


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        room = total - sum(capped.values())
        share = {s: room * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {**capped, **share}
        capped |= {s: 3.0 * sizes[s] for s in over}


def mixed(spark, tmp_path, docs, rows):
    path = write_tables(spark, tmp_path, documents=docs)
    got = queries.op6_mixing(spark, path).withColumn("i", F.lit(0)).collect()
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").encode().split())
    return got, size


def test_targets_and_sizes(spark, tmp_path, docs, rows):
    got, size = mixed(spark, tmp_path, docs, rows)
    want = targets(size)
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.source_size == size[source[r.doc_id]]
            assert abs(r.target - want[source[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies


def test_words_come_near_their_target(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.choice([5, 20, 60, 300])), "en", "hot" if i % 3 else f"s{i % 9}", 0) for i in range(900)]
    got, size = mixed(spark, tmp_path, spark.createDataFrame(rows, DOC_SCHEMA).repartition(7), rows)
    want = targets(size)
    for s in size:
        taken = sum(r.taken for r in got if rows[r.doc_id][3] == s)
        assert abs(taken - want[s]) <= max(10, 0.01 * want[s])
    again, _ = mixed(spark, tmp_path / "again", spark.createDataFrame(rows[::-1], DOC_SCHEMA).repartition(3), rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_inclusion_follows_the_odds(spark):
    """Over many seeds a document of a source that gives half its words is taken half the times."""
    rows = spark.range(40).select(F.concat(F.lit("d"), "id").alias("d"), F.explode(F.sequence(F.lit(1), F.lit(60))).alias("seed"))
    sized = materialize(
        rows.select(
            F.concat(F.lit("="), "seed").alias("skey"), F.col("seed").cast("string").alias("source"), F.lit(10).cast("long").alias("size"),
            mixing.uniform(F.col("seed"), F.col("d")).alias("u"), "d",
        ),
        "sized",
    )
    share = mixing.mix(sized, weights=(1,)).groupBy("d").agg(F.avg("copies").alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in share)
    half = mixing.mix(sized, weights=(1, 3)).filter("target < 400").groupBy("d").agg(F.avg("copies").alias("n")).collect()
    assert abs(sum(r.n for r in half) / len(half) - 0.5) < 0.01 and all(0.1 < r.n < 0.9 for r in half)


def test_mixed_documents(spark, docs, clashing, no_docs):
    sized = materialize(mixing.sized_documents(docs), "sized")
    wanted = mixing.mix(sized).agg(F.sum("copies")).first()[0]
    assert mixing.mixed_documents(docs).count() == wanted
    out = mixing.mixed_documents(clashing)
    assert out.columns == clashing.columns and out.count() == wanted
    assert mixing.mixed_documents(no_docs).count() == 0
    silent = spark.createDataFrame([(1, None, "en", None, 0), (2, "", "en", "a", 0)], DOC_SCHEMA)
    assert mixing.mix(materialize(mixing.sized_documents(silent), "sized")).agg(F.sum("target")).first()[0] == 0


def test_sharding(spark, tmp_path, docs, rows):
    path = write_tables(spark, tmp_path, documents=docs)
    got = queries.op10_sharding(spark, path).collect()
    text = {r[0]: r[1] for r in rows if r[0] is not None}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            raw = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(24))


def test_shards_are_even_and_growth_moves_little(spark, tmp_path):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    columns = sharding.record_columns(F.col("doc_id"), F.col("text"))
    records = materialize(docs.select("doc_id", *[c.alias(n) for n, c in columns.items()]), "records")
    weights = sharding.slot_weights(records)
    path = str(tmp_path / "map")
    sharding.save_map(sharding.first_map(weights), path)
    one = {r.virtual_slot: r.shard for r in sharding.load_map(spark, path).collect()}
    assert sorted(one) == list(range(sharding.SLOTS))
    sharding.save_map(sharding.rebalance(sharding.load_map(spark, path), weights, 25), path)
    two = {r.virtual_slot: r.shard for r in sharding.load_map(spark, path).collect()}
    assert sharding.load_map(spark, path, 1).count() == sharding.SLOTS
    size = {r.virtual_slot: r.slot_bytes for r in weights.collect()}

    def loads(m, n):
        total = [0] * n
        for v, s in m.items():
            total[s] += size[v]
        return total

    for m, n in ((one, 24), (two, 25)):
        assert max(loads(m, n)) - min(loads(m, n)) < 0.02 * sum(size.values()) / n
    moved = sum(size[v] for v in one if one[v] != two[v])
    assert moved < 1.5 * sum(size.values()) / 25


def test_empty_sharding(spark, tmp_path, no_docs):
    assert queries.op10_sharding(spark, write_tables(spark, tmp_path, documents=no_docs)).count() == 0
