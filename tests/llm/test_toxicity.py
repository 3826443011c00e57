from __future__ import annotations

import random
import zlib

import numpy as np

from twinledger.llm import queries, toxicity
from tests.llm.conftest import DOC_SCHEMA, sentence, write_tables

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed=4, n=600):
    """Texts of which a tenth hold insults or words with a telling beginning."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(20, 60)).split()
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(4):
                word = rng.choice(["idiot", "moron", "zorf" + rng.choice(["ba", "ki", "lu", "me", "po"])])
                words.insert(rng.randrange(len(words)), word)
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic if rng.random() > 0.02 else 1 - toxic))
    return docs, labels, [t for *_, t in labels]


def test_held_out_accuracy_and_split(spark, tmp_path):
    docs, labels, _ = corpus()
    path = write_tables(
        spark, tmp_path, documents=spark.createDataFrame(docs, DOC_SCHEMA), labels=spark.createDataFrame(labels, LABELS)
    )
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, path).collect()}
    assert len(got) == len(docs)
    right = [got[i].predicted == label for i, _, label in labels if got[i].held_out]
    assert np.mean(right) > 0.93
    for i, *_ in docs:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.5)


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = corpus(n=200)
    frame = spark.createDataFrame(docs, DOC_SCHEMA)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a = toxicity.fit(frame, spark.createDataFrame(labels, LABELS))
    b = toxicity.fit(frame, spark.createDataFrame(flipped, LABELS))
    assert a.voters.number == b.voters.number and np.allclose(a.weights, b.weights)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    rates = [(0.05, 0.8), (0.1, 0.6), (0.02, 0.5), (0.2, 0.4)]
    votes = np.stack([np.where(y, rng.random(4000) < b, rng.random(4000) < a) for a, b in rates], 1).astype(float)
    copies = np.concatenate([votes, votes[:, [3]], votes[:, [3]]], 1)
    model = toxicity.fit_label_model(copies, 0.05 + 0.9 * votes[:, 0])
    assert all(abs(model.fires[j, c] - rates[j][c]) < 0.1 for j in range(3) for c in range(2))
    assert model.weights[3] < 0.5 < model.weights[0]


def test_no_labels_nulls_and_clashing_names(spark, docs, clashing, no_docs):
    none = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs, none)
    assert toxicity.keep_clean(docs, model).count() == docs.count()
    assert toxicity.keep_clean(clashing, model).columns == clashing.columns
    assert toxicity.keep_clean(no_docs, model).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 0, 1), (4, 0, 0)], LABELS)
    assert toxicity.fit(docs, odd).weights is not None
    bad = spark.createDataFrame([(1, "you idiot moron scum", "en", "s", 0)], DOC_SCHEMA)
    assert toxicity.keep_clean(bad, model).count() == 0


def test_every_voter_that_passes_is_kept(spark):
    """More than a thousand stronger voters do not push out a weaker one."""
    rng = random.Random(8)
    strong = ["".join(rng.choice("bdgkptvz") for _ in range(9)) for _ in range(400)]
    docs, labels = [], []
    for i in range(3000):
        words = sentence(rng, 12).split()
        toxic = int(i % 3 == 0)
        if toxic:
            words += rng.sample(strong, 8) + ["qux"] * (i % 210 == 0)
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    model = toxicity.fit(spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, LABELS))
    assert len(model.voters.number) > 1000 and "qux" in model.voters.number
    assert model.weights[model.voters.number["qux"]] > 0


def test_correlations_in_blocks_are_those_of_the_whole_matrix():
    rng = np.random.default_rng(2)
    votes = (rng.random((300, 40)) < rng.random(40) * 0.4).astype(float)
    votes[:, 7] = votes[:, 3]
    p, fires = rng.random(300), rng.random((40, 2)) * 0.5 + 0.01
    rest = votes - (1 - p)[:, None] * fires[:, 0] - p[:, None] * fires[:, 1]
    both = rest.T @ rest
    scale = np.sqrt(both.diagonal()) + 1e-6
    both /= scale[:, None] * scale
    want = 1 / np.where(both > 0.2, both, 0).sum(1).clip(1.0)
    got = toxicity._shares(toxicity.Votes.of(votes), fires, p, cells=100)
    assert np.allclose(got, want, atol=1e-6)
