from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import fingerprints, queries, secret_scan, token_shards
from tests.llm.conftest import DOC_SCHEMA, document_rows, sentence, write_tables


# Token shards


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation_is_one_to_one(size):
    out = token_shards.permuted(np.arange(size), size)
    assert sorted(out.tolist()) == list(range(size))
    if size > 100:
        assert (out != token_shards.permuted(np.arange(size), size, key=99)).any()


def test_round_trip_through_shards(spark, tmp_path, docs, rows):
    index = token_shards.write_shards(docs, str(tmp_path / "out"), per_shard=7).collect()
    n = len(index)
    assert sorted(r.slot for r in index) == list(range(n)) == sorted(r.number for r in index)
    back = {r.slot: bytes(r.tokens) for r in token_shards.read_from(spark, str(tmp_path / "out"), per_shard=7).collect()}
    assert sorted(back) == list(range(n)) and {len(t) for t in back.values()} == {2 * token_shards.SEQUENCE}
    texts = {}
    for r in sorted(index, key=lambda r: r.part):
        own = back[r.slot][: 2 * r.n_tokens]
        assert zlib.crc32(own) == r.tokens_crc32 and r.shard == r.slot // 7 and r.offset == r.slot % 7 * 1024
        if r.doc_id is not None and r.doc_id != rows[10][0]:
            texts[r.doc_id] = texts.get(r.doc_id, b"") + own
    coder = token_shards.Tokenizer(open(token_shards.VOCABULARY, "rb").read())
    for doc_id, ids in texts.items():
        ids = np.frombuffer(ids, "<u2").tolist()
        assert ids[-1] == token_shards.END_OF_TEXT
        assert coder._coder.decode(ids[:-1]) == (dict((r[0], r[1]) for r in rows if r[0] is not None)[doc_id] or "")
    later = token_shards.read_from(spark, str(tmp_path / "out"), 10, 7)
    assert sorted(r.slot for r in later.collect()) == list(range(10, n))


def test_pieces_are_encoded_as_the_whole(spark):
    coder = token_shards.Tokenizer(open(token_shards.VOCABULARY, "rb").read())
    for text in ["a b  c", " lead", "tail ", "x \n y", "it's I'll 12 34", "é ñ  ü", "a\0 b", "", " ", "tab\t word\n\n next", "don't  stop !!"]:
        assert np.frombuffer(coder.encode(text), "<u2").tolist() == coder._coder.encode_ordinary(text)


def test_no_documents(spark, tmp_path, no_docs):
    assert token_shards.write_shards(no_docs, str(tmp_path / "out")).count() == 0


# Secrets

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for *_, s in sorted(found)]


def secret_rows():
    rng = random.Random(6)
    out = list(document_rows(6, 20))
    for i in range(120):
        text = sentence(rng, 30)
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        key = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
        extra = [f'token = "{value}"', f"PassWord: {value[:12]}", key, "call 555-0123 or 10.0.0.1", "", "secret=abc", f"ſecret={value[:9]}"][i % 7]
        out.append((1000 + i, text[:50] + " " + extra + " " + text[50:], "en", "s", 0))
    out.append((3000, "note " + "".join(rng.choice("0123456789abcdef") for _ in range(23)) + " " + sentence(rng, 9), "en", "s", 0))
    return out


def test_patterns_stay_and_counts_agree(spark, tmp_path):
    rows = secret_rows()
    path = write_tables(spark, tmp_path, documents=spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))
    got = queries.op8_secrets(spark, path).collect()
    want = sorted((str(r[0]), hashlib.sha256(",".join(base(r[1])).encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            spans = base(texts[r.doc_id])
            assert set(spans) <= set(r.spans.split(",")) | {""}
            kinds = [s.split(":")[0] for s in spans]
            assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in secret_scan.KINDS]


PLANTED = ["pwd CorrectHorse", "password Tr0ub4dor&3!xyz", "login hunter2!@#$%^abc", "key Zq8fT2mLx9Rw4kPd"]


@pytest.fixture(scope="module")
def field(spark):
    return secret_scan.learn(spark.createDataFrame([r for r in secret_rows() if r[0] != 3000], DOC_SCHEMA))


def test_field_finds_secrets_that_no_pattern_matches(spark, field):
    tagger = secret_scan.Tagger(field)
    rng = random.Random(9)
    for planted in PLANTED:
        secret = planted.split()[1]
        for words in (5, 20, 4000):
            front = sentence(rng, words)
            text = f"{front} {planted} {sentence(rng, words)}"
            assert base(text) == []
            at = len(front) + 1 + planted.index(secret)
            touched = [(a, b) for a, b in tagger.spans(text) if a < at + len(secret) and b > at]
            assert touched and all(at <= a and b <= at + len(secret) for a, b in touched), planted
    docs = spark.createDataFrame(secret_rows(), DOC_SCHEMA).select("doc_id", secret_scan.scan_column(F.col("text"), field).alias("s"))
    found = {r.doc_id: r.spans for r in docs.select("doc_id", "s.spans").collect()}
    assert found[3000] == "field:5:28"
    assert not any("field" in found[1000 + i] for i in range(120) if i % 7 in (3, 4))


def test_values_are_found_again_without_their_keyword(field):
    """On texts that were not learned from, and nothing in texts without a secret. The field has seen 80 values only here,
    so it is asked without caution."""
    tagger, rng = secret_scan.Tagger(field, caution=0.0), random.Random(77)
    hits = 0
    for _ in range(50):
        front, value = sentence(rng, 20), "".join(rng.choice("0123456789abcdef") for _ in range(40))
        spans = tagger.spans(f"{front} note {value} {sentence(rng, 20)}")
        hits += (len(front) + 6, len(front) + 6 + len(value)) in spans
        assert tagger.spans(sentence(rng, 60) + " the secret garden of a password " + sentence(rng, 60)) == []
    assert hits >= 48


def test_window_without_its_keyword():
    text, values = 'it token = "abcdef" and key=zz99zz x', [(12, 18), (28, 34)]
    bare, moved = secret_scan.without_keyword(text, values)
    assert bare == "it abcdef and key=zz99zz x" and [bare[a:b] for a, b in moved] == ["abcdef", "zz99zz"]


def test_spans_that_patterns_hold_are_not_repeated():
    assert secret_scan.added_spans([(0, 4), (5, 9), (8, 14), (20, 22)], [(4, 10), (0, 6)]) == [(8, 14), (20, 22)]


def test_scores_of_the_tagger_are_the_sums_of_features(field):
    tagger = secret_scan.Tagger(field)
    for text in ["", "  a", 'x password: "ab!c" 12', "token=\n\nZz9 ünï-x", " ".join(PLANTED)]:
        assert np.allclose(tagger.scores(text), field.emit[secret_scan.chain_features(text)].sum(1).reshape(-1, 3))
        starts, ends = secret_scan.places_of(text)
        assert [text[a:b] for a, b in zip(starts, ends)] == [w.lstrip() for w in secret_scan.tokens_of(text)]


def test_viterbi_and_marginals_against_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    paths = list(itertools.product(range(3), repeat=5))
    for trial in range(60):
        field = secret_scan.Field()
        field.move += rng.normal(size=(3, 3))
        field.start += rng.normal(size=3)
        scores = rng.normal(size=(5, 3)) * 2
        scores[:, 0] += trial % 6  # from none to most tokens certain
        value = [
            field.start[p[0]] + sum(scores[t, y] for t, y in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:]))
            for p in paths
        ]
        assert tuple(field.tags(scores)) == paths[int(np.argmax(value))]
    node, edge = field._marginals(scores[None], np.ones((1, 5), bool))
    p = np.exp(np.array(value) - max(value))
    p /= p.sum()
    for t in range(5):
        assert np.allclose(node[0, t], [sum(q for q, path in zip(p, paths) if path[t] == y) for y in range(3)])


def test_no_secrets_anywhere(spark, no_docs):
    assert secret_scan.find_secrets(no_docs).count() == 0
    plain = spark.createDataFrame([(1, "nothing here", "en", "s", 0), (2, None, "en", "s", 0)], DOC_SCHEMA)
    assert {r.spans for r in secret_scan.find_secrets(plain).collect()} == {""}


# Fingerprints


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_neighbours_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(5 * i, rng.choice([None, "", "a", sentence(rng, 3), sentence(rng, 60), sentence(rng, 900), "Ünï " * 9]), "", "", 0) for i in range(70)]
    rows += [(1000, rows[4][1], "", "", 0), (1001, rows[4][1], "", "", 0)]
    path = write_tables(spark, tmp_path, documents=spark.createDataFrame(rows[::-1], DOC_SCHEMA).repartition(6))
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, path).collect()}
    prints = {}
    for (doc_id, text, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        for near, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = shingles(text), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < (1e-9 if max(len(a), len(b)) < fingerprints.K else 0.2)


def test_order_with_null_and_equal_ids(spark, docs, no_docs, rows):
    assert fingerprints.compare_neighbours(docs.select("doc_id", "text")).count() == len(rows)
    assert fingerprints.compare_neighbours(no_docs).count() == 0
    one = spark.createDataFrame([(1, "abcdefgh", "", "", 0)], DOC_SCHEMA)
    assert fingerprints.compare_neighbours(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(9)
    words = [sentence(rng, 1) + str(i) for i in range(9000)]
    a, b = " ".join(words[:6000]), " ".join(words[3000:])
    sa, sb = fingerprints.sketch(a.encode()), fingerprints.sketch(b.encode())
    assert abs(fingerprints.resemblance(sa, sb) - 1 / 3) < 0.13
    assert abs(fingerprints.containment(sa, sb) - 1 / 2) < 0.2
    assert abs(fingerprints.distinct_shingles(sa) / 5996 - 1) < 0.3
    both = np.unique(np.concatenate([fingerprints.sketch(a.encode(), 10**6), fingerprints.sketch(b.encode(), 10**6)]))
    assert (fingerprints.merge(sa, sb) == both[: fingerprints.K]).all()
    parts = spark.createDataFrame(
        [("x", fingerprints.encode(sa)), ("x", fingerprints.encode(sb)), ("y", fingerprints.encode(sa)), ("z", "")], "k string, f string"
    )
    got = dict(map(tuple, fingerprints.merged(parts, "k", "f").collect()))
    assert (fingerprints.decode(got["x"]) == both[: fingerprints.K]).all() and got["y"] == fingerprints.encode(sa) and got["z"] == ""


def test_windows_are_sampled_in_one_pass(spark, monkeypatch, capsys):
    monkeypatch.setattr(secret_scan, "LEARN_WINDOWS", 3)
    monkeypatch.setattr(secret_scan, "LEARN_PLAIN", 5)
    docs = spark.createDataFrame(secret_rows(), DOC_SCHEMA).repartition(3)
    sample = secret_scan.sample_windows(docs)
    sample.explain()
    shown = capsys.readouterr().out
    assert len([line for line in shown.splitlines() if "ArrowEvalPython" in line]) == 1 and "WindowGroupLimit" in shown
    every = docs.select(F.explode(secret_scan.windows_column(F.col("text"))).alias("w")).select("w.*")
    every = every.withColumn("hash", F.xxhash64("window")).orderBy("hash", "window", "at").collect()
    want = [r.window for r in every if r["at"]][:3] + [r.window for r in every if not r["at"]][:5]
    assert [r.window for r in sample.orderBy("plain", "rank").collect()] == want


def test_patterns_and_shapes_by_shortcut_are_the_same():
    rng = random.Random(5)
    parts = ["Pass", "WORD", "password", "apİ_key", "Api_Key", "API", "KEY", "=", ": ", "'", "AKIA", "ABCDEFGH12345678", "é", "ſecret", "K", "\ud800",
             "secret", "TOKEN", "0123456789abcdef", "deadbeef", "f", "x", " ", "\n", "hunter22", "İ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = [(m.start(), 0, m.end(), m.start(2)) for m in secret_scan._ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        want += [(m.start(), 1, m.end(), m.start()) for m in secret_scan._ACCESS.finditer(text) if m.end() - m.start() >= 20]
        want += [(m.start(), 2, m.end(), m.start()) for m in secret_scan._HEX.finditer(text)]
        assert secret_scan.pattern_spans(text) == sorted(want)
    for word in ["a", "fade", "Fade", "A", "AB", "aB", "Word", "mixedCase", "x9", "É", "été", "_", "z"]:
        signs, size, turns, _, glued = secret_scan.shape_of(" " + word)
        assert (signs, size, glued) == (secret_scan._signs(word), secret_scan._bucket(len(word)), False)
        assert turns == secret_scan._bucket(len(secret_scan._TURN.findall(word)))
    field = secret_scan.Field()
    field.emit[:] = np.random.default_rng(3).normal(size=field.emit.shape)
    tagger = secret_scan.Tagger(field)
    for text in ["one two", "two three two one", "password= Hunter22! one"]:  # places are given as tokens come
        numbers = secret_scan.chain_features(text)
        bare = secret_scan.Tagger(field).scores(text)
        assert np.allclose(tagger.scores(text), bare) and len(bare) == len(numbers)
        assert np.allclose(bare, field.emit[numbers].sum(1))
