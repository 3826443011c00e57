from __future__ import annotations

import hashlib

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from twinledger.llm import bpe
from twinledger.llm.queries import op12_bpe
from tests.llm.conftest import write_tables

RANKS = bpe.read_ranks(bpe.VOCABULARY)
CODER = bpe.Coder(RANKS)


def merged(piece: bytes) -> list[int]:
    """Byte-pair merging of one match, lowest rank first."""
    if piece in RANKS:
        return [RANKS[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        ranked = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]
        if not ranked:
            return [RANKS[p] for p in parts]
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def brute(text: str) -> list[int]:
    # The pattern's \s is Unicode white space.
    pattern = bpe.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
    pattern = pattern.replace(r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
    return [i for m in regex.finditer(pattern, text) for i in merged(m.group().encode())]


PIECES = st.sampled_from(["a", "Bc", "don't", "'s", "'ll", "7", "42", " ", "  ", "\n", "\t", "\x1c", " ", "ß", "é", "日本", "😀", "!", "--", "'"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join), st.integers(1, 9))
def test_stretches_change_no_ids(text, size):
    assert "".join(bpe.stretches(text, size)) == text
    small = bpe.Coder.__new__(bpe.Coder)
    small._bpe, small._stretch = CODER._bpe, size
    ids = small.encode(text.encode())
    assert ids == brute(text)
    assert small.decode(ids) == text.encode()


def test_long_runs():
    for text in (" " * 1_000_000, "x" + "\n" * 300_000 + "y", "a  b" + " " * 5000 + "\t", " " * 4096 + "!", "ab" * 200_000):
        ids = CODER.encode(text.encode())
        assert CODER.decode(ids) == text.encode()
    for n in (4095, 4096, 4097, 9000):
        for text in (" " * n, "a" + " " * n + "b", " " * n + "\n!", "\n" * n + "x", "\t" * n + "'s"):
            assert CODER.encode(text.encode()) == CODER._bpe.encode_ordinary(text)


def test_bytes_that_are_not_utf8():
    for raw in (b"\xff", b"ab\xc3", b"\xe6\x97", b"ok \xff\xfe then", bytes(range(256))):
        assert CODER.decode(CODER.encode(raw)) == raw


def test_query_against_brute_force(spark, docs, rows, tmp_path):
    path = write_tables(spark, tmp_path, documents=docs)
    got = sorted(map(repr, (tuple(r) for r in op12_bpe(spark, path).collect())))
    want = []
    for doc_id, text, *_ in rows:
        ids = brute(text or "")
        joined = ",".join(map(str, ids)).encode()
        want.append(repr((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())))
    assert got == sorted(want)


def test_empty_and_clashing(spark, no_docs, clashing):
    assert bpe.encode(no_docs).count() == 0
    both = bpe.decode(bpe.encode(clashing.withColumnRenamed("key", "ids")))
    assert set(both.columns) == {*clashing.columns, "ids", "bytes"} - {"key"}
    assert both.filter("bytes != coalesce(cast(text as binary), X'')").count() == 0
