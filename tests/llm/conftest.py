from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(["ba", "do", "ki", "lu", "me", "na", "po", "ri", "su", "te"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def document_rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts with copies, near copies, shared passages, and what usually breaks things."""
    rng = random.Random(seed)
    line = sentence(rng, 25)
    texts = [sentence(rng, rng.choice([1, 2, 4, 30, 80, 200])) for _ in range(n)]
    texts += [texts[3], texts[4], texts[5], texts[5]]
    texts += [texts[5] + " extra", line, line + " " + texts[6], texts[7][:40] + line + texts[8][-60:]]
    texts += [None, "", None, "   ", "Ünï çödé wörds " * 8, "aaaa " * 60, "x" * 500, "A B C", "\x00\t\n", sentence(rng, 4000)]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows.append((None, texts[9], None, None, None))
    rows.append((None, None, None, "s1", 3))
    rows.append(rows[10])  # a repeated row
    return rows


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Documents with extra columns named like the operators' own helpers."""
    from pyspark.sql import functions as F

    names = ["_row", "_key", "fp", "u", "skey", "size", "z", "room", "copies", "_copy", "_found", "_score", "score",
             "virtual_slot", "text_crc32", "component", "uid", "key", "item_id", "toxic"]
    return docs.select("*", *[F.lit(n).alias(n) for n in names])


def write_tables(spark, path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
