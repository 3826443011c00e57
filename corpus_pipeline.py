"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a
DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import decontaminate, mixing, sharding, simhash, toxicity
from twinledger.llm.common import packed, table
from twinledger.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the documents at hand."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: SimHash over three-word shingles, two bits apart at most."""
    return simhash.keep_one(docs, simhash.WORDS, simhash.RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold enough words of benchmark passages go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; ids repeat with their documents."""
    return mixing.mixed_documents(docs)


def put_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``shard`` and its place there, ``slot``."""
    columns = sharding.record_columns(F.col("_row.doc_id"), F.col("_row.text"))
    records = packed(docs).select("_row", *[c.alias(n) for n, c in columns.items()])
    placed = sharding.shard_records(records, ["_row.doc_id", "size", "text_crc32"])
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*kept, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", put_into_shards),
]

#: SQL can express neither the classifier nor the sketches.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, every one but the last written as a table and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
