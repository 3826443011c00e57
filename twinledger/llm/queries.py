"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import (
    bpe, decontaminate, divergence, fingerprints, mixing, phrases, secret_scan, sharding, simhash, suffix_dedup, token_shards,
    toxicity, url_rules,
)
from twinledger.llm.common import table
from twinledger.session import materialize, scratch_dir


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.with_hits(docs, F.col("text"), table(spark, sf_dir, "benchmark"))
    found = F.col("_found")
    return rows.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(found["items"]), ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(found).alias("contaminated"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score_column(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ranges")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = materialize(mixing.sized_documents(table(spark, sf_dir, "documents")), "mix_sizes")
    return mixing.mix(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"), scratch_dir(spark, "token_shards"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2(F.col("base").cast("binary"), 256)).drop("base")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = sharding.record_columns(F.col("doc_id"), F.col("text"))
    records = materialize(docs.select("doc_id", *[c.alias(n) for n, c in columns.items()]), "records")
    placed = sharding.shard_records(records, ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_decontaminate, op2_simhash, op3_url_rules, op4_toxicity, op5_suffix_dedup, op6_mixing, op7_token_shards, op8_secrets,
        op9_fingerprints, op10_sharding, op11_phrases, op12_bpe, op13_divergence,
    )}


def llm_oracles() -> dict[str, str]:
    return {
        "op1_decontaminate": DECONTAMINATE_SQL,
        "op5_suffix_dedup": SUFFIX_DEDUP_SQL,
        "op11_phrases": PHRASES_SQL,
        "op13_divergence": DIVERGENCE_SQL,
    }


DECONTAMINATE_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), probe AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), place AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM probe) WHERE len(w) >= n)
), match AS (SELECT doc_id, i, place.n AS n, item_id FROM place JOIN probe ON place.k = probe.k AND place.n = probe.n
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM match) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM match WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN named ON doc.doc_id = named.doc_id
"""

# Hex text has two characters per byte, so byte strings are cut at odd places.
SUFFIX_DEDUP_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), place AS (
  SELECT r, doc_id, i, h[2 * i + 1:2 * i + 100] AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM doc)
), least AS (SELECT s, min(doc_id) AS d FROM place GROUP BY s
), cut AS (
  SELECT r, i, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) > 50 AS new
  FROM place JOIN least ON place.s = least.s WHERE least.d < coalesce(doc_id, 9223372036854775807)
), span AS (
  SELECT r, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT r, i, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g FROM cut) GROUP BY r, g
), part AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans,
    list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM span GROUP BY r
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(starts) + 1),
    lambda k: h[CASE WHEN k = 0 THEN 1 ELSE 2 * ends[k] + 1 END:CASE WHEN k = len(starts) THEN len(h) ELSE 2 * starts[k + 1] END]), '') END)) AS kept_sha256
FROM doc LEFT JOIN part ON doc.r = part.r
"""

# The list of words of a piece gives its phrases; every cut of a candidate looks its two parts up.
PHRASES_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), piece AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS p FROM doc)
), place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM place, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), cut AS (
  SELECT cand.lang, cand.phrase, cand.a, cand.k, c, x.a AS l, y.a AS r,
    CAST(cand.a AS HUGEINT) * cand.a * 1000000 // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand) AS cand
  JOIN f AS x ON x.lang = cand.lang AND x.k = c AND x.phrase = array_to_string(w[1:c], ' ')
  JOIN f AS y ON y.lang = cand.lang AND y.k = cand.k - c AND y.phrase = array_to_string(w[c + 1:cand.k], ' ')
), low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), longest AS (
  SELECT lang, part, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE k = 3) GROUP BY lang, part
), kept AS (
  SELECT low.* FROM low LEFT JOIN longest ON longest.lang = low.lang AND longest.part = low.phrase
  WHERE longest.a IS NULL OR 100 * longest.a < 50 * low.a
)
SELECT kept.lang, CAST(row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
  phrase, a, l, r, n.n AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""

# Every kept term stands beside every group of its language, so nothing needs correcting here.
DIVERGENCE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), found AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc
), kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), terms AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), tf AS (SELECT lang, source, term, count(*) AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (SELECT DISTINCT lang, source FROM doc
), cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c FROM groups AS g JOIN kept ON kept.lang = g.lang
  LEFT JOIN tf ON tf.lang = g.lang AND tf.source = g.source AND tf.term = kept.term
), p AS (
  SELECT cell.*, 1 + 1000000000 * (CAST(c AS HUGEINT) + 5) // (sum(c) OVER (PARTITION BY cell.lang, source) + 5 * v) AS p,
    1 + 1000000000 * (CAST(sum(c) OVER (PARTITION BY cell.lang, term) AS HUGEINT) + 5) // (sum(c) OVER (PARTITION BY cell.lang) + 5 * v) AS q
  FROM cell JOIN terms ON terms.lang = cell.lang
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE c > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 50
"""
