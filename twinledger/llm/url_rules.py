"""URL filter by association rules.

Stated rules come first: the longest that fits a URL decides. The URLs that they decide are labelled
by them, and FP-growth mines which combinations of URL tokens go with a verdict. URLs without a label are
baskets without a verdict: they count against the confidence of what fits them, so a rule has to be right on most
of all URLs it fits and not only on those that happen to be labelled. Rules short of
support or confidence are pruned, and so is a rule that a shorter one equals in confidence, and one that does not
hold without any one of its hosts, unless it names its site. The
others form an inverted index: each stands under its rarest token, a URL looks its tokens up there, and
what it finds is tested for the rest of the rule. The most confident rule judges; without any, the URL
is allowed.

NULL urls and urls without ``://`` have an empty host and path, no tokens, and are allowed. URLs are judged
once each, however many pages share one: repeated rows get equal verdicts, and each keeps its row. Rules that tie in
confidence go by support, then by length and text. Empty tables give no rows. Whole URLs of any length are used. Other
columns pass through, but for ``host``, ``path``, ``rule``, ``verdict`` and ``mined_rule``, which are replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import lower_ascii
from twinledger.plans.joins import fits_broadcast
from twinledger.session import materialize

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
_VERDICT = "verdict:"
_SITE = "site:"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def stated_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; NULL if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in reversed(ordered):
        own = (host == rule_host) | host.endswith("." + rule_host)
        fits = own & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL: scheme, host labels, path segments, extension, query keys.

    Numbers in segments stand for any number.
    """
    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    labels = F.split(host, r"\.")
    segment = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, r"[0-9]+", "<n>"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda s: F.regexp_extract(s, "^([^=]*)", 1))
    scheme = F.array(lower_ascii(F.regexp_extract(url, "^([^:/?#]*)://", 1)))
    tail = F.when(F.size(labels) > 1, F.array(F.array_join(F.slice(labels, -2, 2), "."))).otherwise(F.array().cast("array<string>"))
    top = F.array(F.element_at(labels, -1))
    found = F.concat(
        tagged("scheme:", scheme), tagged("top:", top), tagged(_SITE, tail), tagged("label:", labels),
        tagged("path:", segment), tagged("query:", keys),
        F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    empty = F.array().cast("array<string>")
    return F.when(host == "", empty).otherwise(F.array_distinct(F.coalesce(found, empty)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules ``antecedent``, ``verdict``, ``confidence``, ``support`` from rows of ``tokens`` and ``verdict``.

    A row without a verdict counts as one that the rule gets wrong.
    """
    said = F.when(F.col("verdict").isNull(), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit(_VERDICT), "verdict"))
    )
    baskets = labelled.select(F.concat("tokens", said).alias("items"))
    baskets = materialize(baskets, "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.select(
        "antecedent", F.element_at("consequent", 1).alias("verdict"), "confidence", "support"
    ).filter(F.col("verdict").startswith(_VERDICT) & ~F.exists("antecedent", lambda x: x.startswith(_VERDICT)))
    rules = materialize(
        rules.withColumn("antecedent", F.sort_array("antecedent")).withColumn(
            "verdict", F.substring("verdict", len(_VERDICT) + 1, 100)
        ),
        "url_rules",
    )
    # Rules that are one token shorter, found by an equal join on the shortened antecedent.
    shorter = rules.withColumn("drop", F.explode("antecedent")).select(
        F.col("antecedent").alias("long"), "verdict", F.array_remove("antecedent", F.col("drop")).alias("antecedent")
    )
    better = shorter.join(
        rules.select("antecedent", "verdict", F.col("confidence").alias("shorter_confidence")), ["antecedent", "verdict"]
    ).groupBy("long", "verdict").agg(F.max("shorter_confidence").alias("best"))
    return (
        rules.join(better.withColumnRenamed("long", "antecedent"), ["antecedent", "verdict"], "left")
        .filter(F.col("best").isNull() | (F.col("confidence") > F.col("best")))
        .drop("best")
    )


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under its rarest token in ``urls``: ``token`` and the rule."""
    uses = rules.withColumn("rule_id", F.array_join("antecedent", " ")).withColumn("token", F.explode("antecedent"))
    wanted = uses.select("token").distinct()
    found = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    counted = uses.join(wanted.join(found, "token", "left"), "token")
    return counted.groupBy("rule_id", "verdict").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"),
        F.first("antecedent").alias("antecedent"), F.first("confidence").alias("confidence"), F.first("support").alias("support"),
    )


def fitting(urls: DataFrame, index: DataFrame) -> DataFrame:
    """Each URL with each rule of the index that fits it."""
    looked_up = urls.withColumn("token", F.explode("tokens"))
    # Past the measured size the index is shuffled instead, and a frequent token is split by the engine.
    index = F.broadcast(index) if fits_broadcast(index) else index
    return looked_up.join(index, "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0)


def hold_elsewhere(index: DataFrame, urls: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The rules that are confident without any one of their hosts, too, or that name their site.

    ``urls`` has ``tokens``, ``host`` and ``stated``. A rule that only one host bears out says nothing of others.
    """
    fits = fitting(urls.select("tokens", "host", "stated"), index.select("rule_id", "verdict", "token", "antecedent"))
    per_host = fits.groupBy("rule_id", "verdict", "host").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("stated") == F.col("verdict"), 1)).alias("right")
    )
    per_host = materialize(per_host, "rule_hosts")
    whole = per_host.groupBy("rule_id", "verdict").agg(F.sum("n").alias("all_n"), F.sum("right").alias("all_right"))
    others_n, others_right = F.col("all_n") - F.col("n"), F.col("all_right") - F.col("right")
    # 0 of 0 is not confident: the only host of a rule leaves nothing to hold it.
    least = F.min(F.when(others_n > 0, others_right / others_n).otherwise(0.0))
    checked = per_host.join(whole, ["rule_id", "verdict"]).groupBy("rule_id", "verdict").agg(least.alias("elsewhere"))
    names_site = F.exists("antecedent", lambda x: x.startswith(_SITE))
    return index.join(checked, ["rule_id", "verdict"]).filter(names_site | (F.col("elsewhere") >= min_confidence))


def judge(pages: DataFrame, rules: tuple = RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and the mined rule that judged, ``mined_rule``."""
    host, path = url_parts(F.col("url"))
    name, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    urls = (
        pages.select("url").filter("url IS NOT NULL").distinct().withColumn("host", host).withColumn("path", path)
        .withColumn("stated", verdict)
        .withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    )
    urls = materialize(urls.select("url", "stated", "tokens", "host"), "urls")
    mined = mine(urls.select("tokens", F.col("stated").alias("verdict")), min_support, min_confidence)
    index = materialize(rule_index(mined, urls), "rule_index")
    index = materialize(hold_elsewhere(index, urls, min_confidence), "checked_index")
    matched = fitting(urls.filter("stated IS NULL").select("url", "tokens"), index)
    rank = F.struct("confidence", "support", F.size("antecedent"), "rule_id", "verdict")
    judged = matched.groupBy("url").agg(
        F.max_by(F.struct(F.col("verdict").alias("v"), F.col("rule_id").alias("r")), rank).alias("best")
    )
    return (
        pages.join(judged, "url", "left").withColumn("host", host).withColumn("path", path)
        .withColumn("rule", name)
        .withColumn("verdict", F.coalesce(verdict, F.col("best.v"), F.lit(DEFAULT)))
        .withColumn("mined_rule", F.when(verdict.isNull(), F.col("best.r")))
        .drop("best")
    )
