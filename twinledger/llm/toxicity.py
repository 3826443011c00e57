"""Toxicity by weak supervision.

Many voters look at a text: a lexicon of insults, patterns, and words and word beginnings that the
learning rows show to go with toxic texts. A generative model of the votes, fitted by expectation
maximisation, estimates how often each voter fires on either class; the given label is one more
voter with an accuracy to be estimated, so that wrong labels lose their say. Voters that fire together beyond what
the class explains are taken as correlated, and share their weight; the given label keeps its own. The model's posteriors are
the labels on which a linear classifier is trained, whose output is the score.

Learning uses a sample of ``SAMPLE_ROWS`` labelled rows at most, those with the smallest hash of their
id; held-out rows (``crc32(id) mod 5 = 0``) are never among them, and neither are rows without an
id or a label. Statistics of words are aggregated on the executors; the driver sees every voter that passes
the test and one list of votes per learning row, as packed numbers. Nothing there is as large as rows times
voters or voters times voters. Scoring reads every whole text.

NULL and empty texts have no votes and get the score of a text on which nothing fires. Without any
learning rows only the lexicon and the patterns vote. Repeated labels of an id count once, the highest.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import packed, unpacked
from twinledger.session import materialize

SAMPLE_ROWS = 10_000
FOLDS = 5
BEGINNINGS = (4, 5, 6, 7)
MOST_REPEATS = 3
LEXICON = (
    "clown creep disgusting dumb fool garbage hateful idiot imbecile jerk loathsome loser moron pathetic "
    "pig scum stupid trash vermin worthless"
).split()
PATTERNS = {
    "you are a": r"\byou(?:'re| are) (?:a|an|such|so)\b",
    "shut up": r"\bshut (?:up|it)\b",
    "threat": r"\b(?:kill|hurt|beat) (?:you|yourself|them|him|her)\b",
    "get lost": r"\b(?:get lost|go away|go to hell)\b",
    "masked word": r"\b[a-z]\*{2,}[a-z]*\b",
    "many marks": r"!{3,}",
}
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = [(f"/{name}", re.compile(p, re.IGNORECASE)) for name, p in PATTERNS.items()]


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a row without an id is one of them."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(True))


def signals(text: str | None) -> list[str]:
    """The voters that fire on a text: words, ``/name`` for patterns, and beginnings of words,
    ``abcd-``, ``abcd--`` and ``abcd---`` for one, two and three different words that begin so."""
    text = text or ""
    words = set(_WORD.findall(text.lower()))
    fired = {name for name, pattern in _PATTERNS if pattern.search(text)}
    for n in BEGINNINGS:
        for head, times in Counter(w[:n] for w in words if len(w) >= n).items():
            fired.update(head + "-" * k for k in range(1, min(times, MOST_REPEATS) + 1))
    return sorted(fired | words)


class Voters:
    """Chosen voters by number, arranged for looking them up."""

    def __init__(self, names: list[str]):
        self.number = {name: i for i, name in enumerate(names)}
        self.patterns = [(self.number[n], p) for n, p in _PATTERNS if n in self.number]
        self.heads: dict[str, list[tuple[int, int]]] = {}
        for name, i in self.number.items():
            if name.endswith("-"):
                self.heads.setdefault(name.rstrip("-"), []).append((name.count("-"), i))

    def fired(self, text: str | None) -> list[int]:
        text = text or ""
        words = set(_WORD.findall(text.lower()))
        found = [i for i, p in self.patterns if p.search(text)]
        found += [i for i in map(self.number.get, words) if i is not None]
        heads = self.heads
        for n in BEGINNINGS:
            for head, times in Counter(h for h in (w[:n] for w in words if len(w) >= n) if h in heads).items():
                found += [i for need, i in heads[head] if times >= need]
        return found


class Votes:
    """A matrix of votes (rows x voters) by the places where it is not zero."""

    def __init__(self, rows: list[np.ndarray], size: int):
        self.lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        self.columns = np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32)
        self.index = np.repeat(np.arange(len(rows), dtype=np.int32), self.lengths)
        self.shape = (len(rows), size)

    @staticmethod
    def of(votes: np.ndarray | Votes) -> Votes:
        return votes if isinstance(votes, Votes) else Votes([np.flatnonzero(r) for r in votes], votes.shape[1])

    def by_voter(self, mass: np.ndarray) -> np.ndarray:
        """For each voter the sum of ``mass`` over the rows where it fires."""
        return np.bincount(self.columns, mass[self.index], self.shape[1])

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """For each row the sum of ``values`` over the voters that fire."""
        return np.bincount(self.index, values[self.columns], self.shape[0])


@dataclass
class LabelModel:
    """Rates at which each voter fires, by class, and how much each voter's vote weighs."""

    prior: float
    fires: np.ndarray  # voters x 2
    weights: np.ndarray

    def posterior(self, votes: np.ndarray | Votes) -> np.ndarray:
        on, off = np.log(self.fires), np.log1p(-self.fires)
        ratio = (on[:, 1] - on[:, 0] - off[:, 1] + off[:, 0]) * self.weights
        base = np.log(self.prior / (1 - self.prior)) + ((off[:, 1] - off[:, 0]) * self.weights).sum()
        return 1 / (1 + np.exp(-np.clip(Votes.of(votes).by_row(ratio) + base, -30, 30)))


def fit_label_model(
    votes: np.ndarray | Votes, start: np.ndarray, rounds: int = 15, given: int | None = None
) -> LabelModel:
    """Expectation maximisation over a matrix of votes (rows x voters), from posteriors ``start``.

    The voter ``given`` is the label. It is not made from the text, so it shares its weight with none:
    else thousands of correlated words outvote it and the classes come to mean something other than toxicity."""
    votes = Votes.of(votes)
    p = start
    weights = np.ones(votes.shape[1])
    for turn in range(rounds):
        fires = np.stack([(votes.by_voter(mass) + 0.1) / (mass.sum() + 1.0) for mass in (1 - p, p)], 1)
        fires = np.clip(fires, 1e-4, 1 - 1e-4)
        if turn in (1, rounds // 2):
            weights = _shares(votes, fires, p)
            if given is not None:
                weights[given] = 1.0
        model = LabelModel(float(np.clip(p.mean(), 0.01, 0.99)), fires, weights)
        p = model.posterior(votes)
    return model


def _shares(votes: Votes, fires: np.ndarray, p: np.ndarray, cells: int = 1 << 21) -> np.ndarray:
    """One over the number of voters that each voter's vote amounts to, from residual correlations.

    A residual is a vote less its expectation, and expectations have rank two, so the products of residuals
    are the counts of voters that fire together less products of vectors. They are made for ``cells``
    pairs of voters at a time.
    """
    size = votes.shape[1]
    (r0, r1), c0, c1 = fires.T, votes.by_voter(1 - p), votes.by_voter(p)
    q00, q01, q11 = ((1 - p) ** 2).sum(), (p * (1 - p)).sum(), (p**2).sum()
    # Of products: - c r' - r c' + r q r', as left @ right'.
    left = np.stack([q00 * r0 + q01 * r1 - c0, q01 * r0 + q11 * r1 - c1, -r0, -r1], 1)
    right = np.stack([r0, r1, c0, c1], 1)
    together = votes.by_voter(np.ones(votes.shape[0]))
    scale = np.sqrt((together + (left * right).sum(1)).clip(0)) + 1e-6
    ends = np.cumsum(votes.lengths)
    starts = ends - votes.lengths
    order = np.argsort(votes.columns, kind="stable")
    firsts = np.concatenate([[0], np.cumsum(together.astype(np.int64))])
    total = np.zeros(size)
    step = max(1, cells // max(size, 1))
    for at in range(0, size, step):
        block = min(step, size - at)
        products = left[at : at + block] @ right.T
        for i in range(block):
            rows = votes.index[order[firsts[at + i] : firsts[at + i + 1]]]
            for k in range(0, len(rows), 1000):
                fired = [votes.columns[starts[r] : ends[r]] for r in rows[k : k + 1000].tolist()]
                products[i] += np.bincount(np.concatenate(fired), minlength=size)
        products /= scale
        products /= scale[at : at + block, None]
        products[products <= 0.2] = 0
        total[at : at + block] = products.sum(1)
    return 1 / total.clip(1.0)


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    bias: float


def train_classifier(rows: list[np.ndarray], targets: np.ndarray, size: int, ridge: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on probabilities by Adam; rows are lists of the voters that fired."""
    votes = Votes(rows, size)
    index, column = votes.index, votes.columns
    w, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(index, w[column], len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets) / max(1, len(rows))
        gradient = np.append(np.bincount(column, error[index], size), error.sum())
        gradient[:-1] += ridge / max(1, len(rows)) ** 0.5 * w[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    # Bounded by sample_rows, so it is broadcast and the texts are not shuffled.
    chosen = (
        known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = materialize(texts.select("doc_id", "toxic", "text"), "learning_rows")
    voters = Voters(sorted({*LEXICON, *(n for n, _ in _PATTERNS), *_mined(rows)}))
    number = F.udf(lambda text: np.array(voters.fired(text), np.int32).tobytes(), T.BinaryType())
    # An id that stands for several documents would break the bound on what is collected.
    seen = rows.select("doc_id", "toxic", number("text").alias("v")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    votes = [(np.frombuffer(bytes(r.v), np.int32), float(r.toxic)) for r in seen.collect()]
    return _learn(votes, voters)


def _mined(rows: DataFrame) -> list[str]:
    """Words and beginnings that go with toxic rows: a likelihood ratio test that allows for how
    many are tried."""
    toxic, total = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if not toxic or toxic == total:
        return []
    fire = F.udf(signals, T.ArrayType(T.StringType()))
    counts = (
        rows.select("toxic", F.explode(fire("text")).alias("s"))
        .groupBy("s")
        .agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
        .filter("n >= 3")
    )
    counts = materialize(counts, "word_counts")
    tried = counts.count()
    rate = toxic / total

    def part(k: Column, n: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)

    inside, p = F.col("a") / F.col("n"), F.lit(rate)
    g2 = 2 * (part(F.col("a"), F.col("n"), p) + part(F.col("n") - F.col("a"), F.col("n"), 1 - p))
    strong = counts.filter((inside > min(0.5, 2 * rate)) & (g2 > 2 * float(np.log(max(tried, 2)))))
    return [r.s for r in strong.select("s").collect()]


def _learn(rows: list[tuple[np.ndarray, float]], voters: Voters) -> Model:
    lexicon = [voters.number[s] for s in LEXICON]
    if not rows:
        weights = np.zeros(len(voters.number))
        weights[lexicon] = 4.0
        return Model(voters, weights, -3.0)
    size = len(voters.number)
    label = np.array([x for _, x in rows])
    given = np.array([size], np.int32)  # the label is the last voter
    every = [np.concatenate([v, given]) if x else v for v, x in rows]
    support = np.bincount(np.concatenate(every), minlength=size + 1)
    place = np.cumsum(support >= 3) - 1  # what hardly ever fires tells the model nothing
    votes = Votes([place[v[support[v] >= 3]] for v in every], int(place[-1]) + 1)
    known = int(place[size]) if support[size] >= 3 else None
    targets = fit_label_model(votes, 0.05 + 0.9 * label, given=known).posterior(votes)
    # A lexicon word that the rows do not show is taken at its word: a few made-up rows.
    unseen = [j for j in lexicon if support[j] < 3]
    lists = [v for v, _ in rows] + [np.array([j]) for j in unseen]
    weights, bias = train_classifier(lists, np.append(targets, np.full(len(unseen), 0.9)), size)
    return Model(voters, weights, bias)


def score_column(text: Column, model: Model) -> Column:
    """The probability that a text is toxic."""
    voters, weights, bias = model.voters, model.weights, model.bias

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        z = np.array([weights[voters.fired(t)].sum() + bias for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))), dtype="float64")

    return score(text)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    rows = packed(docs).withColumn("_score", score_column(F.col("_row.text"), model))
    return unpacked(rows.filter(F.col("_score") < threshold))
