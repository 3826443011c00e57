"""Secret scan: stated patterns, and a linear-chain conditional random field over every token.

The patterns' spans always stay. The field tags each token of a text, words and single signs alike, as begin,
inside or outside of a secret, from the token's shape, the tokens beside it, whether a word such as ``password`` stands before it with
signs only in between, and traits of the whole text. Viterbi is over whole texts. Before it runs, tokens that no best
path can tag as secret are told apart by a bound, which is exact: most of a text never enters its loop.

The field learns from windows of text: around the values that the patterns found, and elsewhere, ``LEARN_WINDOWS`` and
``LEARN_PLAIN`` at most, those with the smallest hash, from texts of any length. A value of over ``LONGEST_VALUE`` characters shows
nothing and is left out of learning. Each window with a value is shown once more as if no keyword stood before it. ``LEARN_WINDOWS`` of the
others are shown once more with a made-up secret put in (joined words, words with digits and signs, random
letters, quoted phrases) and once more with a keyword before an ordinary word, so that neither keyword nor
shape decides alone.

NULL is the empty text. Empty tables give no rows; without a single pattern span nothing is learned or added. Repeated rows
and ids are each answered. Other columns are not looked at, whatever their names. Ties in the sample go by the window's text,
ties between paths to the smaller tag.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEARN_WINDOWS = 600  # with a value; of those without one LEARN_PLAIN
LEARN_PLAIN = 2_000
LONGEST_CHAIN = 48  # while learning
CAUTION = 3.0
LONGEST_VALUE = 4096
AROUND = 96
KINDS = ("assign", "access", "hex")
SPACE = 1 << 14
MOST_TYPES = 400_000  # distinct tokens a task remembers before it starts anew

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"\s?(?:\w+|[^\w\s])")
_KEYWORD = re.compile(r"(?:pass|pwd|secret|token|api_?key|key|auth|cred)[a-z_]*$", re.IGNORECASE | re.ASCII)
_OUT, _BEGIN, _IN = 0, 1, 2


_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_THIRDS = re.compile(r"[0-9a-f]{8}")


def pattern_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value), by start and kind.

    A pattern runs only where it can match: an assignment needs its word, and of 24 hex digits in a row every third is one too.
    """
    found = []
    lowered = text.lower()  # ASCII letters keep to themselves, so no word is lost
    if any(word in lowered for word in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _HEX_THIRDS.search(text[::3]):
        found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


# --- Tokens and features ------------------------------------------------------------------------


def tokens_of(text: str) -> list[str]:
    """Runs of letters and digits, and single signs, each with a blank in front if there is one."""
    return _TOKEN.findall(text)


def places_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens start and end, without blanks."""
    found = [(m.end() - len(m.group().lstrip()), m.end()) for m in _TOKEN.finditer(text)]
    places = np.array(found, np.int64).reshape(-1, 2)
    return places[:, 0], places[:, 1]


def _bucket(n: int) -> int:
    return min(n.bit_length() * 2 + (n > 1 and n >> (n.bit_length() - 2) & 1), 20)


def _number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % SPACE


_DIGIT, _HEX_ONLY = re.compile(r"\d"), re.compile(r"[0-9a-f]+")
_TURN = re.compile(r"(?<=\d)(?=\D)|(?<=\D)(?=\d)|(?<=[a-z])(?=[A-Z])")
_NO_VOWELS = dict.fromkeys(map(ord, "aeiouáéíóúàèùâêîôûäöü"))


def _signs(word: str) -> str:
    if not (word[0].isalnum() or word[0] == "_"):
        return word
    lower, upper = word != word.upper(), word != word.lower()
    case = "Aa" if lower and upper and word == word.capitalize() else "m" if lower and upper else "A" if upper else "a" if lower else ""
    digit, hexes = bool(_DIGIT.search(word)), bool(_HEX_ONLY.fullmatch(word))
    return f"{case}{'d' if digit else ''}{'h' if hexes else ''}{'_' if '_' in word else ''}{'' if word.isascii() else 'u'}"


OWN, SIDE, BEHIND, KEYED = 8, 2, 3, 2
FEATURES = OWN + SIDE + BEHIND + KEYED + 1


def shape_of(token: str) -> tuple[str, int, int, int, bool]:
    """Signs, size, turns, share of vowels, and whether no blank stands in front. Few shapes cover most tokens."""
    word = token.lstrip()
    if word.isalpha() and word.isascii() and (word.islower() or len(word) > 1 and word[1:].islower()):
        # The common case by plain tests: no digit, no underscore and no turn.
        vowels = sum(map(word.count, "aeiouAEIOU"))
        signs = "Aa" if word[0] < "a" else "a" if word.strip("abcdef") else "ah"
        return signs, _bucket(len(word)), 0, 5 * vowels // len(word), len(word) == len(token)
    lowered = word.lower()
    vowels = 5 * (len(lowered) - len(lowered.translate(_NO_VOWELS))) // len(lowered)
    return _signs(word), _bucket(len(word)), _bucket(len(_TURN.findall(word))), vowels, len(word) == len(token)


def shape_features(shape: tuple[str, int, int, int, bool]) -> list[int]:
    """Numbers of a shape's features: as itself, as the one before, as the one behind, and behind a keyword."""
    signs, size, turns, vowels, glued = shape
    names = [
        f"signs {signs}", f"size {size}", f"shape {signs} {size}", f"turns {turns}", f"turns of size {size} {turns}",
        f"vowels {signs} {vowels}", f"glued {glued}", f"before signs {signs}", f"behind signs {signs}",
        f"behind glued {glued}", f"keyed {signs}", f"keyed turns {signs} {turns}",
    ]
    return [_number(n) for n in names]


# The sum of a name goes on from that of its first word.
_IS, _BEFORE, _BEHIND = map(zlib.crc32, (b"is ", b"before ", b"behind "))


def word_features(token: str) -> tuple[int, int, int]:
    """Numbers of the word itself, as the one before and as the one behind."""
    known = token.lstrip()[:24].lower().encode("utf-8", "surrogatepass")
    return zlib.crc32(known, _IS) % SPACE, zlib.crc32(known, _BEFORE) % SPACE, zlib.crc32(known, _BEHIND) % SPACE


def type_features(token: str) -> list[int]:
    """All features of a token, part by part."""
    shape, (itself, before, behind) = shape_features(shape_of(token)), word_features(token)
    return [itself, *shape[:7], before, shape[7], behind, *shape[8:]]


_EDGE = [_number("edge before")] * SIDE, [_number("edge behind")] * BEHIND
_UNKEYED = [_number("no keyword"), _number("no keyword signs")]
_PARTS = np.cumsum([0, OWN, SIDE, BEHIND])


def traits_of(text: str, words: int) -> int:
    marks = sum(text.count(c) for c in "=:{};")
    return _number(f"file {_bucket(1000 * marks // max(1, len(text)))} {_bucket(words) // 4}")


def keyed_places(words: list[str], is_key: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    """Tokens with a keyword before them and signs only in between."""
    at = np.arange(len(words))
    last_word = np.maximum.accumulate(np.where(is_word, at, -1))
    before = np.concatenate([[-1], last_word[:-1]])
    return (before >= 0) & is_key[before]


def kind_of(token: str) -> tuple[bool, bool]:
    """Whether a token is a keyword, and whether it is a word."""
    word = token.lstrip()
    return _KEYWORD.fullmatch(word) is not None, word[0].isalnum() or word[0] == "_"


def chain_features(text: str) -> np.ndarray:
    """The feature numbers of every token of a text."""
    words = tokens_of(text)
    if not words:
        return np.zeros((0, FEATURES), np.int64)
    types = np.array([type_features(w) for w in words], np.int64)
    own, before, behind, keyed = np.split(types, _PARTS[1:], axis=1)
    kinds = np.array([kind_of(w) for w in words], bool)
    columns = [
        own,
        np.concatenate([[_EDGE[0]], before[:-1]]),
        np.concatenate([behind[1:], [_EDGE[1]]]),
        np.where(keyed_places(words, kinds[:, 0], kinds[:, 1])[:, None], keyed, _UNKEYED),
        np.full((len(words), 1), traits_of(text, len(words))),
    ]
    return np.concatenate(columns, 1)


class Field:
    """A linear-chain conditional random field over three tags."""

    def __init__(self) -> None:
        self.emit = np.zeros((SPACE, 3))
        self.move = np.zeros((3, 3))
        self.start = np.zeros(3)

    def fit(self, chains: list[np.ndarray], steps: int = 120) -> Field:
        """Maximum likelihood by Adam, all chains at once; chains are arrays of label and features."""
        size, longest = len(chains), max(map(len, chains))
        features = np.zeros((size, longest, FEATURES), np.int64)
        labels = np.zeros((size, longest), np.int64)
        valid = np.zeros((size, longest), bool)
        for i, chain in enumerate(chains):
            labels[i, : len(chain)], features[i, : len(chain)] = chain[:, 0], chain[:, 1:]
            valid[i, : len(chain)] = True
        gold = np.eye(3)[labels] * valid[:, :, None]
        weights = [self.emit, self.move, self.start]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        for step in range(1, steps + 1):
            scores = self.emit[features].sum(2)
            node, edge = self._marginals(scores, valid)
            rest = (node - gold) / size
            emit = np.stack(
                [np.bincount(features[valid].ravel(), np.repeat(rest[valid][:, y], FEATURES), SPACE) for y in range(3)], 1
            )
            both = valid[:, 1:] & valid[:, :-1]
            move = (edge - np.einsum("nti,ntj->ij", gold[:, :-1] * both[:, :, None], gold[:, 1:])) / size
            gradients = [emit + 1e-5 * self.emit, move, rest[:, 0].sum(0)]
            for w, g, (m, v) in zip(weights, gradients, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def _marginals(self, scores: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of tags, and the expected number of each move, by forward and backward sums."""
        size, longest, _ = scores.shape

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis, keepdims=True)
            return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)

        ahead = np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + self.start
        for t in range(1, longest):
            step = total(ahead[:, t - 1, :, None] + self.move, 1) + scores[:, t]
            ahead[:, t] = np.where(valid[:, t, None], step, ahead[:, t - 1])
        back = np.zeros_like(scores)
        edge = np.zeros((3, 3))
        z = total(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            onward = self.move + (scores[:, t + 1] + back[:, t + 1])[:, None, :]
            back[:, t] = np.where(valid[:, t + 1, None], total(onward, 2), 0.0)
            p = np.exp(ahead[:, t, :, None] + onward - z[:, None, None]) * valid[:, t + 1, None, None]
            edge += p.sum(0)
        return np.exp(ahead + back - z[:, None, None]) * valid[:, :, None], edge

    def uncertain(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that some best path may tag as begin or inside; all others are outside on every best path.

        A run of tagged tokens gains at most the sum of its tokens' gains, each with the best move into it, and the best
        move out, over leaving the run outside. Where no run over a token can gain, it is outside.
        """
        stay = self.move[_OUT, _OUT]
        into = max(self.move[:, 1:].max() - stay, self.start[1:].max() - self.start[_OUT])
        gains = scores[:, 1:].max(1) - scores[:, _OUT] + into
        out = self.move[1:, _OUT].max() - stay
        sums = np.concatenate([[0.0], np.cumsum(gains)])
        if gains.max() + max(out, 0.0) < -1e-6:
            return np.zeros(len(scores), bool)
        best_end = np.maximum.accumulate(sums[:0:-1])[::-1]
        best_start = np.minimum.accumulate(sums[:-1])
        return best_end - best_start + max(out, 0.0) > -1e-6

    def tags(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of a chain, by Viterbi, from its tokens' scores per tag."""
        path = np.zeros(len(scores), np.int64)
        open_ = np.flatnonzero(self.uncertain(scores)) if len(scores) else []
        if not len(open_):
            return path
        (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = self.move.tolist()
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            first, last = int(run[0]), int(run[-1])
            o, b, i = (scores[first] + (self.move[_OUT] if first else self.start)).tolist()
            came = []
            for so, sb, si in scores[first + 1 : last + 1].tolist():
                to_o = max((o + oo, 0), (b + bo, -1), (i + io, -2))
                to_b = max((o + ob, 0), (b + bb, -1), (i + ib, -2))
                to_i = max((o + oi, 0), (b + bi, -1), (i + ii, -2))
                came.append((-to_o[1], -to_b[1], -to_i[1]))
                o, b, i = to_o[0] + so, to_b[0] + sb, to_i[0] + si
            if last + 1 < len(scores):
                o, b, i = o + oo, b + bo, i + io
            tag = (o, b, i).index(max(o, b, i))
            path[last] = tag
            for at in range(last - 1, first - 1, -1):
                tag = came[at - first][tag]
                path[at] = tag
        return path


# --- Learning -----------------------------------------------------------------------------------


def windows_of(text: str, spans: list[tuple[int, int, int, int]]) -> list[tuple[str, str]]:
    """A window around each value, and one at a place that the text's hash picks, with the values in them as ``start:end``."""
    values = [(value, end) for _, _, end, value in spans if end - value <= LONGEST_VALUE]
    middle = zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(text))
    found = []
    for lo, hi in [*values, (middle, middle)]:
        lo, hi = max(0, lo - AROUND), min(len(text), hi + AROUND)
        # A window begins and ends between words.
        cut = re.search(r"\s", text[lo : lo + AROUND]) if lo else None
        lo = lo + cut.end() if cut and not any(a < lo + cut.end() and lo < b for a, b in values) else lo
        inside = sorted({(a - lo, b - lo) for a, b in values if lo <= a and b <= hi})
        found.append((text[lo:hi], ",".join(f"{a}:{b}" for a, b in inside)))
    return found


def windows_column(text: Column) -> Column:
    @F.pandas_udf("array<struct<window: string, at: string>>")
    def windows(texts: pd.Series) -> pd.Series:
        rows = [windows_of(t or "", pattern_spans(t or "")) for t in texts]
        return pd.Series([[{"window": w, "at": a} for w, a in row] for row in rows], dtype=object)

    return windows(text)


_JOINERS = (" ", ": ", " = ", "=", ': "', "='")
_KEYWORDS = ("password", "passwd", "pwd", "pass", "secret", "token", "api_key", "apikey", "passphrase", "credentials", "auth")
_MARKS = "!@#$%^&*-_+?"


def made_up_secret(rng: random.Random, words: list[str]) -> tuple[str, str, str]:
    """What stands before a made-up secret, the secret, and what stands behind."""

    def word() -> str:
        return rng.choice(words)

    def drawn(letters: str, low: int, high: int) -> str:
        return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    swaps = str.maketrans({"a": "4", "e": "3", "i": "1", "o": "0", "s": "5"})
    kind = rng.randrange(7)
    secret = (
        word().capitalize() + word().capitalize() + (word().capitalize() if rng.random() < 0.3 else ""),
        word().capitalize().translate(swaps) + rng.choice(_MARKS) + drawn("0123456789" + _MARKS, 1, 4) + word(),
        word() + drawn("0123456789", 1, 4) + drawn(_MARKS, 1, 6) + (word() if rng.random() < 0.5 else ""),
        drawn(mixed, 10, 32),
        drawn(mixed + "+/", 20, 44) + rng.choice(("", "=", "==")),
        drawn("0123456789abcdef", 16, 40),
        " ".join(word().lower() for _ in range(rng.randint(3, 6))),
    )[kind]
    if kind == 6:  # ordinary words are a secret only if keyword and quotes say so
        return rng.choice(_KEYWORDS) + rng.choice((': "', ' = "')), secret, '"'
    if kind == 0 or rng.random() < 0.7:
        joiner = rng.choice(_JOINERS)
        return rng.choice(_KEYWORDS) + joiner, secret, joiner[-1] if joiner[-1] in "\"'" else ""
    return "", secret, ""


def _labels(starts: np.ndarray, ends: np.ndarray, values: list[tuple[int, int]]) -> np.ndarray:
    labels = np.zeros(len(starts), np.int64)
    for a, b in values:
        inside = np.flatnonzero((starts < b) & (ends > a))
        labels[inside] = _IN
        labels[inside[:1]] = _BEGIN
    return labels


def without_keyword(text: str, values: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """A window whose first value stands there bare: keyword, sign and quotes are gone."""
    start, end = values[0]
    front = re.sub(r"""\S*\s*[:=]\s*["']?$""", "", text[:start])
    back = text[end + (text[end : end + 1] in ("'", '"')) :]
    moved = len(front) + end - start - (len(text) - len(back))
    return front + text[start:end] + back, [(len(front), len(front) + end - start), *((a + moved, b + moved) for a, b in values[1:])]


def training_chains(windows: list[tuple[str, list[tuple[int, int]]]]) -> list[np.ndarray]:
    """Chains of label and features: the windows as they are, and changed as the module says."""
    rng = random.Random(0)
    plain = [w for w, values in windows if not values]
    words = sorted({w for text in plain for w in map(str.lstrip, tokens_of(text)) if w.isalpha() and 3 <= len(w) <= 12}) or ["word"]
    shown = [*windows, *(without_keyword(text, values) for text, values in windows if values)]
    for text in plain[:LEARN_WINDOWS]:
        gaps = [m.start() for m in re.finditer(r" ", text)] or [len(text)]
        cut = rng.choice(gaps)
        before, secret, behind = made_up_secret(rng, words)
        front = f"{text[:cut]} {before}"
        shown.append((f"{front}{secret}{behind}{text[cut:]}", [(len(front), len(front) + len(secret))]))
        cut = rng.choice(gaps)
        shown.append((f"{text[:cut]} {rng.choice(_KEYWORDS)}{rng.choice(('', ':', ' is'))}{text[cut:]}", []))
    chains = []
    for text, values in shown:
        chains.append(np.concatenate([_labels(*places_of(text), values)[:, None], chain_features(text)], 1))
    return [c[i : i + LONGEST_CHAIN] for c in chains for i in range(0, len(c), LONGEST_CHAIN)]


def sample_windows(docs: DataFrame) -> DataFrame:
    """A bounded sample of windows, those of either kind with the smallest hash of their text.

    Both kinds are ranked in one pass over the texts; Spark limits each to its first before the shuffle.
    """
    every = docs.select(F.explode(windows_column(F.col("text"))).alias("w")).select("w.*")
    ranked = every.withColumn("plain", F.col("at") == "").withColumn("hash", F.xxhash64("window"))
    order = Window.partitionBy("plain").orderBy("hash", "window", "at")
    first = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(LEARN_PLAIN, LEARN_WINDOWS))
    return first.filter(F.col("rank") <= F.when(F.col("plain"), LEARN_PLAIN).otherwise(LEARN_WINDOWS))


def learn(docs: DataFrame) -> Field | None:
    """Fit the field on a sample of windows."""
    # A bounded number of windows of bounded length.
    rows = sorted(sample_windows(docs).collect(), key=lambda r: (r.plain, r.rank))
    windows = [(r.window, [tuple(map(int, v.split(":"))) for v in r["at"].split(",") if v]) for r in rows]
    if not any(values for _, values in windows):
        return None
    return Field().fit(training_chains(windows))


# --- Tagging ------------------------------------------------------------------------------------


class _Places(dict):
    """A place for every token, given when it is first asked for."""

    def __missing__(self, token: str) -> int:
        place = self[token] = len(self)
        return place


class Tagger:
    """Scores of tokens under a field; what a distinct token adds is worked out once.

    ``caution`` is added to the score of outside, so that a doubtful token stays outside.
    """

    def __init__(self, field: Field, caution: float = CAUTION) -> None:
        self.field, self.caution = field, caution
        self.edges = field.emit[_EDGE[0]].sum(0), field.emit[_EDGE[1]].sum(0)
        self.unkeyed = field.emit[_UNKEYED].sum(0)
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.shapes: dict[tuple, int] = {}
        self.sums: list[np.ndarray] = []
        self.parts = [np.zeros((1024, 3)) for _ in range(4)]
        self.kinds = np.zeros((1024, 2), bool)

    def _learn_types(self, new: list[str]) -> None:
        """Take in tokens that were not met before, the last to get their places."""
        last = len(self.places)
        first = last - len(new)
        while last > len(self.kinds):
            self.parts = [np.concatenate([part, np.zeros_like(part)]) for part in self.parts]
            self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        shapes = []
        for shape in map(shape_of, new):
            at = self.shapes.get(shape)
            if at is None:
                at = self.shapes[shape] = len(self.sums)
                self.sums.append(np.add.reduceat(self.field.emit[shape_features(shape)], (0, 7, 8, 10)))
            shapes.append(at)
        known = sorted(set(shapes))
        summed = np.array([self.sums[at] for at in known])[np.searchsorted(known, shapes)]
        words = self.field.emit[np.array([word_features(t) for t in new])]
        for part in range(4):
            self.parts[part][first:last] = summed[:, part] + (words[:, part] if part < 3 else 0)
        self.kinds[first:last] = [kind_of(t) for t in new]

    def scores(self, text: str) -> np.ndarray:
        """Scores per tag of every token."""
        words = tokens_of(text)
        if not words:
            return np.zeros((0, 3))
        if len(self.places) > MOST_TYPES:
            self._forget()
        before_these = len(self.places)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if len(self.places) > before_these:
            self._learn_types(list(islice(reversed(self.places), len(self.places) - before_these))[::-1])
        own, before, behind, keyed = self.parts
        total = own.take(at, 0)
        total += self.unkeyed + self.field.emit[traits_of(text, len(words))]
        total[1:] += before.take(at[:-1], 0)
        total[0] += self.edges[0]
        total[:-1] += behind.take(at[1:], 0)
        total[-1] += self.edges[1]
        is_key = self.kinds[:, 0].take(at)
        if is_key.any():
            places = keyed_places(words, is_key, self.kinds[:, 1].take(at))
            total[places] += keyed.take(at[places], 0) - self.unkeyed
        return total

    def spans(self, text: str) -> list[tuple[int, int]]:
        """What the field tags as secrets; spans that touch are one."""
        scores = self.scores(text)
        scores[:, _OUT] += self.caution
        tags = self.field.tags(scores)
        found: list[tuple[int, int]] = []
        tagged = np.flatnonzero(tags).tolist()
        if not tagged:
            return found
        starts, ends = places_of(text)
        last = -2
        for i in tagged:
            if found and (tags[i] == _IN and last == i - 1 or found[-1][1] == starts[i]):
                found[-1] = (found[-1][0], int(ends[i]))
            else:
                found.append((int(starts[i]), int(ends[i])))
            last = i
        return found


def added_spans(found: list[tuple[int, int]], base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that say more than the patterns' own: those that lie within one of theirs are left out."""
    # By start; a span lies within a base span that starts at or before it and reaches as far.
    reach, at, kept = -1, 0, []
    base = sorted(base)
    for start, end in found:
        while at < len(base) and base[at][0] <= start:
            reach = max(reach, base[at][1])
            at += 1
        if end > reach:
            kept.append((start, end))
    return kept


def scan_text(text: str, tagger: Tagger | None) -> tuple[int, int, int, str, str]:
    base = pattern_spans(text)
    new = added_spans(tagger.spans(text), [(s, e) for s, _, e, _ in base]) if tagger else []
    counts = [sum(k == i for _, k, _, _ in base) for i in range(3)]
    every = sorted([(s, k, e) for s, k, e, _ in base] + [(s, len(KINDS), e) for s, e in new])
    shown = ",".join(f"{(*KINDS, 'field')[k]}:{s}:{e}" for s, k, e in every)
    return (*counts, ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base), shown)


def scan_column(text: Column, field: Field | None) -> Column:
    """Counts and spans of the patterns, ``base``, and all spans, those of the field as kind ``field``."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field) if field is not None else None
        for texts in batches:
            rows = [scan_text(t or "", tagger) for t in texts]
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return scan(text)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per kind, pattern spans ``base`` and all ``spans`` of every row."""
    scanned = docs.select("doc_id", scan_column(F.col("text"), learn(docs)).alias("s"))
    return scanned.select("doc_id", "s.*")
