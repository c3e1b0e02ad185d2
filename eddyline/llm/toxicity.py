"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is a fixed list of insults and the terms that the training rows teach: words, and word
beginnings (written ``abcd*``), that stand behind many different words in toxic texts and behind few
in others.  Counting the words in front rather than the documents keeps copies of one toxic text
from teaching all its words.  One half of the training rows teaches the lexicon, the other half the
trees, so that the trees see the lexicon as it does on texts it was not made from.

Features of a text: how many lexicon hits it has, plain and disguised (digits or signs for letters,
letters apart, letters repeated), how strong and how dense they are, how many stand close to a second
person, and the rates of capitals, marks and mixed tokens.  Trees are trained on at most
``MOST_ROWS`` rows, chosen by a hash; the curve is isotonic over predictions for rows that the
predicting trees did not see.

Whole texts are scored.  Null and empty texts have the features of zero words and a score like any
other.  With fewer than three training rows of a class, which the curve needs one of in each of three
folds, every score is the share of label 1 (zero without rows).  Rows with a null label or id are not learnt from.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.boosting import Boosted, Isotonic, boost, isotonic
from eddyline.llm.units import Kept

#: Most labelled rows that the model learns from, and most terms of the learnt lexicon.
MOST_ROWS, MOST_TERMS = 40_000, 2_000
#: Different words that a term must follow in toxic texts, and its least log odds.
LEAST_CONTEXTS, LEAST_WEIGHT = 5, 3.0
#: Lengths of word beginnings.
BEGINNINGS = (4, 5)
#: Words between a hit and a second person that count as close.
CLOSE = 4

# Common insults, and second persons of the languages at hand.
INSULTS = (
    "idiot moron stupid dumb loser pathetic scum worthless trash clown disgusting imbecile fool "
    "bastard bitch asshole jerk cretin filth vermin garbage shut hate kill fuck fucking shit crap "
    "dumbass retard pig freak creep whore slut idiota estúpido imbécil idiote stupide dumm blöd"
)
SECOND_PERSONS = (
    "you your yours yourself ur u du dich dir dein deine ihr euch tu te toi ton ta vous votre vos "
    "tú ti tus usted ustedes"
)
INSULT_WEIGHT = 4.0

NAMES = [
    "log words", "plain hits", "plain rate", "weight", "weight rate", "strongest", "distinct hits",
    "disguised hits", "disguised rate", "close to you", "second persons", "capitals", "shouted words",
    "exclamations", "questions", "marks", "mixed tokens",
]

_WORD = re.compile(r"[^\W\d_]+")
# Signs read as letters.
_DISGUISE = str.maketrans("013457@$!|", "oieastasil")
_NOT_WORD = re.compile(r"[\W_]+")
_REPEATED = re.compile(r"(.)\1{2,}")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")


#: What most tokens are; one object for all of them.
PLAIN = (0.0, False, "", False, False, False)


class Reader:
    """Features of texts under one lexicon, in one Python worker."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.persons = frozenset(SECOND_PERSONS.split())
        self.tokens = Kept(self._token, 60_000)

    def weight(self, word: str) -> float:
        get = self.lexicon.get
        found = get(word, 0.0)
        for n in BEGINNINGS:
            if len(word) > n:
                found = max(found, get(word[:n] + "*", 0.0))
        return found

    def disguised(self, token: str) -> tuple[float, str]:
        """The weight of what the token spells once signs are read as letters."""
        plain = _NOT_WORD.sub("", token.translate(_DISGUISE))
        for word in {plain, _REPEATED.sub(r"\1", plain), _REPEATED.sub(r"\1\1", plain)}:
            found = self.lexicon.get(word, 0.0)
            if found:
                return found, word
        return 0.0, ""

    def _token(self, token: str) -> tuple[float, bool, str, bool, bool, bool]:
        """Weight, disguised?, hit word, second person?, shouted?, mixed?"""
        low = token.lower()
        words = _WORD.findall(low)
        best, hit, hidden = 0.0, "", False
        for word in words:
            weight = self.weight(word)
            if weight > best:
                best, hit = weight, word
        core = low.strip(".,;:!?\"'()[]")
        mixed = len(words) > 0 and not core.isalpha() and len(core) > 2
        if not best and (mixed or _REPEATED.search(core)):
            best, hit = self.disguised(core)
            hidden = best > 0
        person = any(word in self.persons for word in words)
        letters = sum(map(len, words))
        found = best, hidden, hit, person, letters > 2 and token.isupper(), mixed
        return PLAIN if found == PLAIN else found

    def _apart(self, tokens: list[str]) -> list[float]:
        """Weights of words whose letters stand apart."""
        found, run = [], ""
        for token in [*tokens, ".."]:
            letter = token.strip(".,;:!?*-_")
            if len(letter) == 1:
                run += letter
            elif run:
                if len(run) > 2:
                    found.append(self.disguised(run.lower())[0])
                run = ""
        return [weight for weight in found if weight]

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = text.split()
        n = len(tokens)
        seen = list(map(self.tokens.__getitem__, tokens))
        hits = [k for k, s in enumerate(seen) if s[0]]
        hidden = [k for k in hits if seen[k][1]]
        apart = self._apart(tokens) if sum(len(t) == 1 for t in tokens) > 2 else []
        weights = [seen[k][0] for k in hits] + apart
        persons = [k for k, s in enumerate(seen) if s[3]]
        close = 0
        if hits and persons:
            # Both are in order: a hit is close if a person stands between its two ends.
            there, at = np.array(persons), np.array(hits)
            first = np.searchsorted(there, at - CLOSE)
            close = int((first < np.searchsorted(there, at + CLOSE, "right")).sum())
        some = n + 20
        data = text.encode()
        capitals = len(_CAPITALS.findall(text))
        return [
            float(np.log1p(n)),
            float(np.log1p(len(hits) - len(hidden))),
            (len(hits) - len(hidden)) / some,
            float(np.log1p(sum(weights))),
            sum(weights) / some,
            max(weights, default=0.0),
            float(np.log1p(len({seen[k][2] for k in hits}))),
            float(np.log1p(len(hidden) + len(apart))),
            (len(hidden) + len(apart)) / some,
            close / (len(hits) + 1),
            len(persons) / some,
            capitals / (len(text) + 20),
            sum(s[4] for s in seen) / some,
            data.count(b"!") / some,
            data.count(b"?") / some,
            sum(data.count(c) for c in b".,;:") / some,
            sum(s[5] for s in seen) / some,
        ]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    trees: Boosted | None
    curve: Isotonic | None
    fallback: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.fallback)
        margin = self.trees.margin(x)
        # The curve is flat within its blocks; a little of the margin keeps the order inside them.
        return 0.99 * self.curve(margin) + 0.01 / (1 + np.exp(-margin))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms with their log odds, from ``label, text``; the fixed insults are always in."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    in_front = F.concat(F.array(F.lit("")), F.col("words"))
    pairs = rows.select("label", words.alias("words")).select(
        "label", F.explode(F.arrays_zip("words", in_front.alias("front"))).alias("pair")
    )
    word = F.col("pair.words")
    terms = F.array(word, *[F.when(F.length(word) > n, F.concat(F.substring(word, 1, n), F.lit("*"))) for n in BEGINNINGS])
    seen = pairs.where(word.isNotNull()).select(
        "label", F.col("pair.front").alias("front"), F.explode(F.array_compact(terms)).alias("term")
    )
    # Each pair of a term and the word in front counts once, and is made one before terms meet: a
    # frequent term then comes from each task as one row.
    once = seen.groupBy("term", "front").agg(F.bit_or(F.col("label") + 1).alias("labels"))
    counts = once.groupBy("term").agg(
        *(F.count_if(F.col("labels").bitwiseAND(k + 1) > 0).alias(c) for k, c in ((0, "other"), (1, "toxic")))
    )
    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = F.log(F.col("toxic") / F.lit(float(total.get(1, 1)))) - F.log(
        (F.col("other") + 0.5) / F.lit(float(total.get(0, 1)))
    )
    kept = (
        counts.where(F.col("toxic") >= LEAST_CONTEXTS).select("term", "toxic", weight.alias("weight"))
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("toxic"), "term").limit(MOST_TERMS)
    )
    learnt = {r["term"]: min(float(r["weight"]), 8.0) for r in kept.collect()}
    return {**dict.fromkeys(INSULTS.split(), INSULT_WEIGHT), **learnt}


def features(text: Column | str, lexicon: dict[str, float]) -> Column:
    """The features of a text as an array, in the order of ``NAMES``."""
    terms = tuple(lexicon.items())

    @F.arrow_udf("array<double>")
    def computed(texts: pa.Array) -> pa.Array:
        one = _reader(terms)
        return pa.array([one.features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return computed(text)


@functools.lru_cache(maxsize=1)
def _reader(lexicon: tuple[tuple[str, float], ...]) -> Reader:
    """One reader per worker and lexicon, however many tasks and batches there are."""
    return Reader(dict(lexicon))


def _folds(x: np.ndarray, y: np.ndarray, k: int = 3) -> np.ndarray:
    """Margins of rows from trees that did not see them."""
    out = np.zeros(len(y))
    for fold in range(k):
        own = np.arange(len(y)) % k == fold
        out[own] = boost(x[~own], y[~own]).margin(x[own])
    return out


def fit(rows: DataFrame) -> Model:
    """Learns from ``doc_id, label, text`` with labels 0 and 1."""
    teaches = F.pmod(F.xxhash64("doc_id", F.lit("lexicon")), F.lit(2)) == 0
    lexicon = learn_lexicon(rows.where(teaches))
    seen = rows.where(~teaches).select("doc_id", "label", features("text", lexicon).alias("x"))
    found = seen.toPandas().sort_values("doc_id", kind="stable")
    y = found["label"].to_numpy(float)
    if len(set(y)) < 2 or min(y.sum(), len(y) - y.sum()) < 3:
        return Model(lexicon, None, None, float(y.mean()) if len(y) else 0.0)
    x = np.array(found["x"].tolist()).reshape(-1, len(NAMES))
    return Model(lexicon, boost(x, y), isotonic(_folds(x, y), y))


def score(text: Column | str, model: Model) -> Column:
    """The probability that a text is toxic."""
    terms = tuple(model.lexicon.items())

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        one = _reader(terms)
        x = np.array([one.features(t.as_py()) for t in texts]).reshape(-1, len(NAMES))
        return pa.array(model.score(x))

    return scored(text)
