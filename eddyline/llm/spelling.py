"""Spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced code point leads from one to the other.  The
pairs are the paths of vocabulary acceptor, one-edit transducer and acceptor again.  The acceptor is cut
by its initial states:

1. A pair's class is the length of its shorter word, its place the length of the common prefix.  Pairs
   whose place is in the first half of the class share the second half of the word, all others the
   first half.  So each word goes to four partitions: for two classes, by its first half and by its last.
   A partition is all that follows one such state; each pair belongs to exactly one.
2. A crowded partition is cut again in the same way, half of its places to either part, until it is
   small or holds one place, where words differ in one or two code points.
3. In a partition the minimised acceptors of the two lengths share their states.  Their composition
   with one edit between them is built state by state, trimmed to what reaches an end, and its paths are
   the near pairs.  What leaves the partition is one row per word, with the number of its near words and
   the best of them, never the pairs.
4. Forms are followed to their roots by doubling; a form occurs at least twice as often as its word, so
   a chain is no longer than the logarithm of the largest count.

Null and empty texts have no words; a null doc_id counts as an empty one where runs are damaged.  Rows
that repeat count again.  Texts and words of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.chat import batched, groups
from eddyline.llm.tables import written

LETTERS = r"[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Words of a partition beyond which it is cut again.
CROWDED = 20_000
_DAMAGE = 97


# -- the machine ----------------------------------------------------------------------------------


class Acceptor:
    """Minimised acceptors of sets of strings of one length each, with their states in common."""

    def __init__(self) -> None:
        self.moves: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}
        #: Accepts the empty string only: the only final state, as lengths are equal.
        self.end = self._state({})

    def _state(self, moves: dict[str, int]) -> int:
        key = tuple(moves.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.moves)
            self.moves.append(moves)
        return found

    def add(self, strings: list[str]) -> int:
        """The state that accepts exactly these, which are sorted, distinct and of one length."""
        if strings == [""]:
            return self.end
        path: list[dict[str, int]] = [{} for _ in strings[0]]
        before = strings[0]

        def close(word: str, least: int) -> None:
            state = self.end
            for at in range(len(word) - 1, least - 1, -1):
                path[at][word[at]] = state
                if at > least:
                    state, path[at] = self._state(path[at]), {}

        for word in strings[1:]:
            shared = next(k for k, (a, b) in enumerate(zip(before, word, strict=True)) if a != b)
            close(before, shared)
            before = word
        close(before, 0)
        return self._state(path[0])

    def strings(self, state: int) -> Iterator[str]:
        waiting = [(state, "")]
        while waiting:
            state, text = waiting.pop()
            if state == self.end:
                yield text
            waiting += [(to, text + label) for label, to in self.moves[state].items()]


# Kinds of states of the composition: both words alike so far, with one more replacement or one
# insertion in the second to come; just after the insertion; after the edit.
_REPLACE, _INSERT, _INSERTED, _AFTER = range(4)


class Composition:
    """Acceptor, one edit, acceptor: its trimmed states and the pairs on its paths."""

    def __init__(self, acceptor: Acceptor, start: tuple, at_end: bool):
        self.acceptor, self.at_end = acceptor, at_end
        self.places, self.arcs = {start: 0}, []
        states = [start]
        # Every arc leads one step on, so states come in order of their steps.
        for state in states:
            own = []
            for first, second, to in self._steps(state):
                place = self.places.get(to)
                if place is None:
                    place = self.places[to] = len(states)
                    states.append(to)
                own.append((first, second, place))
            self.arcs.append(own)
        self.states = states
        self.alive = [False] * len(states)
        for place in range(len(states) - 1, -1, -1):
            kind, p, q, _ = states[place]
            if kind in (_AFTER, _INSERTED) and p == q and (kind == _AFTER or p == acceptor.end):
                self.alive[place] = True
                continue
            self.arcs[place] = [arc for arc in self.arcs[place] if self.alive[arc[2]]]
            self.alive[place] = bool(self.arcs[place])

    def _steps(self, state: tuple) -> Iterator[tuple[str, str, tuple]]:
        kind, p, q, skipped = state
        mine, theirs = self.acceptor.moves[p], self.acceptor.moves[q]
        if kind == _REPLACE:
            labels = list(mine.items())
            for k, (a, to) in enumerate(labels):
                yield a, a, (_REPLACE, to, to, "")
                for b, other in labels[k + 1 :]:
                    if to == other or not self.acceptor.moves[to].keys().isdisjoint(self.acceptor.moves[other]):
                        yield a, b, (_AFTER, to, other, "")
        elif kind == _INSERT:
            for b, other in theirs.items():
                if b in mine:
                    yield b, b, (_INSERT, mine[b], other, "")
                if mine or self.at_end:
                    yield "", b, (_INSERTED, p, other, b)
        elif p != q or kind == _INSERTED:
            # The place of an insertion is as far back as can be: what follows it is not the same.
            for a, to in mine.items():
                if a in theirs and a != skipped:
                    yield a, a, (_AFTER, to, theirs[a], "")

    def pairs(self) -> Iterator[tuple[str, str]]:
        waiting = [(0, "", "")] if self.alive[0] else []
        while waiting:
            place, first, second = waiting.pop()
            kind, p, q, _ = self.states[place]
            if kind == _AFTER and p == q:
                for rest in self.acceptor.strings(p):
                    yield first + rest, second + rest
                continue
            if kind == _INSERTED and p == q == self.acceptor.end:
                yield first, second
            for a, b, to in self.arcs[place]:
                waiting.append((to, first + a, second + b))


def near_pairs(shorter: list[str], longer: list[str], at_end: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart: two of ``shorter``, or one of them and one of ``longer``, once each.

    Both are sorted sets, ``longer`` of strings of one code point more.  ``at_end`` says whether an
    insertion may stand behind the last code point.
    """
    acceptor = Acceptor()
    if not shorter:
        return
    short = acceptor.add(shorter)
    if len(shorter) > 1:
        yield from Composition(acceptor, (_REPLACE, short, short, ""), at_end).pairs()
    if longer:
        start = (_INSERT, short, acceptor.add(longer), "")
        yield from Composition(acceptor, start, at_end).pairs()


# -- words ----------------------------------------------------------------------------------------


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of ``docs`` (``doc_id, text``), after damage, and their occurrences."""
    capitals = "".join(map(chr, range(65, 91)))
    text = F.translate("text", capitals, capitals.lower())
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    # Damage only shortens a run.
    runs = runs.select("doc", "run", F.char_length("run").alias("size")).where(f"size >= {LEAST_LENGTH}")
    drawn = F.crc32(F.concat("doc", F.lit(":"), "run"))
    runs = runs.select("run", "size", drawn.alias("drawn"))
    at = (F.col("drawn") % F.col("size")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("drawn") % _DAMAGE == 0, shorter).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))


_KEY = ["class", "low", "high", "head", "foot"]


def _keyed(rows: DataFrame) -> DataFrame:
    """``word, n`` and the partition of ``class`` for places from ``low`` up to ``high``."""
    behind = F.greatest(F.col("class") - F.col("high"), F.lit(0))
    size = F.char_length("word")
    return rows.select(
        "word", "n", "class", "low", "high",
        F.substring("word", F.lit(1), F.col("low")).alias("head"),
        F.substring("word", size - behind + 1, behind).alias("foot"),
    )


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    rows = rows.select("word", "n", "class", F.explode(both).alias("places"))
    return _keyed(rows.select("word", "n", "class", "places.low", "places.high"))


def _partitions(words: DataFrame, crowded: int) -> DataFrame:
    """Each word once for each partition that it belongs to."""
    size = F.char_length("word")
    classes = F.explode(F.filter(F.array(size, size - 1), lambda c: c >= LEAST_LENGTH))
    rows = words.select("word", "n", classes.alias("class"))
    rows = _halved(rows.select("*", F.lit(0).alias("low"), (F.col("class") + 1).alias("high")))
    done = None
    while True:
        rows = written(rows, "word-partitions")
        many = rows.groupBy(_KEY).count().where((F.col("count") > crowded) & (F.col("high") - F.col("low") > 1))
        many = written(many.drop("count"), "crowded-partitions")
        last = many.isEmpty()
        small = rows if last else rows.join(many, _KEY, "left_anti")
        done = small if done is None else done.unionByName(small)
        if last:
            return done
        rows = _halved(rows.join(many, _KEY, "left_semi"))


_NEAR = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())]
)


def _found(rows: list[tuple]) -> Iterator[tuple]:
    """The words of one partition that have near ones in it."""
    size, _, high, head, foot = rows[0][:5]
    start, rest = len(head), len(foot)
    short, long = [], []
    counts: dict[str, int] = {}
    for *_, word, n in rows:
        tail = word[start : len(word) - rest]
        counts[tail] = n
        (short if len(word) == size else long).append(tail)
    best: dict[str, tuple[int, int, str]] = {}

    def tell(one: str, other: str) -> None:
        number, most, name = best.get(one, (0, 0, ""))
        # Whole words are compared: tails of two lengths may be in another order.
        n, other = counts[other], head + other + foot
        better = n > most or n == most and other < name
        best[one] = (number + 1, n, other) if better else (number + 1, most, name)

    for one, other in near_pairs(short, long, high > size):
        tell(one, other)
        tell(other, one)
    for tail, (number, n, other) in best.items():
        yield head + tail + foot, number, n, other


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return batched((row for g in groups(batches, len(_KEY)) if len(g) > 1 for row in _found(g)), _NEAR)


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word, n_near, form_n, form``: words of ``words`` (``word, n``, words distinct) with near words.

    ``form`` is the near word of the largest count ``form_n``; of equal ones the first in code-point order.
    """
    parts = _partitions(words, crowded).select(*_KEY, "word", "n")
    parts = parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "word")
    found = parts.mapInArrow(_near, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms of each word of ``forms`` (``word, form``)."""
    now = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.select("word", "root").join(onward, "root", "left")
        now = now.select("word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved"))
        now = written(now, "roots")
    return now.select("word", "root")


def variants(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``, words distinct)."""
    words = written(words.select("word", "n"), "vocabulary")
    near = words.join(near_words(words, crowded), "word", "left")
    is_form = F.col("form_n") >= 2 * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    near = written(near, "near-words")
    found = near.join(roots(near.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
