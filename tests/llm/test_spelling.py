from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations, product

import pytest

from eddyline.llm import spelling
from eddyline.llm.queries import op12_spelling

FOLDER = "/root/testdata/sf0.001"


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def slow_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def slow_variants(words):
    near = {w: [] for w in words}
    # Words one edit apart have a text in common after one or no code point is taken out.
    shortened = {}
    for w in words:
        for text in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            shortened.setdefault(text, []).append(w)
    for a, b in {tuple(sorted(p)) for own in shortened.values() for p in combinations(own, 2)}:
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] is not None else None)
    return out


def rows_of(df):
    found = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


def test_composition_against_all_pairs():
    draw = random.Random(1)
    for _ in range(1500):
        size, alphabet = draw.randrange(6), draw.choice(["ab", "abc", "aéz"])

        def some(n, alphabet=alphabet):
            return sorted({"".join(draw.choice(alphabet) for _ in range(n)) for _ in range(draw.randrange(9))})

        short, long = some(size), some(size + 1)
        want = [p for p in combinations(short, 2) if is_near(*p)]
        want += [p for p in product(short, long) if is_near(*p)]
        assert sorted(spelling.near_pairs(short, long, True)) == sorted(want)


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor()
    start = acceptor.add(sorted("".join(p) for p in product("abc", repeat=6)))
    assert len(acceptor.moves) == 7 and len(set(acceptor.strings(start))) == 3**6
    assert acceptor.add(["xaa", "yaa"]) != start and len(acceptor.moves) == 10


@pytest.mark.parametrize("crowded", [spelling.CROWDED, 4])
def test_variants_of_like_words(spark, crowded):
    draw = random.Random(2)
    words = {"".join(draw.choice("abé") for _ in range(draw.randrange(5, 9))): draw.choice([3, 4, 9, 30, 100]) for _ in range(900)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(df, crowded)) == slow_variants(words)


def test_chain_to_the_root(spark):
    words = {"a" * 5 + "b" * k: 3 * 2**k for k in range(9)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = rows_of(spelling.variants(df))
    assert {r[1] for r in found.values()} == {"a" * 5 + "b" * 8} and found == slow_variants(words)


def test_query_against_loops(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op12_spelling(spark, FOLDER)) == slow_variants(slow_words(docs))


def test_odd_rows(spark):
    long = "x" * 30_000
    texts = [
        (1, None), (2, ""), (None, "Words words WORDS wordy worda Éclair éclair ÉCLAIR éclair"), (4, f"{long} {long} {long} {long}y"),
        (5, f"{long}y {long}y {long}y {long}y {long}y {long}y"), (6, "cafés cafés cafes cafes cafes 3cafés_cafes"),
        (6, "cafés cafés cafes cafes cafes 3cafés_cafes"), (7, "a×b÷cd a×b÷cd a×b÷cd İstan İstan"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    more = docs.selectExpr("*", "text AS word", "doc_id AS n", "text AS run", "doc_id AS class")
    want = slow_variants(slow_words(texts))
    for asked in (docs, more):
        assert rows_of(spelling.variants(spelling.vocabulary(asked))) == want
    assert long in want and "cafés" in want
    assert rows_of(spelling.variants(spelling.vocabulary(docs.limit(0)))) == {}
