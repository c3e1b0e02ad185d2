from __future__ import annotations

import random
import re

import pytest

from eddyline.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def slow(docs, items, length):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - length + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + length]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                for item in windows.get(tuple(w[k : k + n]), ()):
                    found.add(str(item) if item is not None else "null")
                    hit.update(range(k, k + n))
        out.append((doc, len(w), len(hit), len(found), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=repr)


def texts(seed, n, vocabulary, longest):
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("length, bytes_at_most", [(3, 32 << 20), (3, 0), (10, 32 << 20), (1, 0)])
def test_against_loops(spark, monkeypatch, length, bytes_at_most):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bytes_at_most)
    vocabulary = ["The", "of", "é", "Été", "ab1", "x-y", "naïve", "日本", "z"]
    items = list(enumerate(texts(1, 12, vocabulary, 14)))
    items += [(100, None), (101, ""), (102, "--- !!"), (103, "z"), (None, "of of of"), (5, items[5][1])]
    docs = list(enumerate(texts(2, 40, vocabulary, 60)))
    docs += [(50, None), (51, ""), (52, "?!"), (None, items[3][1] + " tail"), (None, "other"), (7, "z of The")]
    docs += [(60, "pre " + items[4][1].upper() + ". post"), (61, ", ".join([items[4][1]] * 3))]
    frame = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, row string")
    tests = spark.createDataFrame([(*i, "s") for i in items], "item_id long, text string, phrase string")
    found = decontaminate.contamination(frame, tests, length).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated) for r in found]
    assert sorted(got, key=repr) == slow(docs, items, length)


def test_near_matches(spark):
    docs = spark.createDataFrame(
        [(1, "x gamma y alpha z beta"), (2, "gamma " + "q " * 30 + "alpha beta"), (3, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    index = decontaminate.positional_index(docs)
    found = decontaminate.near_matches(index, items, within=5, share=0.75, length=3).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1)}
    assert max(r.terms for r in found) == 3


def test_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    (row,) = decontaminate.contamination(docs, items).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_no_python_on_the_executors(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
