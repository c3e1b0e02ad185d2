from __future__ import annotations

import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.llm import boosting, quality, toxicity
from eddyline.llm.queries import op4_quality, op7_toxicity
from eddyline.llm.tables import training_labels, training_rows

FOLDER = "/root/testdata/sf0.01"


def labels(spark, name):
    rows = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    return {r.doc_id: r[name] for r in rows}


@pytest.mark.parametrize(
    "query, name, folds, held, threshold",
    [(op4_quality, "quality", 5, 0, 0.3), (op7_toxicity, "toxic", 3, 1, 0.7)],
)
def test_queries_give_a_score_to_every_document(spark, query, name, folds, held, threshold):
    rows = query(spark, FOLDER).collect()
    ids = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in ids)
    known, right, wrong = labels(spark, name), 0, 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if r.held_out and r.doc_id in known:
            right += r.predicted == known[r.doc_id]
            wrong += r.predicted != known[r.doc_id]
    # A seventh of the toxic labels of these small tables stand on texts that show nothing.
    assert right > 12 * wrong
    again = {r.doc_id: r.score for r in query(spark, FOLDER).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = known.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = training_rows(docs, known, "toxic", held, 10_000).collect()
    b = training_rows(docs, turned, "toxic", held, 10_000).collect()
    assert sorted(a) == sorted(b) and a
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in a)


def test_training_labels_are_bounded_and_usable(spark):
    rows = [(k, k % 2, "x") for k in range(4000)] + [(None, 1, "x"), (1, None, "x"), (2, 7, "x"), (3, 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, label int, text string")
    got = training_labels(frame, "label", F.lit(False), 1000).collect()
    assert 800 < len(got) < 1200 and len(set(got)) == len(got)
    assert all(r.doc_id is not None and r.label in (0, 1) for r in got)


ODD = [None, "", " ", "a", "\n\n\n", "IDIOT!!!", "日本 語", "you " * 5000, "x" * 100_000, "1d10t i d i o t"]


@pytest.mark.parametrize("text", ODD)
def test_features_are_finite(text):
    assert len(quality.statistics(text)) == len(quality.NAMES)
    assert np.isfinite(quality.statistics(text)).all()
    found = toxicity.Reader({"idiot": 4.0}).features(text)
    assert len(found) == len(toxicity.NAMES) and np.isfinite(found).all()


def test_disguises_are_read():
    reader = toxicity.Reader({"idiot": 4.0, "loser": 4.0, "abcd*": 5.0})
    names = toxicity.NAMES

    def of(text, name):
        return reader.features(text)[names.index(name)]

    assert of("an idiot.", "plain hits") == pytest.approx(np.log(2))
    assert of("abcdefg", "strongest") == 5.0 and of("abcd", "strongest") == 0.0
    for hidden in ("1d10t", "i.d.i.o.t", "i-d-i-o-t", "iiidiot", "l0$er", "such i d i o t here"):
        assert of(hidden, "disguised hits") == pytest.approx(np.log(2)), hidden
    assert of("you idiot", "close to you") == 0.5
    assert of("you " + "word " * 9 + "idiot", "close to you") == 0.0


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, label int, text string")


def test_lexicon_counts_contexts_not_copies(spark):
    other = ["abcdefgh"[k // 8] + "klmnopqr"[k % 8] for k in range(60)]  # words of letters only
    rows = [(k, 1, f"{w} zorkling {w} and copied words here") for k, w in enumerate(other)]
    rows += [(100 + k, 0, f"{w} plain {w} and copied words here") for k, w in enumerate(other)]
    found = toxicity.learn_lexicon(frame(spark, rows))
    assert "zork*" in found and "zorkling" in found
    assert not {"copied", "words", "copi*", "plain", "and"} & found.keys()


@pytest.mark.parametrize("one", [0, 1])
def test_one_class_or_none(spark, one):
    rows = frame(spark, [(k, one, f"text {k}") for k in range(5)])
    assert toxicity.fit(rows).score(np.zeros((2, len(toxicity.NAMES)))).tolist() == [one, one]
    with_statistics = rows.select("doc_id", "label", quality.document_statistics("text").alias("statistics"))
    zeros = np.zeros((2, len(quality.NAMES)))
    assert quality.fit(with_statistics).score(zeros).tolist() == [one, one]
    assert quality.fit(with_statistics.limit(0)).score(zeros).tolist() == [0.5, 0.5]
    assert toxicity.fit(rows.limit(0)).score(np.zeros((1, len(toxicity.NAMES)))).tolist() == [0.0]


def test_moments_and_discriminant_match_numpy(spark):
    rng = np.random.default_rng(5)
    d = len(quality.NAMES)
    x = rng.normal(size=(400, d)) @ rng.normal(size=(d, d))
    y = (rng.random(400) < 0.4).astype(int)
    x[y == 1] += 1.0
    rows = [(k, int(y[k]), x[k].tolist()) for k in range(400)]
    data = spark.createDataFrame(rows, "doc_id long, label int, statistics array<double>").repartition(7)
    model = quality.fit(data)
    logs = []
    own = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    share = np.array([(y == k).mean() for k in (0, 1)])
    pooled = share[0] * own[0] + share[1] * own[1]
    for k in (0, 1):
        c = (1 - quality.TO_POOLED) * own[k] + quality.TO_POOLED * pooled
        c = (1 - quality.TO_SPHERE) * c + quality.TO_SPHERE * np.diag(np.diag(pooled) + 1e-6)
        off = x - x[y == k].mean(axis=0)
        maha = (off * np.linalg.solve(c, off.T).T).sum(axis=1)
        logs.append(np.log(share[k]) - 0.5 * (maha + np.linalg.slogdet(c)[1]))
    assert np.allclose(model.difference(x), logs[1] - logs[0])
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.boost(x[:2000], y[:2000])
    assert ((model.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.97


def test_isotonic_rises_and_means_are_kept():
    rng = np.random.default_rng(2)
    m = rng.normal(size=2000)
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * m))).astype(float)
    curve = boosting.isotonic(m, y)
    at = np.linspace(-5, 5, 200)
    assert (np.diff(curve(at)) >= 0).all()
    assert np.abs(curve(at) - 1 / (1 + np.exp(-2 * at))).mean() < 0.05
    assert curve(np.array([-9.0]))[0] < 0.5 < curve(np.array([9.0]))[0]


def test_repeated_ids_do_not_break_the_bound(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    docs = spark.range(5000).selectExpr("1L AS doc_id", "concat('text ', id) AS text", "id AS label")
    more = docs.unionByName(docs).unionByName(spark.sql("SELECT 2L AS doc_id, 'text 1' AS text, 0L AS label"))
    assert 50 < training_rows(more, labels, "toxic", F.lit(False), 100).count() < 160
    whole = training_rows(more, labels, "toxic", F.lit(False), 10_000).collect()
    assert len(whole) == len(set(whole)) == 5001


def test_few_rows_of_a_class_give_its_share(spark):
    rows = [(k, int(k < 2), f"you idiot number {k}") for k in range(40)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    assert model.score(np.zeros((2, len(toxicity.NAMES)))).tolist() == [model.fallback] * 2
    assert model.fallback in (0.0, 1 / 20, 2 / 20) or 0 < model.fallback < 0.2


def slow_close(reader, text):
    tokens = text.split()
    seen = [reader._token(t) for t in tokens]
    hits = [k for k, s in enumerate(seen) if s[0]]
    persons = [k for k, s in enumerate(seen) if s[3]]
    return sum(any(abs(k - p) <= toxicity.CLOSE for p in persons) for k in hits) / (len(hits) + 1)


def test_second_persons_near_hits_against_all_pairs():
    reader = toxicity.Reader(dict.fromkeys(toxicity.INSULTS.split(), 4.0))
    at, draw = toxicity.NAMES.index("close to you"), np.random.default_rng(1)
    words = ["you", "idiot", "a", "plain", "word", "more", "of", "it", "your", "stupid"]
    for n in (0, 1, 5, 30, 400):
        for _ in range(20):
            text = " ".join(draw.choice(words, n, p=[0.05, 0.05, *[0.1] * 5, 0.2, 0.1, 0.1]))
            assert reader.features(text)[at] == slow_close(reader, text)
    start = time.perf_counter()
    reader.features("you idiot " * 200_000)
    assert time.perf_counter() - start < 10


def slow_terms(rows):
    """Words in front of each term, by label, counted once each."""
    fronts = {}
    for _, label, text in rows:
        words = re.findall(r"[^\W\d_]+", text.lower())
        for front, word in zip(["", *words], words, strict=False):
            for term in [word, *(word[:n] + "*" for n in toxicity.BEGINNINGS if len(word) > n)]:
                fronts.setdefault(term, (set(), set()))[label].add(front)
    return {term: tuple(map(len, own)) for term, own in fronts.items()}


def test_lexicon_against_loops(spark):
    draw = np.random.default_rng(2)
    calm, rude = [f"calm{chr(97 + k % 6)}{chr(97 + k)}" for k in range(26)], ["zork", "blarghs", "zorker"]
    rows = []
    for k in range(300):
        words = list(draw.choice(calm, 12))
        if k % 3 == 0:
            words[draw.integers(1, 12)] = str(draw.choice(rude))
        rows.append((k, int(k % 3 == 0), " ".join(words).title()))
    n = [sum(r[1] == label for r in rows) for label in (0, 1)]
    want = dict.fromkeys(toxicity.INSULTS.split(), toxicity.INSULT_WEIGHT)
    for term, (other, toxic) in slow_terms(rows).items():
        weight = np.log(toxic / n[1]) - np.log((other + 0.5) / n[0]) if toxic else -1
        if toxic >= toxicity.LEAST_CONTEXTS and weight >= toxicity.LEAST_WEIGHT:
            want[term] = min(weight, 8.0)
    got = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    assert got.keys() == want.keys() and "zork" in got and "blar*" in got
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)
