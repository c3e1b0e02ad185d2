from __future__ import annotations

import numpy as np

import corpus_pipeline
from eddyline.llm import quality, toxicity
from eddyline.llm.queries import quality_model, toxicity_model
from test_byte_bpe import ids_of
from test_decontaminate import slow
from test_simhash import slow_components, slow_print

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_loops(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = {r.doc_id: r.asDict() for r in source.collect()}

    model = toxicity_model(source, labels)
    reader = toxicity.Reader(model.lexicon)
    score = {k: model.score(np.array([reader.features(d["text"])]))[0] for k, d in docs.items()}
    docs = {k: d for k, d in docs.items() if score[k] < 0.7}

    kept = source.where(source.doc_id.isin(list(docs)))
    poor = quality_model(kept, labels)
    docs = {
        k: d for k, d in docs.items() if poor.score(np.array([quality.statistics(d["text"])]))[0] >= 0.3
    }

    ids = sorted(docs)
    label = slow_components([slow_print(docs[k]["text"]) for k in ids])
    docs = {k: docs[k] for n, k in enumerate(ids) if label[n] == n}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {r[0] for r in slow([(k, d["text"]) for k, d in docs.items()], items, 10) if r[-1]}
    docs = {k: d for k, d in docs.items() if k not in leaks}

    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found.keys() == docs.keys() and 0 < len(docs) < len(score)
    for k, d in docs.items():
        assert {c: found[k][c] for c in d} == d
        assert np.frombuffer(found[k].ids, "<u4").tolist() == ids_of(d["text"])
        assert found[k].whole and found[k].n_tokens == len(found[k].ids) // 4


def odd(spark):
    long = "words and more of them " * 3000
    rows = [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, "", "en", "s", 0), (None, "lone row here", "en", "s", 1),
        (None, None, "en", "s", 1), (4, "twice the same text", "en", "s", 1), (4, "twice the same text", "en", "s", 1),
        (5, "twice the same text", "en", "s", 1), (6, long, "en", "s", 1), (4, "another text of that id", "en", "s", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_take_odd_rows(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        none = stage(spark, docs.limit(0), FOLDER)
        assert none.count() == 0, name
        assert set(docs.columns) <= set(out.columns), name
        more = stage(spark, docs.withColumn("score", docs.n_chars).withColumn("row", docs.lang), FOLDER)
        assert more.count() == out.count()


def test_repeated_rows_leave_a_fixed_one(spark):
    rows = [(7, "the same text again and again", source, k) for k, source in enumerate("cba")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    for asked in (docs, docs.repartition(3), docs.orderBy("source")):
        kept = corpus_pipeline.drop_copies(spark, asked, FOLDER).collect()
        assert [(r.doc_id, r.source) for r in kept] == [(7, "a")]


def test_encoding_replaces_columns_of_its_names(spark):
    docs = odd(spark).selectExpr("*", "lang AS ids", "lang AS whole")
    out = corpus_pipeline.encode(spark, docs, FOLDER)
    assert sorted(out.columns) == sorted({*docs.columns, "n_tokens"})
    assert all(r.whole is True for r in out.collect())


def test_one_row_of_each_group_stays(spark):
    kept = corpus_pipeline.drop_copies(spark, odd(spark), FOLDER).collect()
    assert sorted(str((r.doc_id, (r.text or "")[:8])) for r in kept) == sorted(
        str(x) for x in [(1, ""), (None, "lone row"), (4, "twice th"), (4, "another "), (6, "words an")]
    )
