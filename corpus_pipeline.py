"""A corpus made fit for training: each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import byte_bpe, decontaminate, quality, simhash, toxicity
from eddyline.llm.queries import (
    PATTERN,
    QUALITY_THRESHOLD,
    RANKS,
    TOXIC_THRESHOLD,
    quality_model,
    toxicity_model,
)
from eddyline.llm.tables import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score("text", model) < TOXIC_THRESHOLD)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    score = quality.score(quality.document_statistics("text"), model)
    return docs.where(score >= QUALITY_THRESHOLD)


def _same_row(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Joins documents with ``id, key`` rows by id and text, null ids included."""
    same = docs["doc_id"].eqNullSafe(rows["id"]) & (F.xxhash64(docs["text"]) == rows["key"])
    return docs.join(rows, same, how)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of SimHash links, as ``op10_simhash`` makes them.

    Shingles of three words, fingerprints at most two bits apart.  Of rows that repeat the id and text
    of a first document, the one that comes first as JSON stays.
    """
    found = simhash.near_duplicates(docs).where("first")
    firsts = found.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.count("*").alias("rows")
    )
    firsts = written(firsts, "first-documents")
    once = _same_row(docs, firsts.where("rows = 1").drop("rows"), "left_semi")
    if firsts.where("rows > 1").isEmpty():
        return once
    # Repeated rows of one id and text: only these are shuffled whole to keep one of them.
    repeated = _same_row(docs, firsts.where("rows > 1").drop("rows"), "left_semi")
    row = F.struct(*docs.columns)
    kept = repeated.groupBy(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")).agg(
        F.min_by(row, F.to_json(row)).alias("kept")
    )
    return once.unionByName(kept.select("kept.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.where("contaminated").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key")
    )
    return _same_row(docs, written(leaks.distinct(), "leaks"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed token ids; ``whole`` says that the ids decode to the text.

    Columns named ``ids``, ``n_tokens`` or ``whole`` before give way to these.
    """
    own = [c for c in docs.columns if c not in ("ids", "n_tokens", "whole")]
    # A name that no column of the documents has.
    name = "_coded" + "_" * max(map(len, docs.columns))
    coded = docs.select(*own, byte_bpe.round_trip("text", RANKS, PATTERN).alias(name))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        *own,
        F.col(name)["ids"].alias("ids"),
        byte_bpe.n_tokens(F.col(name)["ids"]).alias("n_tokens"),
        (F.col(name)["decoded"] == text).alias("whole"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: Trained models are no SQL; the stages are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
