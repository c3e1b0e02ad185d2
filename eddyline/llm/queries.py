"""The registered query of each operator: whole table in, full result out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import (
    byte_bpe,
    chat,
    decontaminate,
    html_text,
    licenses,
    neighbours,
    quality,
    simhash,
    spelling,
    token_counts,
    toxicity,
    turn_repair,
    vector_copies,
)
from eddyline.llm.oracle import ORACLE
from eddyline.llm.tables import fold, table, training_rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN

#: Longest text in tokens that a model with a window of 1,024 reads whole.
TOKEN_LIMIT = 1024


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    coded = table(spark, sf_dir, "documents").select(
        "doc_id", byte_bpe.round_trip("text", RANKS, PATTERN).alias("coded")
    )
    return coded.select(
        "doc_id",
        byte_bpe.n_tokens("coded.ids").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counts = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_counts.count_tokens("text", VOCABULARY).alias("n_tokens"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation with its repaired role and its piece of the rendered text."""
    return chat.repair(table(spark, sf_dir, "conversations"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", html_text.extract("html").alias("text"))


#: Rows that the quality classifier learns from at most, its held-out fold and its threshold.
QUALITY_ROWS, QUALITY_THRESHOLD = 40_000, 0.3


def quality_held_out() -> Column:
    return fold("doc_id", 5) == 0


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Discriminant:
    rows = training_rows(docs, labels, "quality", quality_held_out(), QUALITY_ROWS)
    return quality.fit(
        rows.select("doc_id", "label", quality.document_statistics("text").alias("statistics"))
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        quality_held_out().alias("held_out"),
        quality.score(quality.document_statistics("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0, 5)


TOXIC_THRESHOLD = 0.7


def toxic_held_out() -> Column:
    return fold("doc_id", 3) == 1


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(training_rows(docs, labels, "toxic", toxic_held_out(), toxicity.MOST_ROWS))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", toxic_held_out().alias("held_out"), toxicity.score("text", model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_THRESHOLD).cast("int"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in the benchmark."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.withColumn("items_sha256", digest).drop("item_ids", "text_key")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license declaration of every document, with its place and its differences in wording."""
    found = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(licenses.license_findings("text")).alias("found")
    )
    return found.select("doc_id", "found.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("print").alias("fingerprint"), "component_id")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the repaired text's hash of every conversation, after damage."""
    conversations = table(spark, sf_dir, "conversations")
    edits = turn_repair.repair(turn_repair.damaged(conversations))
    return turn_repair.digests(edits, conversations)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its commoner form and the root of that."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


#: Least cosine of linked vectors.
COPIES_COSINE = 0.98


def op13_vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    return vector_copies.near_duplicates(vectors, COPIES_COSINE)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_chat": op2_chat,
    "op3_html_text": op3_html_text,
    "op4_quality": op4_quality,
    "op5_neighbours": op5_neighbours,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
    "op11_turn_repair": op11_turn_repair,
    "op12_spelling": op12_spelling,
    "op13_vector_copies": op13_vector_copies,
}

__all__ = ["ORACLE", "QUERIES"]
