"""Benchmark decontamination with a positional inverted index; built-in functions only.

The index is stored once: per document the term at each position (``positional_index``).  It is
partitioned by document, so the lists of all terms of a document are in one row and are intersected
there; only postings of the terms asked for, and matches, ever leave a row.

A test item is cut into windows.  ``rarest_terms`` counts the terms of the tests over all training
documents and orders each window's terms from the rarest on.  ``phrase_matches`` takes the postings
of the rarest term, moves them by the term's offset to where the window would start, keeps those
where the list of the second rarest has its term at its own offset, and then those where all terms
stand in order: the exact phrase.  ``near_matches`` asks instead that enough of the window's terms
stand within some words of the rarest one.

Small test sets are broadcast; their size is measured, and beyond ``BROADCAST_BYTES`` the same joins
shuffle by term, with the words around each posting instead of the whole document.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case.  Null
and empty texts have no words.  Items without words have no window; an item shorter than a window is
one window.  Items with null ids or equal texts are items like any other; equal windows of an item
count once.  Every row of the documents is a document, repeated ids or null ids or not.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.tables import written

WINDOW = 10

#: Test windows are broadcast up to this size in memory.
BROADCAST_BYTES = 32 << 20

# Fixed value: the words of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def positional_index(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_key, n_words, terms``: the term at each position, stored in the shared
    folder.  ``row`` numbers the rows, ``text_key`` is a hash of the text.
    """
    index = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words("text").alias("terms"))
    return written(
        index.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id", "text_key", F.size("terms").alias("n_words"), "terms",
        ),
        "index",
    )


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``item_id, phrase``: the distinct windows of each item (``item_id, text``)."""
    split = items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (length - 1)))
    return split.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), length).alias("phrase")
    ).distinct()


def _small(df: DataFrame) -> bool:
    """Whether a written table of strings and arrays stays below the bound in memory."""
    size = df.agg(
        F.coalesce(F.sum(F.octet_length(F.array_join("phrase", " ")) * 3 + 32 * F.size("phrase")), F.lit(0))
    ).first()[0]
    return size <= BROADCAST_BYTES


def rarest_terms(index: DataFrame, phrases: DataFrame, small: bool) -> DataFrame:
    """``item_id, phrase, term, offset, second, second_offset``: the two rarest terms of a window.

    Frequencies are counted over the whole index; terms that it lacks are the rarest.  Ties go to
    the term that stands first.
    """
    vocabulary = phrases.select(F.explode("phrase").alias("term")).distinct()
    counts = (
        index.select(F.explode("terms").alias("term"))
        .join(F.broadcast(vocabulary) if small else vocabulary, "term")
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    named = phrases.select(F.monotonically_increasing_id().alias("k"), "item_id", "phrase")
    placed = written(named, "windows").select(
        "k", "item_id", "phrase", F.posexplode("phrase").alias("offset", "term")
    )
    order = F.sort_array(
        F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))
    )
    ranked = placed.join(counts, "term", "left").groupBy("k").agg(
        F.first("item_id").alias("item_id"), F.first("phrase").alias("phrase"), order.alias("order")
    )
    first, second = F.col("order")[0], F.get("order", F.lit(1))
    return written(
        ranked.select(
            "item_id",
            "phrase",
            first["term"].alias("term"),
            first["offset"].alias("offset"),
            F.coalesce(second["term"], first["term"]).alias("second"),
            F.coalesce(second["offset"], first["offset"]).alias("second_offset"),
        ),
        "rarest",
    )


def _postings(index: DataFrame, rarest: DataFrame, small: bool, reach: int) -> DataFrame:
    """Postings of the rarest terms with their windows: ``row, doc_id, at, around, before, ...``.

    ``around`` is what the document has near the posting, ``before`` how much of it is in front.
    """
    at = index.select("row", "doc_id", "terms", F.posexplode("terms").alias("at", "term"))
    if small:
        near = at.join(F.broadcast(rarest), "term")
        return near.withColumnRenamed("terms", "around").withColumn("before", F.col("at"))
    before = F.least("at", F.lit(reach))
    around = F.slice("terms", F.col("at") - before + 1, before + reach + 1)
    cut = at.select("row", "doc_id", "at", "term", around.alias("around"), before.alias("before"))
    return cut.join(rarest, "term")


def phrase_matches(index: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``row, doc_id, item_id, start, n``: each place where a window of an item stands, n words long."""
    phrases = written(windows(items, length), "phrases")
    small = _small(phrases)
    rarest = rarest_terms(index, phrases, small)
    found = _postings(index, rarest, small, length)
    # The lists moved by their offsets: where the window would start in ``around``.
    start = F.col("before") - F.col("offset")
    both = found.withColumn("start", start).where(
        (F.col("start") >= 0)
        & (F.get("around", F.col("start") + F.col("second_offset")) == F.col("second"))
    )
    whole = F.slice("around", F.col("start") + 1, F.size("phrase")) == F.col("phrase")
    return both.where(whole).select(
        "row",
        "doc_id",
        "item_id",
        (F.col("at") - F.col("offset")).alias("start"),
        F.size("phrase").alias("n"),
    )


def near_matches(
    index: DataFrame, items: DataFrame, within: int, share: float, length: int = WINDOW
) -> DataFrame:
    """``row, doc_id, item_id, at, terms``: places where a share of a window's terms is close together.

    Around each posting of the window's rarest term, ``within`` words to either side, ``terms`` of
    the window's distinct terms occur, in any order, and they are at least that share of them.
    """
    phrases = written(windows(items, length), "phrases")
    small = _small(phrases)
    rarest = rarest_terms(index, phrases, small)
    found = _postings(index, rarest, small, within)
    low = F.greatest(F.col("before") - within, F.lit(0))
    near = F.slice("around", low + 1, F.col("before") - low + within + 1)
    terms = F.size(F.array_intersect("phrase", near))
    return (
        found.withColumn("terms", terms)
        .where(F.col("terms") >= F.size(F.array_distinct("phrase")) * F.lit(share))
        .groupBy("row", "doc_id", "item_id", "at")
        .agg(F.max("terms").alias("terms"))
    )


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated`` for every document.

    ``n_hit`` counts words inside any match, ``item_ids`` are the items found, as sorted strings.
    """
    index = positional_index(docs)
    found = written(phrase_matches(index, items, length), "matches")
    last = F.col("start") + F.col("n") - 1
    hit = (
        found.select("row", "start", "n").distinct()
        .select("row", F.explode(F.sequence("start", last)).alias("at")).distinct()
        .groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    names = F.sort_array(F.collect_list(F.coalesce(F.col("item_id").cast("string"), F.lit("null"))))
    of = (
        found.select("row", "item_id").distinct()
        .groupBy("row").agg(F.count("*").alias("n_items"), names.alias("item_ids"))
    )
    hits = hit.join(of, "row")
    sizes = index.select("row", "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return sizes.join(hits, "row", "left").select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
