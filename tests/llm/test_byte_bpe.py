from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from eddyline.llm import byte_bpe, token_counts
from eddyline.llm.queries import PATTERN, RANKS, VOCABULARY, op1_byte_bpe, op6_token_counts
from eddyline.llm.units import Kept, cut

SMALL = "/root/testdata/sf0.001"
OTHER_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = [
    "", " ", "   ", "\n \n \nx", "a  b", "a \n b", "it's we'll 'S", "\x1c\x85　x", "naïve Straße 東京 🎉🎉",
    "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "ababababab" * 50, "١٢٣ 12 ½ Ⅷ", "é‍", "퟿\U0010ffff",
    "tab\tand\r\nline", " lead and trail ", "x" * 3000, "ꟼ Ⴧ 𝒳", "a 'tis", " \t \t",
]


def library(path):
    return tiktoken.Encoding(
        "t", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )


@pytest.fixture(scope="module")
def known():
    return library(RANKS)


@pytest.fixture(scope="module")
def counted():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(text, path=RANKS):
    return np.frombuffer(byte_bpe.codec(path, PATTERN).encode(text), "<u4").tolist()


def test_byte_characters_are_256_different_visible_ones():
    shown = byte_bpe.byte_characters()
    assert len(set(shown)) == 256 and all(c.isprintable() and not c.isspace() for c in shown)
    assert shown[ord("A")] == "A" and shown[ord(" ")] == "Ġ" and shown[ord("\n")] == "Ċ"


@pytest.mark.parametrize("path", [RANKS, OTHER_RANKS])
@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_merging_by_rank(text, path):
    assert ids_of(text, path) == library(path).encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \n\tab'sé1!日", max_size=60))
def test_any_text_encodes_and_comes_back(known, counted, text):
    ids = ids_of(text)
    assert ids == known.encode_ordinary(text)
    packed = np.array(ids, "<u4").tobytes()
    assert byte_bpe.codec(RANKS, PATTERN).decode(packed).decode() == text
    expected = len(counted.encode(text, add_special_tokens=False).ids)
    assert token_counts.merge_counter(VOCABULARY).count(text) == expected


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t\x0b  abc", max_size=30))
def test_units_make_up_the_text(text):
    assert "".join(cut(text)) == text


@pytest.mark.parametrize("text", ODD)
def test_counts_are_those_of_the_library(counted, text):
    expected = len(counted.encode(text, add_special_tokens=False).ids)
    assert token_counts.merge_counter(VOCABULARY).count(text) == expected


def test_forgetting_units_changes_nothing(known):
    one = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), PATTERN)
    one.packed = Kept(one._pack, 3)
    rng = random.Random(3)
    text = " ".join(rng.choice("one two three four five sixty-six".split()) for _ in range(200))
    assert np.frombuffer(one.encode(text), "<u4").tolist() == known.encode_ordinary(text)


def test_long_word_is_merged_whole(known):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(40_000))
    assert token_counts.merge_counter(VOCABULARY).count(text) == len(known.encode_ordinary(text))


def test_offsets_cover_split_characters(spark):
    rows = spark.createDataFrame([(1, "a 東b"), (2, None)], "k int, text string")
    found = rows.select("k", byte_bpe.encode_with_offsets("text", RANKS, PATTERN).alias("x"))
    a, b = found.orderBy("k").collect()
    spans = list(zip(a.x.starts, a.x.ends, strict=True))
    assert spans[0] == (0, 1) and spans[-1] == (3, 4)
    assert all((s, e) in {(1, 3), (2, 3)} for s, e in spans[1:-1]) and len(spans) > 3
    assert b.x.ids == []


def test_columns(spark):
    rows = spark.createDataFrame(
        [(1, "été 東", "x"), (2, None, "x"), (3, "", "x"), (1, "été 東", "x")],
        "k int, text string, ids string",
    )
    packed = rows.select("k", byte_bpe.encode("text", RANKS, PATTERN).alias("p"))
    out = packed.select(
        "k",
        byte_bpe.n_tokens("p").alias("n"),
        byte_bpe.unpack("p").alias("ids"),
        byte_bpe.decode_text("p", RANKS, PATTERN).alias("text"),
    ).orderBy("k")
    got = [tuple(r) for r in out.collect()]
    assert [g[3] for g in got] == ["été 東", "été 東", "", ""]
    assert got[0] == got[1] and got[0][1] == len(got[0][2]) and got[2][1:3] == (0, [])


def test_cut_sequences_decode_to_bytes(spark):
    ids = ids_of("東")
    assert len(ids) > 1
    part = np.array(ids[:1], "<u4").tobytes()
    rows = spark.createDataFrame([(part,), (None,)], "p binary")
    out = rows.select(
        byte_bpe.decode("p", RANKS, PATTERN).alias("b"),
        byte_bpe.decode_text("p", RANKS, PATTERN).alias("t"),
    ).collect()
    assert "東".encode().startswith(bytes(out[0].b)) and "�" in out[0].t
    assert out[1].b is None and out[1].t is None


def test_ids_outside_the_vocabulary_raise(spark):
    rows = spark.createDataFrame([(np.array([60_000], "<u4").tobytes(),)], "p binary")
    with pytest.raises(PythonException):
        rows.select(byte_bpe.decode("p", RANKS, PATTERN)).collect()


def test_queries_agree_with_the_libraries(spark, known, counted):
    texts = {
        r.doc_id: r.text or ""
        for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    }
    coded = {r.doc_id: r for r in op1_byte_bpe(spark, SMALL).collect()}
    counts = {r.doc_id: r for r in op6_token_counts(spark, SMALL).collect()}
    assert coded.keys() == counts.keys() == texts.keys()
    for k, text in texts.items():
        ids = known.encode_ordinary(text)
        assert coded[k].n_tokens == len(ids)
        assert coded[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert coded[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        n = len(counted.encode(text, add_special_tokens=False).ids)
        assert (counts[k].n_bytes, counts[k].n_tokens) == (len(text.encode()), n)
        assert counts[k].over_limit == (n > 1024)


def test_no_rows(spark):
    none = spark.createDataFrame([], "text string")
    assert none.select(byte_bpe.encode("text", RANKS, PATTERN)).count() == 0
    assert none.select(token_counts.count_tokens("text", VOCABULARY)).count() == 0


def test_vocabularies_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        token_counts.MergeCounter(public_tokenizers.path("word_bpe_49k.json"))
