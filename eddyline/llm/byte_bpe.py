"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

The vocabulary is a rank file (``base64 rank`` per line).  Byte-level BPE needs its tokens as strings,
so each byte stands for one printable character; ``byte_characters`` is that table.  The merges are
every way to join two tokens into a third, in the order of the joined token's rank, which is what
merging by rank means.

* ``encode`` gives the ids packed as little-endian unsigned 32-bit integers, the layout of token
  shards; ``unpack`` turns them into an array and ``decode`` back into bytes.
* ``encode_with_offsets`` gives ids and the character span of each token.  A character whose bytes
  are split over several tokens belongs to each of their spans.
* ``decode`` reverses the byte table and returns bytes, since a cut sequence may end inside a
  character; ``decode_text`` makes text of it, with U+FFFD for the incomplete part.

Null text encodes like the empty text (no ids); null ids decode to null.  Texts are never cut
short; repeated rows get equal results.  Ids outside the vocabulary raise an error when decoded.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from eddyline.llm.units import Kept, cut


#: Rows whose results are held at a time.
_AT_ONCE = 512


def byte_characters() -> list[str]:
    """The printable character that stands for each byte.

    Bytes that are visible Latin-1 characters stand for themselves, the others for the characters
    from U+0100 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in set(visible))}
    return [chr(hidden.get(b, b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_by_rank(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that join into a token, lowest rank first.

    All splits of a token have its rank.  Among them the shorter left part comes first.
    """
    return [
        (token[:k], token[k:])
        for token in sorted(ranks, key=ranks.get)
        for k in range(1, len(token))
        if token[:k] in ranks and token[k:] in ranks
    ]


class Codec:
    """One rank file with one pre-tokenizer pattern, in one Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # One core per task: the library's own threads would compete with Spark's.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        shown = byte_characters()
        as_text = {token: "".join(shown[b] for b in token) for token in ranks}
        model = models.BPE(
            vocab={as_text[token]: rank for token, rank in ranks.items()},
            merges=[(as_text[a], as_text[b]) for a, b in merges_by_rank(ranks)],
        )
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        byte_of = {c: b for b, c in enumerate(shown)}
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = {
            k: bytes(byte_of[c] for c in self.tokenizer.id_to_token(k)) for k in range(size)
        }
        self.packed = Kept(self._pack, 150_000)

    def _pack(self, unit: str) -> bytes:
        return np.array(self.tokenizer.encode(unit).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a text; units not seen before go to the library together."""
        units = cut(text or "")
        known, old = self.packed, self.packed.old
        new = list({u for u in units if u not in known and u not in old})
        for unit, coded in zip(new, self.tokenizer.encode_batch_fast(new), strict=True):
            known.keep(unit, np.array(coded.ids, "<u4").tobytes())
        return b"".join(map(known.__getitem__, units))

    def with_offsets(self, text: str | None) -> tuple[list[int], list[int], list[int]]:
        coded = self.tokenizer.encode(text or "")
        return coded.ids, [a for a, _ in coded.offsets], [b for _, b in coded.offsets]

    def decode(self, packed: bytes | None) -> bytes | None:
        if packed is None:
            return None
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@functools.cache
def codec(vocabulary: str, pattern: str) -> Codec:
    """The codec of a file, built once in each Python worker."""
    return Codec(read_ranks(vocabulary), pattern)


def encode(text: Column | str, vocabulary: str, pattern: str) -> Column:
    """Packed ids of ``text``; ``vocabulary`` is a rank file that every executor can read."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        one = codec(vocabulary, pattern)
        return pa.array([one.encode(t.as_py()) for t in texts], pa.binary())

    return encoded(text)


def round_trip(text: Column | str, vocabulary: str, pattern: str) -> Column:
    """``struct(ids, decoded)``: packed ids, and the bytes that these ids decode to.

    Both in one call, so that a task needs one Python worker and encodes each text once.  Marked as
    not deterministic, which it is, so that Spark does not evaluate it for each of its fields.  Results
    leave the worker some rows at a time, so that it never holds those of a whole batch.
    """

    @F.arrow_udf("ids binary, decoded binary")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = codec(vocabulary, pattern)
        for texts in batches:
            for start in range(0, len(texts), _AT_ONCE):
                ids = [one.encode(t.as_py()) for t in texts.slice(start, _AT_ONCE)]
                columns = [pa.array(ids, pa.binary()), pa.array(map(one.decode, ids), pa.binary())]
                yield pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    return coded.asNondeterministic()(text)


def encode_with_offsets(text: Column | str, vocabulary: str, pattern: str) -> Column:
    """``struct(ids, starts, ends)``: the character span of each token, end exclusive."""

    @F.arrow_udf("ids array<int>, starts array<int>, ends array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        one = codec(vocabulary, pattern)
        rows = [one.with_offsets(t.as_py()) for t in texts]
        columns = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(3)]
        return pa.StructArray.from_arrays(columns, ["ids", "starts", "ends"])

    return encoded(text)


def decode(packed: Column | str, vocabulary: str, pattern: str) -> Column:
    """The bytes that packed ids stand for."""

    @F.arrow_udf("binary")
    def decoded(ids: pa.Array) -> pa.Array:
        one = codec(vocabulary, pattern)
        return pa.array([one.decode(p.as_py()) for p in ids], pa.binary())

    return decoded(packed)


def decode_text(packed: Column | str, vocabulary: str, pattern: str) -> Column:
    """Decoded text; bytes that are no whole character become U+FFFD."""

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        one = codec(vocabulary, pattern)
        coded = [one.decode(p.as_py()) for p in ids]
        return pa.array([c if c is None else c.decode("utf-8", "replace") for c in coded])

    return decoded(packed)


def unpack(packed: Column | str) -> Column:
    """Packed ids as an array."""

    @F.arrow_udf("array<bigint>")
    def unpacked(ids: pa.Array) -> pa.Array:
        arrays = [None if p.as_py() is None else np.frombuffer(p.as_py(), "<u4") for p in ids]
        return pa.array(arrays, pa.list_(pa.int64()))

    return unpacked(packed)


def n_tokens(packed: Column | str) -> Column:
    return F.shiftright(F.octet_length(packed), 2).cast("long")
