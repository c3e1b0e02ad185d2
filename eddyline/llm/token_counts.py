"""Token counts by heap-and-linked-list byte-pair merging; no ids are made.

The symbols of a piece stand in a doubly linked list, its adjacent pairs with a rank in a heap.  The
pair of the lowest rank is popped and merged until none is left: the count is the number of bytes
less the merges.  A popped entry whose symbols have changed meanwhile is passed over.  Time is
n log n in the length of the piece, however long it is.

The vocabulary is a byte-level BPE file of the ``tokenizers`` library, which also cuts the pieces.
Strings of added tokens inside a text count as one token each, the library's default.  Null text
counts as empty.
"""

from __future__ import annotations

import functools
import json
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from eddyline.llm.byte_bpe import byte_characters
from eddyline.llm.units import Kept, cut

#: Below this character the letter and number tables of ``regex`` and of the library are the same.
TABLES_DIFFER_FROM = "԰"

# Fixed value: the pre-tokenizer pattern built into the library's byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class MergeCounter:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        pre = layout["pre_tokenizer"] or {}
        if layout["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel":
            raise ValueError(f"{path} is no byte-level BPE vocabulary")
        if layout["normalizer"] or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"{path} changes the text before it cuts pieces, which is not counted")
        added = layout["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has added tokens that match by more than their string")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None

        ids = layout["model"]["vocab"]
        self.first = [ids[c] for c in byte_characters()]
        # left id and right id, 32 bits each -> rank; rank -> joined id
        self.ranks, self.joined = {}, []
        for rank, merge in enumerate(layout["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.joined.append(ids[left + right])
        self.cut_pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.find_pieces = regex.compile(PIECES).findall
        self.piece_counts = Kept(self._count_piece, 250_000)
        self.unit_counts = Kept(self._count_unit, 500_000)

    def _count_piece(self, piece: str) -> int:
        data = piece.encode()
        n = len(data)
        known, joined = self.ranks.get, self.joined
        symbols = [self.first[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank * n + position of the left symbol: lowest rank first, then leftmost
        for k in range(n - 1):
            rank = known(symbols[k] << 32 | symbols[k + 1])
            if rank is not None:
                heap.append(rank * n + k)
        heapify(heap)
        merges = 0
        while heap:
            entry = heappop(heap)
            k, rank = entry % n, entry // n
            symbol, right = symbols[k], after[k]
            if symbol < 0 or right == n or known(symbol << 32 | symbols[right]) != rank:
                continue
            new, beyond, left = joined[rank], after[right], before[k]
            symbols[k], symbols[right], after[k] = new, -1, beyond
            merges += 1
            if beyond < n:
                before[beyond] = k
                rank = known(new << 32 | symbols[beyond])
                if rank is not None:
                    heappush(heap, rank * n + k)
            if left >= 0:
                rank = known(symbols[left] << 32 | new)
                if rank is not None:
                    heappush(heap, rank * n + left)
        return n - merges

    def _count_unit(self, unit: str) -> int:
        if max(unit) < TABLES_DIFFER_FROM:
            pieces = self.find_pieces(unit)
        else:
            pieces = [unit[a:b] for _, (a, b) in self.cut_pieces(unit)]
        return sum(map(self.piece_counts.__getitem__, pieces))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.added.split(text) if self.added else [text]
        own = sum(sum(map(self.unit_counts.__getitem__, cut(part))) for part in parts)
        return own + len(parts) - 1


@functools.cache
def merge_counter(path: str) -> MergeCounter:
    """The counter of a file, built once in each Python worker."""
    return MergeCounter(path)


def count_tokens(text: Column | str, vocabulary: str) -> Column:
    """The number of tokens of ``text``; every executor must be able to read ``vocabulary``."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = merge_counter(vocabulary).count
        return pa.array([count(t.as_py()) for t in texts], pa.int64())

    return counted(text)
