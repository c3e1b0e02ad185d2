"""SimHash near-duplicates with vantage-point trees.

A fingerprint has a bit set where over half the hashes of the word shingles have it.  Texts whose
fingerprints differ in at most two bits are linked; a component is all that is reachable.

1. Equal fingerprints collapse to one row first, with the smallest doc_id that has it, so copies
   cost nothing further on, however many they are.
2. A vantage-point tree over a bounded sample of fingerprints cuts the space into shards.  A node
   sends a fingerprint inside if its distance to the vantage point is at most the radius, else
   outside, and also inside if it is at most two beyond: by the triangle inequality two linked
   fingerprints then meet in a shard.  The sample only shapes the tree; every fingerprint is routed.
3. In a shard the same splitting goes on down to small leaves, which are compared exactly.  What
   leaves the shard is one row per member of a component of the shard, never the pairs.  Where a
   split no longer separates (thousands of fingerprints within a few bits), the leaf is joined by
   common neighbours instead: two fingerprints are within two bits of each other exactly if one of
   their 65 neighbours at zero or one bit is the same.
4. Shard components that share a fingerprint are joined by alternating star contraction; each round
   is a written table in the shared folder.

Null and empty texts, and texts of white space only, have fingerprint zero and are linked like any
other.  Texts of fewer words than a shingle have one shingle of all their words.  Repeated rows are
kept, each with the same component.  A null doc_id never becomes a component's name unless all its
members have none; the name is then null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.tables import written

BITS_APART = 2

#: Fingerprints per shard that the tree aims at.
SHARD_ROWS = 2_000
#: Most fingerprints that the driver sees to shape the tree, and the fewest of them per shard.
SAMPLE_ROWS, SAMPLE_PER_SHARD = 200_000, 8
#: Leaves of this size are compared pair by pair inside the task.
LEAF_ROWS = 384
#: A node is worth splitting if the copies leave no child with more than this share of it.
WORTHWHILE = 0.85

_AT_ONCE = 1 << 15
_NO_ID = (1 << 63) - 1


# -- fingerprints ---------------------------------------------------------------------------------


def fingerprint_of(text: str | None, shingle_words: int = 3) -> int:
    """The fingerprint of one text, as an unsigned integer.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at blanks and 0x09-0x0D only.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _AT_ONCE):
        stop = min(n, start + _AT_ONCE)
        runs = [words[start + k : stop + k] for k in range(shingle_words)]
        shingles = [b" ".join(words)] if n == 1 else map(b" ".join, zip(*runs, strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, shingle_words: int = 3) -> Column:
    """The 64 bits as a long (two's complement)."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = [fingerprint_of(t.as_py(), shingle_words) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprints(text)


def as_hex(fingerprint: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# -- vantage-point trees --------------------------------------------------------------------------


def split_at(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray]:
    """Vantage point, radius and distances of the split that leaves the smaller larger child.

    Vantage points are tried from the points themselves, evenly over their order.
    """
    best = None
    for vantage in points[:: max(1, len(points) // 5)][:5]:
        away = np.bitwise_count(points ^ vantage)
        radius = int(np.sort(away)[(len(away) - 1) // 2])
        for edge in (radius - 1, radius):
            inside = int((away <= edge + BITS_APART).sum())
            size = max(inside, int((away > edge).sum()))
            if best is None or size < best[0]:
                best = size, vantage, edge, away
    return best[1], best[2], best[3]


def parts_of(away: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Who goes inside and who goes outside; those just outside go both ways."""
    return away <= radius + BITS_APART, away > radius


class ShardTree:
    """Routes fingerprints to shards; a few numbers per shard."""

    def __init__(self, sample: np.ndarray, rows: int, shard_rows: int):
        self.vantages, self.radii, self.children, self.shards = [], [], [], 0
        least = max(SAMPLE_PER_SHARD, shard_rows * len(sample) / max(rows, 1))
        self._grow(sample, least)

    def _grow(self, points: np.ndarray, least: float) -> None:
        waiting = [(points, None)]
        while waiting:
            points, place = waiting.pop()
            name = None
            if len(points) > least:
                vantage, radius, away = split_at(points)
                inside, outside = parts_of(away, radius)
                if max(inside.sum(), outside.sum()) <= WORTHWHILE * len(points):
                    name = len(self.vantages)
                    self.vantages.append(vantage)
                    self.radii.append(radius)
                    self.children.append([0, 0])
                    waiting += [(points[outside], (name, 1)), (points[inside], (name, 0))]
            if name is None:
                name = -1 - self.shards
                self.shards += 1
            if place:
                self.children[place[0]][place[1]] = name

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and their shards; a row near a boundary has several."""
        rows, shards = [], []
        waiting = [(np.arange(len(points)), 0 if self.vantages else -1)]
        while waiting:
            at, name = waiting.pop()
            if name < 0:
                rows.append(at)
                shards.append(np.full(len(at), -1 - name))
            elif len(at):
                away = np.bitwise_count(points[at] ^ self.vantages[name])
                for side, part in enumerate(parts_of(away, self.radii[name])):
                    waiting.append((at[part], self.children[name][side]))
        return np.concatenate(rows), np.concatenate(shards)


class Forest:
    """Union-find over row numbers; a root is the smallest row of its component."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def join(self, firsts: np.ndarray, seconds: np.ndarray) -> None:
        for a, b in zip(firsts.tolist(), seconds.tolist(), strict=True):
            a, b = self.root(a), self.root(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)


def _join_leaf(points: np.ndarray, at: np.ndarray, forest: Forest) -> None:
    near = np.bitwise_count(points[at][:, None] ^ points[at][None, :]) <= BITS_APART
    first, second = np.nonzero(np.triu(near, 1))
    if len(first):
        forest.join(at[first], at[second])


def _join_dense(points: np.ndarray, at: np.ndarray, forest: Forest) -> None:
    """Joins rows that have a neighbour at zero or one bit in common; linear in the rows."""
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    own = points[at]
    passes = 1 + 65 * len(at) // 4_000_000
    for k in range(passes):
        keys, rows = [], []
        for flip in flips:
            mine = own ^ flip
            chosen = np.nonzero(mine % np.uint64(passes) == k)[0]
            keys.append(mine[chosen])
            rows.append(at[chosen])
        key, row = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        pairs = np.unique(np.stack([row[order][1:][same], row[order][:-1][same]]), axis=1)
        forest.join(pairs[0], pairs[1])


def components_in_shard(points: np.ndarray) -> np.ndarray:
    """The smallest row number of each row's component among these distinct fingerprints."""
    forest = Forest(len(points))
    waiting = [np.arange(len(points))]
    while waiting:
        at = waiting.pop()
        if len(at) <= LEAF_ROWS:
            _join_leaf(points, at, forest)
            continue
        _, radius, away = split_at(points[at])
        inside, outside = parts_of(away, radius)
        if max(inside.sum(), outside.sum()) > WORTHWHILE * len(at):
            _join_dense(points, at, forest)
        else:
            waiting += [at[inside], at[outside]]
    return np.array([forest.root(k) for k in range(len(points))], np.int64)


# -- distributed links ----------------------------------------------------------------------------


def _bounded_sample(prints: DataFrame, rows: int) -> np.ndarray:
    """At most about ``SAMPLE_ROWS`` fingerprints, chosen by a hash, in order."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    chosen = prints.where(F.pmod(F.xxhash64("print"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = chosen.select("print").toPandas()["print"].to_numpy(np.int64).view(np.uint64)
    return np.sort(found)


def _shard_components(prints: DataFrame, tree: ShardTree) -> DataFrame:
    """``print, node, root``: members of the components of two and more found in each shard."""

    @F.arrow_udf("array<int>")
    def shards_of(column: pa.Array) -> pa.Array:
        points = column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        rows, shards = tree.route(points)
        order = np.argsort(rows, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(points)))])
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(shards[order], pa.int32())
        )

    def members(shard: pd.DataFrame) -> pd.DataFrame:
        # Smallest doc_id first, so that the root of a component is its smallest node.
        shard = shard.sort_values(["first_id", "first_key", "print"], ignore_index=True)
        root = components_in_shard(shard["print"].to_numpy(np.int64).view(np.uint64))
        kept = np.bincount(root, minlength=len(root))[root] > 1
        return pd.DataFrame(
            {
                "print": shard["print"][kept],
                "root_id": shard["first_id"].to_numpy()[root][kept],
                "root_key": shard["first_key"].to_numpy()[root][kept],
                "root_print": shard["print"].to_numpy()[root][kept],
            }
        )

    routed = prints.select("print", "first_id", "first_key", F.explode(shards_of("print")).alias("shard"))
    found = routed.groupBy("shard").applyInPandas(
        members, "print long, root_id long, root_key long, root_print long"
    )
    return found.select("print", F.struct("root_id", "root_key", "root_print").alias("root"))


def star_components(links: DataFrame) -> DataFrame:
    """``node, label`` of ``a, b`` links: the smallest node reachable, for nodes other than it.

    Rounds of a large star (larger neighbours move to the smallest neighbour) and a small star (the
    smaller ones do), until the links no longer change; their number grows with the logarithm.
    """
    links = links.where("a != b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("label")
    )
    links = written(links.distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "label"))).first()
        if now == state or now[0] == 0:
            return links
        state = now
        both = links.select("node", "label").union(links.select("label", "node"))
        least = F.least("node", F.min("label").over(Window.partitionBy("node")))
        large = both.select("node", "label", least.alias("low")).where("label > node")
        large = large.select(F.col("label").alias("node"), F.col("low").alias("label")).distinct()
        low = F.min("label").over(Window.partitionBy("node"))
        small = large.select("node", "label", low.alias("low"))
        links = small.select("node", F.col("low").alias("label")).union(
            small.where("label > low").select(F.col("label"), F.col("low"))
        )
        links = written(links.distinct(), "links")


def near_duplicates(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, text_key, print, component_id, first`` for every row of ``docs`` (``doc_id, text``).

    ``text_key`` is a hash of the text.  ``first`` marks the row that stands for its component: the
    one of the smallest doc_id, then of the smallest key.  Rows that repeat it are marked as well.
    """
    own = written(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            fingerprint("text", shingle_words).alias("print"),
        ),
        "fingerprints",
    )
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    first = F.min(F.struct(own_id.alias("first_id"), F.col("text_key").alias("first_key")))
    prints = written(
        own.groupBy("print").agg(first.alias("first")).select("print", "first.*"), "prints"
    )
    rows = prints.count()
    tree = ShardTree(_bounded_sample(prints, rows), rows, SHARD_ROWS)
    members = written(_shard_components(prints, tree), "shard-components")

    low = F.min("root").over(Window.partitionBy("print"))
    touching = members.select("root", low.alias("low")).where("root != low").distinct()
    labels = star_components(touching.select(F.col("root").alias("a"), F.col("low").alias("b")))

    placed = members.groupBy("print").agg(F.min("root").alias("node"))
    named = placed.join(labels, "node", "left").select(
        "print", F.coalesce("label", "node").alias("root")
    )
    alone = F.struct(
        F.col("first_id").alias("root_id"),
        F.col("first_key").alias("root_key"),
        F.col("print").alias("root_print"),
    )
    lookup = prints.join(named, "print", "left").select("print", F.coalesce("root", alone).alias("root"))
    # Written, so that the join below has a plain exchange on both sides, which AQE can split where
    # one fingerprint has a large part of all rows.
    lookup = written(lookup.select("print", "root.*"), "components")
    real_id = F.when(F.col("root_id") != _NO_ID, F.col("root_id"))
    is_first = (
        (own_id == F.col("root_id"))
        & (F.col("text_key") == F.col("root_key"))
        & (F.col("print") == F.col("root_print"))
    )
    return own.join(lookup, "print").select(
        "doc_id", "text_key", "print", real_id.alias("component_id"), is_first.alias("first")
    )
