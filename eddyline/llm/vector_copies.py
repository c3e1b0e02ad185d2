"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of one group (a label) and one length are linked where their cosine reaches a threshold; a
component is all that is reachable.  Every such pair is found:

1. Equal vectors collapse to one node first, so copies cost nothing further on, however many they are.
2. A bounded sample gives the principal axes of the unit vectors, an orthonormal basis in order of
   what the axes hold.  It only sets the order of the work: a rotation changes no product.
3. The nodes of a group are put in order of cells of the first axes and cut into blocks.  Two blocks meet
   unless the boxes around their first coordinates are further apart than linked vectors can be.
4. In a tile the products are summed over the leading axes first.  What the other axes can add is at most
   the product of the two suffix norms; pairs that cannot reach the threshold are given up, and a tile
   with no pair left ends.  The others' cosines are computed from the original vectors in double precision.
5. A tile sends on one row for each node with a link: the number of vectors that it links to there, and
   the smallest node of its component in the tile.  Components of tiles are joined by star contraction.

Vectors that are null, zero, or hold null or non-finite components, and those of a null label, are
linked with nothing; each is its own component.  -0.0 equals 0.0.  Rows that repeat a vec_id are vectors
of their own.  A null vec_id never names a component unless all its members have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.simhash import star_components
from eddyline.llm.tables import written

#: Vectors and numbers in a block, and at most so many vectors that the driver sees to find the axes.
BLOCK_ROWS, BLOCK_NUMBERS, SAMPLE_ROWS = 2048, 1 << 19, 10_000
#: Tiles that a task compares at most, where there are many of them.
TASK_TILES = 64
#: Axes whose coordinates bound a block, and the width of a cell of the first ones.
BOX_AXES, CELL_AXES, CELL = 6, 3, 0.2
#: Axes that are summed at a time at first; each further step takes as many as all before it.
FIRST_AXES = 8
#: Pairs that are held one by one at a time, and the share of a tile below which they are.
PAIRS_AT_ONCE, FEW = 1 << 17, 0.02
#: More than the rounding of a sum of products of unit vectors of 100,000 components.
SLACK = 1e-9

_NO_ID = (1 << 63) - 1


# -- axes -----------------------------------------------------------------------------------------


def units(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def axes_of(vectors: np.ndarray) -> np.ndarray:
    """Columns: the axes on which the unit vectors lie, those that hold most of them first."""
    unit = units(vectors)
    held, axes = np.linalg.eigh(unit.T @ unit)
    return axes[:, np.argsort(-held, kind="stable")]


def _axes(nodes: DataFrame, most: int) -> dict[int, np.ndarray]:
    """The axes for each vector length in a sample of about ``most`` rows that a hash chooses."""
    share = min(1.0, most / max(nodes.count(), 1))
    chosen = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30)))
    by_size: dict[int, list] = {}
    for row in chosen.select("vector").toArrow()["vector"].to_pylist():
        by_size.setdefault(len(row), []).append(row)
    # An axis system of d lengths needs d times d numbers; beyond that the own axes serve as well.
    return {n: axes_of(np.array(rows, float)) for n, rows in by_size.items() if n <= 4096}


def _turned(vectors: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    unit = units(vectors)
    return unit @ axes[unit.shape[1]] if unit.shape[1] in axes else unit


# -- tiles ----------------------------------------------------------------------------------------


class Block:
    """Nodes of one group: originals, coordinates on the axes, and what lies behind each step."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, raw: np.ndarray, axes: dict[int, np.ndarray]):
        self.nodes, self.copies = nodes, copies
        # By a power of two, which rounds nothing, so that squares neither overflow nor vanish.
        self.raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
        self.turned = _turned(raw, axes)
        size = raw.shape[1]
        self.steps = [0, min(FIRST_AXES, size)]
        while self.steps[-1] < size:
            self.steps.append(min(size, 2 * self.steps[-1]))
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        behind = np.concatenate([squares, np.zeros((len(raw), 1))], axis=1)
        self.rest = np.sqrt(np.maximum(behind, 0))

    def lengths(self) -> np.ndarray:
        return np.sqrt(np.cumsum(self.raw * self.raw, axis=1)[:, -1])


def _candidates(one: Block, other: Block, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs whose cosine may reach ``least``, some at a time."""
    steps = list(pairwise(one.steps))
    total = np.zeros((len(one.nodes), len(other.nodes)))
    for k, (a, b) in enumerate(steps):
        total += one.turned[:, a:b] @ other.turned[:, a:b].T
        bound = total + one.rest[:, b, None] * other.rest[None, :, b]
        rows, columns = np.nonzero(bound >= least - SLACK)
        if one is other:
            later = columns > rows
            rows, columns = rows[later], columns[later]
        if not len(rows):
            return
        if k + 1 == len(steps) or len(rows) <= FEW * total.size:
            break
    for start in range(0, len(rows), PAIRS_AT_ONCE):
        r, c = rows[start : start + PAIRS_AT_ONCE], columns[start : start + PAIRS_AT_ONCE]
        sums = total[r, c]
        for a, b in steps[k + 1 :]:
            sums = sums + np.einsum("ij,ij->i", one.turned[r, a:b], other.turned[c, a:b])
            near = sums + one.rest[r, b] * other.rest[c, b] >= least - SLACK
            r, c, sums = r[near], c[near], sums[near]
        yield r, c


def linked_pairs(one: Block, other: Block, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of two blocks, or of one block with itself, that are linked."""
    own, theirs = one.lengths(), other.lengths()
    for rows, columns in _candidates(one, other, least):
        for start in range(0, len(rows), PAIRS_AT_ONCE >> 2):
            r, c = rows[start : start + (PAIRS_AT_ONCE >> 2)], columns[start : start + (PAIRS_AT_ONCE >> 2)]
            # Summed component by component in order.
            dots = np.cumsum(one.raw[r] * other.raw[c], axis=1)[:, -1]
            near = dots / (own[r] * theirs[c]) >= least
            if near.any():
                yield r[near], c[near]


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of rows after links ``a, b``: the smallest row of each component."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def tile(one: Block, other: Block, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with links between two blocks: node, vectors linked to, smallest node of its component."""
    same = one is other
    # Rows of both blocks in one order, that of their nodes, so that a smallest row is a smallest node.
    nodes = one.nodes if same else np.concatenate([one.nodes, other.nodes])
    order = np.argsort(nodes, kind="stable")
    place = np.empty(len(nodes), np.int64)
    place[order] = np.arange(len(nodes))
    first, second = place[: len(one.nodes)], place if same else place[len(one.nodes) :]
    copies = (one.copies if same else np.concatenate([one.copies, other.copies]))[order]
    label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
    for rows, columns in linked_pairs(one, other, least):
        a, b = first[rows], second[columns]
        links += np.bincount(a, copies[b], len(nodes)).astype(np.int64)
        links += np.bincount(b, copies[a], len(nodes)).astype(np.int64)
        label = merged(label, a, b)
    found = np.nonzero(links)[0]
    return nodes[order][found], links[found], nodes[order][label[found]]


# -- blocks ---------------------------------------------------------------------------------------

_BLOCK = pa.schema(
    [
        ("group", pa.string()), ("size", pa.int32()), ("nodes", pa.binary()), ("copies", pa.binary()),
        ("raw", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
    ]
)
_BLOCK_DDL = (
    "group string, size int, nodes binary, copies binary, raw binary, low array<double>, high array<double>"
)


def _with_cells(nodes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cells`` on the first axes, and the coordinate on the next, as the order of the nodes."""

    @F.arrow_udf("array<double>")
    def cells(vectors: pa.Array) -> pa.Array:
        out: list = [None] * len(vectors)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(lengths):
            at = np.nonzero(lengths == size)[0]
            flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            turned = _turned(flat.reshape(len(at), size).astype(np.float64), axes)[:, : CELL_AXES + 1]
            turned[:, :CELL_AXES] = np.floor(turned[:, :CELL_AXES] / CELL)
            for k, row in zip(at.tolist(), turned.tolist(), strict=True):
                out[k] = row
        return pa.array(out, pa.list_(pa.float64()))

    return nodes.withColumn("cells", cells("vector"))


def _packed(group: str, parts: list[tuple], axes: dict[int, np.ndarray]) -> dict:
    nodes, copies, vectors = map(np.concatenate, zip(*parts, strict=True))
    box = _turned(vectors, axes)[:, :BOX_AXES]
    return {
        "group": group, "size": vectors.shape[1], "nodes": nodes.tobytes(), "copies": copies.tobytes(),
        "raw": vectors.tobytes(), "low": box.min(axis=0).tolist(), "high": box.max(axis=0).tolist(),
    }


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], tuple]]:
    """The rows of a sorted batch that share group and length: nodes, copies and vectors as arrays."""
    vectors = batch.column("vector")
    lengths = vectors.value_lengths().to_pylist()
    keys = list(zip(batch.column("group").to_pylist(), lengths, strict=True))
    numbers = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "copies")]
    cuts = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
    for a, b in pairwise([0, *cuts, len(keys)] if keys else []):
        flat = vectors.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        yield keys[a], (numbers[0][a:b], numbers[1][a:b], flat.reshape(b - a, keys[a][1]).astype(np.float64))


def _blocks(nodes: DataFrame, axes: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, held = None, [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_packed(key[0], parts, axes)], _BLOCK)

        for batch in batches:
            for now, columns in _runs(batch):
                if parts and now != key:
                    yield block()
                    parts, held = [], 0
                key, most = now, max(16, min(block_rows, BLOCK_NUMBERS // now[1]))
                start, n = 0, len(columns[0])
                while start < n:
                    stop = min(n, start + most - held)
                    parts.append(tuple(c[start:stop] for c in columns))
                    start, held = stop, held + stop - start
                    if held == most:
                        yield block()
                        parts, held = [], 0
        if parts:
            yield block()

    # A vector alone in its group has nobody to be compared with.
    groups = nodes.groupBy("group", "size").count().where("count > 1").drop("count")
    nodes = _with_cells(nodes.join(groups, ["group", "size"], "left_semi"), axes)
    order = ["group", "size", "cells", "node"]
    ordered = nodes.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = ordered.select("group", "node", "copies", "vector").mapInArrow(pack, _BLOCK_DDL)
    return written(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _block_pairs(blocks: DataFrame, least: float) -> DataFrame:
    """``one, other``: blocks of a group, each with itself and others, whose boxes are near enough."""
    # Unit vectors of this cosine are so far apart; so boxes further apart hold no linked pair.
    reach = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    boxes = blocks.select("group", "size", "block", "low", "high")
    # By the first coordinate only blocks in equal or neighbouring stretches can be near: each block
    # stands in all stretches that it covers, widened by the reach on one side.
    stretch = max(reach, CELL)

    def spread(df: DataFrame, name: str, widened: float) -> DataFrame:
        first, last = (F.floor((df[c][0] + w) / stretch) for c, w in (("low", -widened), ("high", widened)))
        names = {c: f"{name}_{c}" for c in ("block", "low", "high")}
        return df.withColumn("stretch", F.explode(F.sequence(first, last))).withColumnsRenamed(names)

    both = spread(boxes, "a", reach).join(spread(boxes, "b", 0.0), ["group", "size", "stretch"])
    gap = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    apart = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    near = both.where((F.col("a_block") <= F.col("b_block")) & (apart <= reach * reach))
    near = near.select("a_block", "b_block").distinct()
    # Either may come first, so that no block stands in most tiles of one side.
    turned = F.xxhash64("a_block", "b_block") % 2 == 0
    return near.select(
        F.when(turned, F.col("b_block")).otherwise(F.col("a_block")).alias("one"),
        F.when(turned, F.col("a_block")).otherwise(F.col("b_block")).alias("other"),
    )


def _tiles(blocks: DataFrame, axes: dict[int, np.ndarray], least: float) -> DataFrame:
    """``node, links, low`` of each tile's nodes with links."""

    def block(row: dict, side: str) -> Block:
        numbers = [np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("nodes", "copies")]
        raw = np.frombuffer(row[f"{side}_raw"], np.float64).reshape(-1, row["size"])
        return Block(*numbers, raw, axes)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                one = block(row, "a")
                other = one if row["one"] == row["other"] else block(row, "b")
                columns = tile(one, other, least)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "low"])

    def side(name: str, of: str) -> DataFrame:
        kept = [F.col(c).alias(f"{name}_{c}") for c in ("nodes", "copies", "raw")]
        return blocks.select(F.col("block").alias(of), *kept, *(["size"] if name == "a" else []))

    pairs = written(_block_pairs(blocks, least), "block-pairs")
    count = pairs.count()
    both = pairs.join(side("a", "one"), "one").join(side("b", "other"), "other")
    # Dealt out by number: a tile is far more work than its bytes tell.
    tasks = max(min(count, TASK_TILES), -(-count // TASK_TILES), 1)
    both = both.repartition(tasks, "one", "other")
    return both.mapInArrow(compare, "node long, links long, low long")


def near_duplicates(vectors: DataFrame, least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, label, vector``).

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id of the
    component, ``kept`` says whether it is the row's own.  ``least`` is positive.
    """
    if not least > 0:
        raise ValueError("the threshold must be positive")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    # 0.0 is added so that the two zeros are one.
    plain = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))
    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.when(F.coalesce(usable, F.lit(False)), plain).alias("vector"),
    ).select(
        "*", F.xxhash64("label", "vector").alias("key"), F.xxhash64(F.lit(7), "vector", "label").alias("check")
    )
    own = written(own, "vectors")
    used = own.where("vector IS NOT NULL")
    own_id = F.coalesce("vec_id", F.lit(_NO_ID))
    nodes = used.groupBy("key", "check").agg(
        F.count("*").alias("copies"), F.min(own_id).alias("first_id"),
        F.any_value("vector").alias("vector"), F.any_value("label").alias("label"),
    )
    nodes = nodes.select(
        "*", F.monotonically_increasing_id().alias("node"), F.size("vector").alias("size"),
        F.col("label").cast("string").alias("group"),
    )
    nodes = written(nodes, "vector-nodes")
    axes = _axes(nodes, SAMPLE_ROWS)
    tiles = written(_tiles(_blocks(nodes.drop("label"), axes, block_rows), axes, least), "tiles")

    linked = tiles.groupBy("node").agg(F.sum("links").alias("links"), F.min("low").alias("root"))
    least_root = F.min("low").over(Window.partitionBy("node"))
    touching = tiles.select("low", least_root.alias("root")).where("low <> root").distinct()
    labels = star_components(touching.select(F.col("low").alias("a"), F.col("root").alias("b")))
    labels = labels.select(F.col("node").alias("root"), F.col("label").alias("component"))
    placed = linked.join(labels, "root", "left").select(
        "node", "links", F.coalesce("component", "root").alias("component")
    )
    placed = written(nodes.select("node", "key", "check", "copies", "first_id").join(placed, "node", "left"), "placed")
    component = F.coalesce("component", "node").alias("component")
    names = placed.groupBy(component).agg(F.min("first_id").alias("name"))
    lookup = placed.select(
        "key", "check", component, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ).join(names, "component")
    # Written, so that the join below has a plain exchange on both sides, which AQE can split.
    lookup = written(lookup.select("key", "check", "n_links", "name"), "linked-vectors")
    name = F.when(F.col("name") != _NO_ID, F.col("name"))
    both = used.select("vec_id", "key", "check").join(lookup, ["key", "check"]).select(
        "vec_id", "n_links", name.alias("component_id")
    )
    alone = own.where("vector IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return both.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
