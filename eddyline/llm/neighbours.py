"""Nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are packed into blocks.  Every query block meets every candidate block in one
tile, by a sort-merge join on the tile's two block numbers.  In a tile the int8 products give every
cosine up to a proven error: with u = s q + e for a unit vector, |u v - s t q r| is at most
|s q| |f| + |e| |v|.  Only pairs whose upper bound reaches the k-th best lower bound survive; their
cosines are computed from the original vectors in double precision and merged in a heap per query.
The result is exact: the bounds drop no pair that could be among the k nearest.

Products of int8 values are summed in float32 where the sums stay below 2^24, which is exact, and in
float64 beyond.

Vectors that are null, zero, or hold null or non-finite components take no part.  Vectors are
compared with those of equal length only.  Rows of the query's own id are not its neighbours.  Equal
scores go to the smaller id.  Rows with a null id take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.tables import written

#: Vectors in a block.
BLOCK_ROWS = 4096
#: Queries whose bounds are held at a time: this many times a block of floats.
_AT_ONCE = 512

_BLOCK = pa.schema(
    [
        ("size", pa.int32()),
        ("ids", pa.binary()),
        ("raw", pa.binary()),
        ("small", pa.binary()),
        ("scale", pa.binary()),
        ("rest", pa.binary()),
    ]
)
_BLOCK_DDL = "size int, ids binary, raw binary, small binary, scale binary, rest binary"


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch that take part, by vector length."""
    lists, ids = batch.column("vector"), batch.column("vec_id")
    lengths = np.array([-1 if v is None else v for v in lists.value_lengths().to_pylist()])
    lengths[ids.is_null().to_numpy(zero_copy_only=False)] = -1
    for size in np.unique(lengths[lengths > 0]):
        chosen = np.nonzero(lengths == size)[0]
        flat = lists.take(pa.array(chosen)).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(chosen), size).astype(np.float64)
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        own = ids.take(pa.array(chosen[good])).to_numpy(zero_copy_only=False)
        yield own.astype(np.int64), vectors[good]


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, summed component by component in order."""
    return np.sqrt(np.cumsum(vectors * vectors, axis=1)[:, -1])


def _packed(ids: np.ndarray, vectors: np.ndarray) -> dict:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    small = np.rint(unit / scale[:, None])
    rest = np.linalg.norm(unit - small * scale[:, None], axis=1)
    return {
        "size": vectors.shape[1],
        "ids": ids.tobytes(),
        "raw": vectors.tobytes(),
        "small": small.astype(np.int8).tobytes(),
        "scale": scale.tobytes(),
        "rest": rest.tobytes(),
    }


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of what a task reads; only the last of each vector length is not full."""
    open_blocks: dict[int, list] = {}
    for batch in batches:
        for ids, vectors in _vectors(batch):
            parts = open_blocks.setdefault(vectors.shape[1], [])
            for k in range(0, len(ids), BLOCK_ROWS):
                parts.append((ids[k : k + BLOCK_ROWS], vectors[k : k + BLOCK_ROWS]))
                if sum(len(p[0]) for p in parts) >= BLOCK_ROWS:
                    all_ids, all_vectors = map(np.concatenate, zip(*parts, strict=True))
                    full = _packed(all_ids[:BLOCK_ROWS], all_vectors[:BLOCK_ROWS])
                    yield pa.RecordBatch.from_pylist([full], _BLOCK)
                    parts[:] = [(all_ids[BLOCK_ROWS:], all_vectors[BLOCK_ROWS:])]
    for parts in open_blocks.values():
        ids, vectors = map(np.concatenate, zip(*parts, strict=True))
        if len(ids):
            yield pa.RecordBatch.from_pylist([_packed(ids, vectors)], _BLOCK)


def blocks(vectors: DataFrame, groups: int, name: str) -> DataFrame:
    """Packed blocks of ``vec_id, vector``, each with a number and one of so many groups."""
    packed = vectors.mapInArrow(_pack, _BLOCK_DDL)
    numbered = packed.withColumn("block", F.monotonically_increasing_id())
    return written(numbered, name).withColumn("place", F.pmod(F.xxhash64("block"), F.lit(groups)))


class _Block:
    def __init__(self, row: dict, side: str):
        n = row["size"]
        self.ids = np.frombuffer(row[f"{side}_ids"], np.int64)
        self.raw = np.frombuffer(row[f"{side}_raw"], np.float64).reshape(-1, n)
        exact = np.float32 if 127 * 127 * n < 1 << 24 else np.float64
        self.small = np.frombuffer(row[f"{side}_small"], np.int8).reshape(-1, n).astype(exact)
        self.scale = np.frombuffer(row[f"{side}_scale"], np.float64)
        self.rest = np.frombuffer(row[f"{side}_rest"], np.float64)
        self.length = _lengths(self.raw)


def _tile(query: _Block, other: _Block, heaps: list[list], k: int) -> None:
    """Merges a tile's best into the heaps of ``(score, -id)``, the worst on top."""
    for start in range(0, len(query.ids), _AT_ONCE):
        rows = slice(start, start + _AT_ONCE)
        near = (query.small[rows] @ other.small.T).astype(np.float64)
        near *= query.scale[rows, None] * other.scale[None, :]
        # |s q| is at most 1 + |e|; a little more for the rounding of these lines.
        slack = (1 + query.rest[rows, None]) * other.rest[None, :] + query.rest[rows, None] + 1e-9
        own = query.ids[rows, None] == other.ids[None, :]
        low = np.where(own, -np.inf, near - slack)
        known = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
        if low.shape[1] > k:
            kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            known = np.maximum(known, kth)
        at, to = np.nonzero((near + slack >= known[:, None]) & ~own)
        for part in range(0, len(at), 1 << 16):
            a, b = at[part : part + (1 << 16)] + start, to[part : part + (1 << 16)]
            dots = np.cumsum(query.raw[a] * other.raw[b], axis=1)[:, -1]
            scores = dots / (query.length[a] * other.length[b])
            for q, score, name in zip(a.tolist(), scores.tolist(), (-other.ids[b]).tolist()):
                heap = heaps[q]
                if len(heap) < k:
                    heapq.heappush(heap, (score, name))
                elif (score, name) > heap[0]:
                    heapq.heapreplace(heap, (score, name))


def nearest(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each query (``vec_id, vector``)."""
    vectors = vectors.select("vec_id", "vector")
    queries = vectors.where(is_query)
    n, q = vectors.count(), queries.count()
    columns, rows = max(1, -(-n // BLOCK_ROWS)), max(1, -(-q // BLOCK_ROWS))
    # Queries lie thin in the input: dealt out by id, a task gets about a block of them.
    own = blocks(queries.repartition(rows, F.xxhash64("vec_id")), rows, "query-blocks")
    all_blocks = blocks(vectors, columns, "blocks")

    def side(df: DataFrame, name: str, mine: str, other: str, others: int) -> DataFrame:
        there = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other)
        kept = [F.col(c).alias(f"{name}_{c}") for c in ("ids", "raw", "small", "scale", "rest")]
        more = [F.col("block").alias("query_block")] if name == "q" else []
        return df.select("size", F.col("place").alias(mine), there, *kept, *more)

    # Spark would measure the queries before they are copied once per column, and broadcast the copies.
    tiles = side(own, "q", "tile_row", "tile_column", columns).hint("merge").join(
        side(all_blocks, "c", "tile_column", "tile_row", rows), ["size", "tile_row", "tile_column"]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, query, heaps = None, None, []

        def found() -> Iterator[pa.RecordBatch]:
            if query is not None:
                best = [
                    (number, at, int(query.ids[at]), -name, score)
                    for at, heap in enumerate(heaps)
                    for score, name in heap
                ]
                columns = list(zip(*best, strict=True)) or [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                names = ["query_block", "at", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                if row["query_block"] != number:
                    yield from found()
                    number, query = row["query_block"], _Block(row, "q")
                    heaps = [[] for _ in query.ids]
                _tile(query, _Block(row, "c"), heaps, k)
        yield from found()

    best = tiles.mapInArrow(
        search, "query_block long, at long, query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_block", "at").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
