from __future__ import annotations

import math
import random

import numpy as np
import pytest

from eddyline.llm import vector_copies
from eddyline.llm.queries import op13_vector_copies

DDL = "vec_id long, label int, vector array<double>"


def usable(label, v):
    return (
        label is not None and v is not None and len(v) > 0
        and all(x is not None and math.isfinite(x) for x in v) and any(v)
    )


def slow(rows, least):
    """Sorted ``vec_id, n_links, component_id, kept`` from all pairs."""
    n = len(rows)
    near = [set() for _ in rows]
    for a in range(n):
        for b in range(a):
            (_, la, va), (_, lb, vb) = rows[a], rows[b]
            if usable(la, va) and usable(lb, vb) and la == lb and len(va) == len(vb):
                x, y = np.array(va, float), np.array(vb, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for k in range(n):
        seen, waiting = {k}, [k]
        while waiting:
            for other in near[waiting.pop()] - seen:
                seen.add(other)
                waiting.append(other)
        name = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[k][0], len(near[k]), name, rows[k][0] == name))
    return sorted(out, key=str)


def found(spark, rows, least, **more):
    df = spark.createDataFrame(rows, DDL)
    got = vector_copies.near_duplicates(df, least, **more)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted([tuple(r) for r in got.collect()], key=str)


def crowd(seed, n, size, labels=3):
    """Vectors around a few middles, so that there are links, chains and strangers."""
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(max(2, n // 12), size))
    rows = []
    for k in range(n):
        v = middles[draw.integers(len(middles))] + draw.normal(size=size) * draw.choice([0, 0.05, 0.12, 0.5])
        rows.append((int(draw.integers(n)), int(draw.integers(labels)), v.tolist()))
    return rows


@pytest.mark.parametrize("least", [0.98, 0.7])
@pytest.mark.parametrize("block_rows", [7, 2048])
def test_against_all_pairs(spark, least, block_rows):
    rows = crowd(1, 240, 24)
    want = slow(rows, least)
    assert max(r[1] for r in want) > 2
    assert found(spark, rows, least, block_rows=block_rows) == want


def test_chain_over_blocks(spark):
    # Each vector is linked to the next ones only; the chain goes through all blocks.
    rows = [(900 - k, 1, [math.cos(k / 12), math.sin(k / 12), 0.3]) for k in range(60)]
    got = found(spark, rows, 0.98, block_rows=16)
    assert got == slow(rows, 0.98)
    assert {r[2] for r in got} == {841} and sum(r[3] for r in got) == 1


def test_many_copies_count_without_pairs(spark):
    rows = [(k, 0, [1.0, 2.0, 3.0]) for k in range(3000)] + [(5000, 0, [1.0, 2.0, 3.05]), (5001, 1, [1.0, 2.0, 3.0])]
    got = {r[0]: r[1:] for r in found(spark, rows, 0.98)}
    assert got[17] == (3000, 0, False) and got[0] == (3000, 0, True)
    assert got[5000] == (3000, 0, False) and got[5001] == (0, 5001, True)


def test_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (1, 0, None), (2, 0, [0.0, 0.0]), (3, 0, [1.0, None]), (4, 0, [1.0, nan]), (5, 0, [inf, 1.0]), (6, None, [1.0, 1.0]),
        (7, None, [1.0, 1.0]), (8, 0, [1.0, 1.0]), (9, 0, [2.0, 2.0]), (9, 0, [2.0, 2.0]), (None, 0, [3.0, 3.0]), (None, 2, [1.0, 0.0]),
        (None, 2, [1.0, 0.01]), (10, 0, [1.0, 1.0, 0.0]), (11, 0, [-1.0, -1.0]), (12, 3, [0.0, 1.0]), (13, 3, [-0.0, 1.0]),
        (14, 4, [1e300, 1e300]), (15, 4, [1e-300, 1e-300]), (None, None, None), (16, 0, []),
    ]
    got = found(spark, rows, 0.98)
    want = slow([r for r in rows if r[0] not in (14, 15)], 0.98)
    assert [r for r in got if r[0] not in (14, 15)] == [
        (a, b, c, True if a is None and c is None else d) for a, b, c, d in want
    ]
    assert [r[1] for r in got if r[0] in (14, 15)] == [1, 1]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "label AS node", "vec_id AS key", "vec_id AS block")
    again = vector_copies.near_duplicates(df, 0.98)
    assert sorted([tuple(r) for r in again.collect()], key=str) == got
    assert vector_copies.near_duplicates(df.limit(0), 0.98).collect() == []


def test_tiles_give_up_pairs_that_cannot_reach(monkeypatch):
    draw = np.random.default_rng(5)
    raw = draw.normal(size=(300, 64))
    raw[150:] = raw[:150] + draw.normal(size=(150, 64)) * 0.05
    axes = {64: vector_copies.axes_of(raw)}
    # The axes are a rotation.
    assert np.allclose(axes[64] @ axes[64].T, np.eye(64))
    block = vector_copies.Block(np.arange(300), np.ones(300, np.int64), raw, axes)
    pairs = [p for rows, columns in vector_copies.linked_pairs(block, block, 0.98) for p in zip(rows.tolist(), columns.tolist(), strict=True)]
    assert sorted(pairs) == [(k, k + 150) for k in range(150)]
    tried = sum(len(rows) for rows, _ in vector_copies._candidates(block, block, 0.98))
    assert tried < 400


def test_labels_of_links_are_smallest_rows():
    draw = random.Random(3)
    for _ in range(50):
        n = draw.randrange(1, 40)
        links = [(draw.randrange(n), draw.randrange(n)) for _ in range(draw.randrange(n))]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        label = vector_copies.merged(np.arange(n), a, b)
        want = list(range(n))
        for _ in range(n):
            for x, y in links:
                want[x] = want[y] = min(want[x], want[y])
        assert label.tolist() == want


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = sorted([tuple(r) for r in op13_vector_copies(spark, folder).collect()], key=str)
    assert got == slow(rows, 0.98)
