from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.llm import neighbours


def slow(rows, k):
    usable = []
    for name, vector in rows:
        if name is None or vector is None or not vector:
            continue
        if any(v is None or not np.isfinite(v) for v in vector) or not any(vector):
            continue
        usable.append((name, np.array(vector, float)))
    out = []
    for name, q in usable:
        if name % 50:
            continue
        scores = []
        for other, c in usable:
            if other != name and len(c) == len(q):
                dot = np.cumsum(q * c)[-1]
                size = np.sqrt(np.cumsum(q * q)[-1]) * np.sqrt(np.cumsum(c * c)[-1])
                scores.append((-dot / size, other))
        out += [(name, n + 1, other, -s) for n, (s, other) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 4096])
def test_against_loops(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=8) * 10.0 ** rng.integers(-3, 4)).tolist()) for k in range(300)]
    rows += [(300 + k, rows[k][1]) for k in range(60)]  # ties
    rows += [(k, rng.normal(size=3).tolist()) for k in (1000, 1001, 1003)]  # another length, few
    rows += [(400, None), (450, [0.0] * 8), (500, []), (None, [1.0] * 8), (550, [1.0, None] + [0.0] * 6)]
    rows += [(600, [float("nan")] * 8), (650, [float("inf")] + [1.0] * 7), (700, [1e-3] * 8), (701, [1e-3] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("size", F.lit("x"))
    found = neighbours.nearest(frame.repartition(6), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(tuple(r) for r in found) == slow(rows, 5)


def test_bounds_hold():
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(200, 64))
    row = neighbours._packed(np.arange(200), vectors)
    block = neighbours._Block({"size": 64, **{f"c_{k}": v for k, v in row.items()}}, "c")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (block.small @ block.small.T) * block.scale[:, None] * block.scale[None, :]
    slack = (1 + block.rest[:, None]) * block.rest[None, :] + block.rest[:, None]
    assert (np.abs(unit @ unit.T - near) <= slack + 1e-9).all()


def test_floats_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id int, vector array<float>")
    (row,) = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, 5).collect()
    assert (row.query_id, row["rank"], row.vec_id) == (0, 1, 1)
    assert row.score == pytest.approx(0.5**0.5)
    assert neighbours.nearest(frame.limit(0), F.lit(True), 5).count() == 0


def test_copies_of_queries_are_not_broadcast(spark):
    """Queries are copied once per block of candidates: with the input, that outgrows the driver."""
    rows = [(k, [1.0, float(k)]) for k in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    plan = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
