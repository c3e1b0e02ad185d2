from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from eddyline.llm import simhash
from eddyline.llm.queries import op10_simhash

SMALL = "/root/testdata/sf0.001"


def slow_print(text):
    words = [w for w in _split(text or "")]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def slow_components(prints):
    """Smallest place reachable over links of at most two bits."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(len(prints)):
                near = (prints[a] ^ prints[b]).bit_count() <= 2
                if near and label[b] > label[a]:
                    label[b], changed = label[a], True
    return label


@pytest.mark.parametrize(
    "text",
    [
        None, "", " \t\n", "One", "one TWO", "one two three", "É é ÀB c d", "a b c d a b c a b c",
        " ".join(str(k % 97) for k in range(40_000)),
    ],
)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == slow_print(text)


def crowd(rng, n, centres, flips):
    """Fingerprints around some centres and far from them."""
    out = set()
    middles = [rng.getrandbits(64) for _ in range(centres)]
    while len(out) < n:
        p = rng.choice(middles) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, flips)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("leaf, flips", [(16, 3), (16, 8), (8, 2), (400, 5)])
def test_tree_in_a_shard_misses_no_link(monkeypatch, leaf, flips):
    monkeypatch.setattr(simhash, "LEAF_ROWS", leaf)
    points = crowd(random.Random(leaf + flips), 300, 6, flips)
    found = simhash.components_in_shard(points)
    assert found.tolist() == slow_components([int(p) for p in points])


def test_dense_leaf_is_joined_exactly():
    points = crowd(random.Random(9), 250, 1, 4)
    forest = simhash.Forest(len(points))
    simhash._join_dense(points, np.arange(len(points)), forest)
    found = [forest.root(k) for k in range(len(points))]
    assert found == slow_components([int(p) for p in points])


def test_linked_prints_share_a_shard():
    points = crowd(random.Random(4), 800, 30, 3)
    tree = simhash.ShardTree(points[::3], len(points), 40)
    rows, shards = tree.route(points)
    at = [set() for _ in points]
    for row, shard in zip(rows.tolist(), shards.tolist(), strict=True):
        at[row].add(shard)
    assert tree.shards > 4
    for a in range(len(points)):
        for b in range(a):
            if int(points[a] ^ points[b]).bit_count() <= 2:
                assert at[a] & at[b]


def test_components_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 20)
    rng = random.Random(12)
    base = ["w%d" % rng.randrange(400) for _ in range(400)]
    rows = []
    for k in range(160):
        words = list(base) if k % 2 else ["v%d" % rng.randrange(10**6) for _ in range(60)]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "edit%d" % rng.randrange(10**6)
        rows.append((1000 - k, " ".join(words), "src"))
    rows += [(5, rows[1][1], None), (7, None, None), (8, "", "x"), (None, "   ", "x"), (None, "só um", "x"), (9, rows[0][1], "x"), (9, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print string").repartition(5)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    order = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    prints = [r.print & (1 << 64) - 1 for r in order]
    expected = slow_components(prints)
    assert [r.component_id for r in order] == [order[k].doc_id for k in expected]
    firsts = {}
    for r in found:
        if r["first"]:
            firsts.setdefault(r.component_id, set()).add((r.doc_id, r.text_key))
    assert all(len(v) == 1 for k, v in firsts.items() if k is not None)
    assert {r.component_id for r in found} == firsts.keys()


def test_stars_join_long_chains(spark):
    chain = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (200, 200)]
    links = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.label for r in simhash.star_components(links).collect()}
    assert found == {**{k: 1 for k in range(2, 61)}, 101: 100}


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    ids = sorted(d.doc_id for d in docs)
    texts = {d.doc_id: d.text for d in docs}
    prints = [slow_print(texts[k]) for k in ids]
    labels = slow_components(prints)
    expected = {
        (k, f"{p:016x}", ids[label]) for k, p, label in zip(ids, prints, labels, strict=True)
    }
    assert {tuple(r) for r in op10_simhash(spark, SMALL).collect()} == expected


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
