"""Hard negatives against plain scoring of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_negatives(rows, anchor=lambda i: i is not None and i % 4 == 0, scale=256.0):
    """rows (id, vector, label); anchors that are whole copies count once."""
    taken = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x * scale) for x in v):
            taken.append((i, tuple(math.floor(x * scale) for x in v), label))
    order = lambda s, i: (-s, i is None, i or 0)
    limit = (1 << 63) - 1
    score = lambda a, b: max(-limit, min(limit, sum(x * y for x, y in zip(a, b))))
    out = []
    width = max((len(v) for _, v, _ in taken), default=0)
    whole = {(i, v + (0,) * (width - len(v)), label) for i, v, label in taken}
    for i, v, label in [w for w in whole if anchor(w[0])]:
        positive = sorted((order(score(v, w), j) for j, w, other in taken if other == label and (j is None or j != i)))[:5]
        for p in positive:
            ps = -p[0]
            negative = sorted(order(score(v, w), j) for j, w, other in taken if other != label and 50 * ps <= 100 * score(v, w) <= 95 * ps)[:3]
            out += [(i, None if p[1] else p[2], k, None if n[1] else n[2], ps, -n[0]) for k, n in enumerate(negative, 1)]
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("id", "x", "tile", "kind", "anchor", "windows", "bits", "shard", "block", "best")])
    got = hn.hard_negatives(df, df["vec_id"], df["embedding"], df["label"], F.col("id") % 4 == 0, **more)
    return sorted(map(tuple, got.collect()), key=repr)


def clouds(seed, n, dim, labels):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=dim)
    return [(k, (base + rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("seed, n, dim, labels", [(1, 300, 64, 3), (2, 200, 5, 2), (3, 200, 100, 10), (4, 60, 1, 2)])
def test_against_all_pairs(spark, seed, n, dim, labels):
    rows = clouds(seed, n, dim, labels)
    want = plain_negatives(rows)
    assert found(spark, rows) == want and len(want) > 20


def test_many_tiles(spark, monkeypatch):
    """Several blocks of anchors and shards of rows, a hot vector among them."""
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 12)
    monkeypatch.setattr(hn, "SHARD_ROWS", 50)
    rows = clouds(5, 200, 16, 3)
    rows += [(1000 + k, rows[8][1], k % 2) for k in range(150)]
    assert found(spark, rows) == plain_negatives(rows)


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = clouds(6, 60, 8, 2)
    rows += [(4, rows[4][1], rows[4][2]), (8, rows[9][1], 1), (8, rows[9][1], 0),  # repeated as a whole; another row of the same id
             (None, rows[12][1], 0), (None, rows[12][1], 1), (100, None, 1), (104, rows[0][1], None), (108, [1.0, None], 1), (112, [nan] * 8, 1),
             (116, [inf] * 8, 0), (120, [], 1), (124, [0.5], 0), (128, [0.5, 0.25] * 6, 1), (132, [-0.0] * 8, 0), (136, [1e30] * 8, 1),
             (140, [-1e30, 1e30], 0), (144, [3e38] * 8, 0), (148, rows[0][1], 77)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert found(spark, rows) == plain_negatives(rows)
    assert found(spark, []) == [] and found(spark, rows[:1]) == []
    assert found(spark, [(0, None, 1)]) == []


def test_intervals_hold_and_prune(spark):
    """Every true score lies within its interval, and the codes drop pairs."""
    rng = np.random.default_rng(7)
    for dim in (3, 64, 130):
        x = np.floor(rng.normal(size=(400, dim)) * 100)
        x[5] = 0
        anchors = hn.Anchors(x[:40])
        bits, align, left = hn.codes(x)
        rows = {"bits": bits, "align": align, "left": left, "label": np.zeros(400, int)}
        true = x[:40] @ x.T
        a = np.arange(40)
        for low in (-2000.0, 0.0, 20000.0):
            high = low + 5000
            at, row = hn._survivors(anchors, a, rows, np.full(40, low), np.full(40, high))
            kept = set(zip(at.tolist(), row.tolist()))
            inside = set(zip(*(v.tolist() for v in np.nonzero((true >= low) & (true <= high)))))
            assert inside <= kept
        at, row = hn._survivors(anchors, a, rows, np.sort(true, 1)[:, -6], np.full(40, np.inf))
        assert (at != 5).sum() < {3: 0.1, 64: 0.25, 130: 0.5}[dim] * true.size  # anchor 5 is zero: all rows tie


def test_rotation_is_orthogonal():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 70))
    y = hn.rotate(x)
    assert y.shape == (20, 128) and np.allclose(y @ y.T, x @ x.T)


def test_query_and_its_fold_of_labels(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(k, [rnd.gauss(0.2, 0.3) for _ in range(12)], rnd.randrange(10)) for k in range(220)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, hn.op11_hard_negatives(spark, str(tmp_path)).collect()), key=repr)
    turned = [(i, [float(np.float32(x)) for x in v], (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert got == plain_negatives(turned, lambda i: i % 50 == 0) and got
