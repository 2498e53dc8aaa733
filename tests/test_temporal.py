"""Time joins and rolling windows against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tollgate.plans import temporal as T

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_interval_join(spark):
    rnd = random.Random(1)
    points = [(k, rnd.choice(["a", "a", "a", "b", None]), at(rnd.randrange(5000))) for k in range(400)] + [(999, "a", None)]
    spans = [(j, rnd.choice(["a", "b", "c", None]), a, a + dt.timedelta(seconds=rnd.choice([0, 1, 30, 900]))) for j in range(60) for a in [at(rnd.randrange(5000))]]
    p = spark.createDataFrame(points, "id int, k string, ts timestamp_ntz")
    s = spark.createDataFrame(spans, "span int, k string, a timestamp_ntz, b timestamp_ntz")
    inside = lambda t, x: t[1] is not None and t[1] == x[1] and t[2] is not None and x[2] <= t[2] < x[3]
    want = sorted((t[0], x[0]) for t in points for x in spans if inside(t, x))
    for width in (10, 600, 10_000):
        joined = T.interval_join(p, s, ["k"], "ts", "a", "b", width)
        assert joined.columns == ["id", "k", "ts", "span", "a", "b"]
        assert sorted((r.id, r.span) for r in joined.collect()) == want
        flags = T.in_any_interval(p, s, ["k"], "ts", "a", "b", width, "hit").collect()
        assert sorted((r.id, r.hit) for r in flags) == sorted((t[0], any(inside(t, x) for x in spans)) for t in points)
    assert len(want) > 100
    plan = T.interval_join(p, s, ["k"], "ts", "a", "b", 60)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("chunk", [5, 300, 86_400])
def test_asof_join(spark, chunk):
    rnd = random.Random(2)
    left = [(k, rnd.choice(["a", "b", None]), at(rnd.randrange(1000))) for k in range(200)]
    right = [(rnd.choice(["a", "b", "c", None]), at(rnd.randrange(1000)), rnd.choice(["x", "y", None]), j) for j in range(25)]
    got = T.asof_join(spark.createDataFrame(left, "id int, k string, ts timestamp_ntz"),
                      spark.createDataFrame(right, "k string, since timestamp_ntz, v string, n int"), ["k"], "ts", "since", ["n", "v"], chunk)
    want = []
    for i, k, ts in left:
        last = max(((s, n, v) for kk, s, v, n in right if kk == k and s <= ts), key=lambda x: x[:2], default=(None, None, None))
        want.append((i, k, ts, last[1], last[2]))
    assert order(got.collect()) == order(want)


@pytest.mark.parametrize("seconds, subs", [(60, 60), (60, 4), (6, 3)])
def test_rolling_count(spark, seconds, subs):
    rnd = random.Random(3)
    rows = [(k, rnd.choice([1, 1, 1, 2, None]), T0 + dt.timedelta(microseconds=rnd.choice([rnd.randrange(4_000_000_000), rnd.randrange(40) * 1_000_000])))
            for k in range(500)]
    got = T.rolling_count(spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz"), "k", "ts", seconds, "n", subs).collect()
    w = dt.timedelta(seconds=seconds)
    want = [(i, k, t, sum(kk == k and t - w < u <= t for _, kk, u in rows)) for i, k, t in rows]
    assert order(got) == order(want) and max(r.n for r in got) > 3


def test_rolling_count_over_chunk_borders(spark):
    """Windows that reach over the border between chunks of buckets."""
    rows = [(k, 1, at(64 * 60 * 3 + k - 100)) for k in range(200)]
    got = T.rolling_count(spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz"), "k", "ts", 60, "n").collect()
    assert {r.id: r.n for r in got} == {k: min(k + 1, 60) for k in range(200)}
