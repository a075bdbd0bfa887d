"""Operator 13 against brute force over Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import hard_negatives as H


def brute(rows, every=5):
    """rows: (id, vector, label), usable ones only."""
    v = {i: ([math.floor(256 * c) for c in x], t) for i, x, t in rows}
    out = []
    for a in sorted(v):
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v[a][0], x)) for i, (x, _) in v.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if v[i][1] == v[a][1]][:5]:
            fits = [i for i in order if v[i][1] != v[a][1] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(fits[:3])]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumn("rank", F.lit(1)).withColumn("v", F.lit("x"))


def run(df):
    return sorted(map(tuple, H.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label")).collect()))


@pytest.mark.parametrize("block,anchors", [(8192, 1024), (16, 3)])
def test_equals_brute_force(spark, monkeypatch, block, anchors):
    """Ties, a hot vector and a hot label; blocks and chunks of anchors; bad rows."""
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "ANCHORS", anchors)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(c) for c in np.round(rng.standard_normal(6) + 0.5, 1)], int(rng.integers(0, 3)))
            for i in range(90)]
    rows += [(100 + i, [1.0, 2.0, 0.0, -0.0, 0.5, 0.001], i % 2) for i in range(60)]
    rows += [(200 + i, [0.0] * 6, 1) for i in range(8)] + [(300, [2.0] * 6, 77)]
    bad = [(205, None, 0), (210, [1.0] * 6, None), (215, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
           (220, [float("nan")] * 6, 0), (225, [float("inf")] * 6, 0), (230, [1.0, 2.0], 0), (None, [1.0] * 6, 0),
           (235, [1e300] * 6, 0), (240, [], 0)]
    want = brute(rows)
    assert len(want) > 200
    assert run(table(spark, rows + bad + rows[:40])) == want


def test_large_integers_stay_exact(spark):
    rows = [(i, [2.0 ** 21 + i * 3, 2.0 ** 21 - i, 1.0 / 256], i % 2) for i in range(40)]
    rows = [(i, [c * (0.7 if t else 1.0) for c in x], t) for i, x, t in rows]
    want = brute(rows)
    assert want and max(r[4] for r in want) > 2 ** 53
    assert run(table(spark, rows)) == want


def test_stops_before_the_end(monkeypatch):
    """Where the lists are steep, sorted access ends early and the result is whole."""
    rng = np.random.default_rng(2)
    x = (rng.pareto(1.0, (2000, 3)) * 100).astype(np.int64)
    lists = H.Lists(np.arange(2000), np.zeros(2000, np.int64), x)
    scored = []
    scores = lists.scores
    monkeypatch.setattr(lists, "scores", lambda rows, a: scored.append(len(rows)) or scores(rows, a))
    a = np.array([[3, 1, 2], [5, 0, 1]])
    every = np.ones((2, 2000), dtype=bool)
    low, high = np.full((2, 1), H.LOWEST), np.full((2, 1), H.HIGHEST)
    for i, ((at, got),) in enumerate(lists.best(a, np.array([-1, -1]), every, low, high, 5)):
        order = np.lexsort((np.arange(2000), -(x @ a[i])))[:5]
        assert list(at) == list(order) and list(got) == list((x @ a[i])[order])
    assert sum(scored) < 1000


def test_few_rows(spark):
    assert run(table(spark, [])) == []
    assert run(table(spark, [(5, [1.0], 1)])) == []
    assert run(table(spark, [(5, [1.0], 1), (6, [1.0], 1), (7, [0.5], 2)])) == [(5, 6, 1, 7, 65536, 32768)]
    assert run(table(spark, [(5, [1.0], 1), (6, [-1.0], 1), (7, [-0.7], 2)])) == []
