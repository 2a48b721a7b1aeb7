"""Hard negatives by packed products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide.llm import negatives

MOST = (1 << 63) - 1


def shifted():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize(
    "low, high, n",
    [(-160, 160, 64), (0, 5, 3), (-(2**20), 2**20, 5), (-(2**40), 2**44, 4), (-(2**62), 2**62, 2), (7, 8, 1), (-3, -2, 9)],
)
def test_packed_products_are_exact(low, high, n):
    random_ = np.random.default_rng(n)
    a, c = (random_.integers(low, high, (rows, n)).astype(float) for rows in (13, 29))
    want = [[max(-MOST, min(MOST, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in c] for u in a]
    assert negatives.scores(a, c).tolist() == want
    assert negatives.scores(a[:0], c).shape == (0, 29) and negatives.scores(a[:, :0], c[:, :0]).tolist() == [[0] * 29] * 13


def test_words_hold_several_candidates():
    width, count = negatives.fields(64, 320, 320)
    assert (width, count) == (23, 2) and 2**width > 64 * 320 * 320


@pytest.mark.parametrize("score", [-7, -1, 0, 1, 4, 5, 99, 100, 101, 12345, MOST])
def test_least_score(score):
    assert int(negatives.least_score(np.array([score]), 80)[0]) == -((-80 * score) // 100)


def brute(rows, percent=80, k=5):
    ok = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in ok:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for i, (label, v) in anchors.items():
        scored = []
        for j, other, w in ok:
            if j != i and len(w) == len(v):
                s = sum(a * b for a, b in zip(v, w))
                scored.append((-max(-MOST, min(MOST, s)), j, other == label))
        for p, j, _ in sorted(x for x in scored if x[2])[:k]:
            near = sorted((n, x) for n, x, same in scored if not same and -percent * p <= -100 * n <= -100 * p)
            out += [(i, j, r + 1, x, -p, -n) for r, (n, x) in enumerate(near[:k])]
    return sorted(out)


def odd_vectors():
    random_, r = np.random.default_rng(0), random.Random(1)
    rows = [(i, [float(x) for x in random_.normal(0, 1, 12)], r.randint(0, 9)) for i in range(600)]
    rows += [(600 + i, rows[100][1], r.randint(0, 3)) for i in range(60)]  # ties
    rows += [(300, rows[1][1], 0), (301, rows[2][1], 4), (301, rows[3][1], 5)]  # repeated ids
    rows += [(1000, None, 1), (1100, [1.0, None] * 6, 2), (None, rows[3][1], 1), (1200, [math.nan] * 12, 1), (1250, [math.inf] * 12, 1)]
    rows += [(1300, [1.0] * 3, 1), (1301, [1.0] * 3, 1), (1302, [0.9] * 3, 2), (1500, [], 1), (1501, [], 1), (1502, [], 2)]
    return rows + [(1400, [1e9] * 12, 1), (1401, [1e9] * 12, 1), (1402, [0.9e9] * 12, 3), (1403, [1e300] * 12, 3), (1600, [1.0] * 12, None)]


@pytest.mark.parametrize("block", [4096, 3])
def test_negatives_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    df = df.withColumn("rank", F.lit("clash")).withColumn("slot", F.lit(1))
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, label=shifted())
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert negatives.mine(df, F.col("vec_id") < 0).collect() == []


def test_copies_of_one_vector_and_label(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long").repartition(7)
    got = negatives.mine(df, F.col("vec_id") == 0, positives=2, negatives=3, percent=100)
    s = 256 * 256 * 5
    assert sorted(map(tuple, got.collect())) == [(0, p, r, 2 * r - 1, s, s) for p in (2, 4) for r in (1, 2, 3)]
