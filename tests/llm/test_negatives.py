"""Hard negatives against plain loops, and the number system against Python's whole numbers."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import negatives


@pytest.mark.parametrize("width,top", [(1, 3), (7, 10 ** 9), (64, 300), (64, 10 ** 7), (1500, 5000), (2500, 2)])
def test_products_are_exact(width, top):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-top, top, (9, width), endpoint=True), rng.integers(-top, top, (11, width), endpoint=True)
    a[0], b[0], b[1] = top, top, -top
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert negatives.products(a, b).tolist() == want


def test_residue_sums_stay_exact_in_float32():
    for width in (1, 64, 1000, 1024):
        for p in negatives.primes(width, 10 ** 6):
            assert width * (p // 2) ** 2 < 2 ** 24 and all(p % k for k in range(2, p))
    with pytest.raises(ValueError):
        negatives.primes(1024, 10 ** 200)


def brute(rows, every, k=5):
    usable = [(i, lb, [int(np.floor(256 * float(x))) for x in v]) for i, v, lb in rows
              if i is not None and lb is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    anchors = {}
    for i, lb, v in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lb, v)), (lb, v))
    for i, (lb, v) in anchors.items():
        s = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in usable if len(w) == len(v))
        for ps, j in [(-s_, j) for s_, j, m in s if m == lb and j != i][:k]:
            fits = [(-s_, n) for s_, n, m in s if m != lb and 80 * ps <= -100 * s_ <= 100 * ps][:k]
            out += [(i, j, r + 1, n, ps, sc) for r, (sc, n) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(3)
    got = negatives.mine(df.withColumn("rank", F.lit("clash")), F.col("vec_id") % every == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block,anchor_block", [(4096, 1024), (16, 4)])
def test_equals_plain_loops(spark, block, anchor_block):
    rng = random.Random(2)
    rows = []
    for k in range(300):
        v = [float(np.float32(rng.choice([-0.5, -0.25, 0.1, 0.3, 0.5]) + (0.4 if k % 3 else 0))) for _ in range(6)]
        rows.append((k, v, "hot" if k % 3 == 0 else "abc"[k % 2]))
    rows += [(1000, [0.5] * 4, "a"), (1005, [0.25] * 4, "b"), (1010, [0.5] * 4, "a"),  # another dimension
             (1100, [1.0] * 6, None), (1105, None, "a"), (1110, [], "a"), (1115, [None] + [0.5] * 5, "a"), (1120, [float("nan")] * 6, "a"),
             (1125, [float("inf")] * 6, "a"), (None, [0.5] * 6, "a"), (50, rows[50][1], "hot"), (50, rows[50][1], "hot"),
             (2 ** 60 + 1, [0.5] * 6, "b"), (2 ** 60 + 3, [0.5] * 6, "b"), (2000, [-0.5] * 6, "alone")]
    want = brute(rows, 5)
    assert len(want) > 500
    assert mined(spark, rows, 5, block=block, anchor_block=anchor_block) == want


def test_empty_table_and_lone_rows(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(0, [1.0], "a"), (1, [1.0], "b")], 1) == []
    assert mined(spark, [(0, [1.0], "a"), (1, [1.0], "a"), (2, [0.9], "b")], 100) == [(0, 1, 1, 2, 65536, 58880)]
