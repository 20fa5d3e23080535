import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import hard_negatives as hn
from ledgerlift.llm.common import prepared

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 4, 5), (16, 16, 16), (17, 33, 18), (40, 64, 70), (129, 65, 100), (20, 0, 20)])
def test_product_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(2**24), 2**24, shape[:2]), rng.integers(-(2**24), 2**24, shape[1:])
    assert (hn.product(a, b) == a @ b).all()
    # Sums within the recursion leave 64 bits; the entries themselves don't.
    a, b = a << 30, np.where(b > 0, 2, -1)
    assert (hn.product(a, b) == (a.astype(object) @ b.astype(object)).reshape(a.shape[0], b.shape[1])).all()


@pytest.mark.parametrize("keep", [1, 3, 50])
def test_heap_breaks_ties_by_place(keep):
    picker = random.Random(keep)
    scores = np.array([picker.randrange(6) for _ in range(40)])
    places = np.array(sorted(picker.sample(range(40), 30)))
    assert hn.heap(scores, places, keep).tolist() == sorted(places.tolist(), key=lambda i: (-scores[i], i))[:keep]


def brute(rows, keep=5, low=80, high=100):
    taken = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken[i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label] = None
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in taken:
        if a[0] % 100:
            continue
        scored = sorted(((-score(a[1], b[1]), b[0], b) for b in taken if b != a), key=lambda t: t[:2])
        for minus, p, _ in [t for t in scored if t[2][2] == a[2]][:keep]:
            fit = [t for t in scored if t[2][2] != a[2] and -low * minus <= -100 * t[0] <= -high * minus][:keep]
            out += [(a[0], p, rank + 1, t[1], -minus, -t[0]) for rank, t in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("n,centres,noise", [(600, 5, 0.3), (350, 1, 0.05), (250, 40, 2.0), (3, 1, 0.1)])
def test_mined_equals_brute_force(spark, monkeypatch, n, centres, noise):
    monkeypatch.setattr(hn, "ANCHOR_TILE", 3)
    monkeypatch.setattr(hn, "CANDIDATE_TILE", 100)
    picker = random.Random(n)
    middle = [[picker.gauss(0, 0.4) for _ in range(20)] for _ in range(centres)]
    rows = [(i, [x + picker.gauss(0, noise) for x in picker.choice(middle)], picker.randrange(4)) for i in range(n)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(n // 3)]  # one vector a quarter of all rows
    frame = prepared(spark).createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, hn.mined(frame, F.col("vec_id") % 100 == 0).collect()))
    assert got == brute(rows) and (n < 100 or got)


def test_windows_of_zero_and_below(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, 5.0], 2), (4, [-1.0, 0.0], 2), (5, [-0.9, 0.0], 2)]
    frame = prepared(spark).createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, hn.mined(frame, F.col("vec_id") == 0).collect()))
    assert got == brute(rows) == [(0, 1, 1, 3, 0, 0)]  # a window around a negative score holds nothing


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (1, [1.0, 0.25], 1), (2, [1.0, 0.25], 2), (3, [1.0], 2), (4, [1.0, None], 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2)]
    rows += [(7, None, 1), (8, [1.0, 0.5], None), (None, [1.0, 0.5], 2), (9, [], 2), (10, [1e30, 1.0], 2), (2, [0.9, 0.25], 2)]
    wide = [(*r, 1, 2, 3, "x", 4, 5) for r in rows]
    frame = prepared(spark).createDataFrame(wide, SCHEMA + ", id long, h long, x int, v string, a long, `a.b` int")
    got = sorted(map(tuple, hn.mined(frame, F.col("vec_id") % 100 == 0).collect()))
    assert got == [t for t in brute([r for r in rows if r[0] != 10])] and {t[3] for t in got} == {2, 3}
    assert hn.mined(frame.limit(0), F.col("vec_id") == 0).collect() == []
    assert hn.mined(frame, F.lit(None).cast("boolean")).collect() == []
