"""Hard negatives against brute force, the bounds, blocks of anchors, odd inputs."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hard

ROWS = "vec_id long, embedding array<float>, label int"
SETTINGS = hard.Settings()


def brute(rows, settings=SETTINGS):
    """The lines by the definition, in plain Python integers."""
    used = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            used.append((vec_id, [max(-hard.EXACT, min(hard.EXACT, math.floor(settings.scale * float(np.float32(x))))) for x in vector], label))

    def score(a, b):
        return max(-hard.LONG, min(hard.LONG, sum(x * y for x, y in zip(a, b))))

    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, (anchor, q, label) in enumerate(used):
        if anchor is None or anchor % 50:
            continue
        rivals = [(score(q, v), i, same == label) for j, (i, v, same) in enumerate(used) if j != k and len(v) == len(q)]
        for place, p in enumerate(sorted((r for r in rivals if r[2]), key=order)[: settings.positives], 1):
            fits = sorted((r for r in rivals if not r[2] and 50 * p[0] <= 100 * r[0] <= 95 * p[0]), key=order)[: settings.negatives]
            out += [(anchor, p[1], rank, n[1], p[0], n[0], place) for rank, n in enumerate(fits, 1)]
    return sorted(out, key=repr)


def lines(spark, rows, schema=ROWS, settings=SETTINGS):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(map(tuple, hard.mined(frame, F.col("vec_id") % 50 == 0, settings).collect()), key=repr)


def clustered(rng, n, dims=16, labels=4):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    base = [rng.gauss(0, 1) for _ in range(dims)]
    rows = []
    for k in range(n):
        c = rng.randrange(labels)
        rows.append((k * 10, [float(np.float32(b + 0.5 * x + rng.gauss(0, 0.5))) for b, x in zip(base, centres[c])], c))
    return rows


def test_lines_equal_brute_force(spark):
    rows = clustered(random.Random(1), 150)
    want = brute(rows)
    assert len(want) > 100 and lines(spark, rows) == want


def test_blocks_and_tiles_change_nothing(spark):
    rows = clustered(random.Random(2), 80)
    assert lines(spark, rows, settings=replace(SETTINGS, block_bytes=1500, tile=7, first=2)) == brute(rows)


def test_ties_go_by_the_smaller_id(spark):
    rng = random.Random(3)
    vectors = [[1.0, 0.5, 0.25], [0.5, 1.0, 0.25], [0.75, 0.75, 0.0]]
    rows = [(k * 5, rng.choice(vectors), rng.randrange(2)) for k in range(60)]
    assert lines(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(random.Random(4), 30, dims=5)
    rows += [(50, None, 1), (100, [1.0, None, 1.0, 1.0, 1.0], 1), (150, [nan] * 5, 1), (200, [inf, 0.0, 0.0, 0.0, 0.0], 1), (250, [1.0] * 5, None), (None, [1.0] * 5, 1), (None, [1.0] * 5, 2)]
    rows += [(300, [], 1), (301, [], 1), (302, [], 2), (350, [1.0, 2.0], 1), (351, [1.0, 2.0], 1), (352, [1.0, 1.0], 3), (400, [1e30, 1.0], 1), (401, [1e30, -1e30], 1), (402, [1e20, 1.0], 2)]
    rows += rows[:3] * 2
    assert lines(spark, [(*r, "clash", 7) for r in rows], ROWS + ", anchor string, uid int") == brute(rows)


def test_no_rows_and_no_anchors(spark):
    assert lines(spark, []) == []
    assert lines(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert lines(spark, [(50, [1.0], 1), (2, [1.0], 2)]) == []


@pytest.mark.parametrize("dims", [1, 3, 16, 50, 64])
def test_bounds_hold(dims):
    rng = np.random.default_rng(dims)
    values = rng.integers(-300, 300, (40, dims))
    means, deviations = (x.astype(np.float32).astype(np.float64) for x in hard.summarised(values.astype(np.float64), SETTINGS.segments))
    v = hard.Vectors.of(np.arange(40), np.zeros(40), values, means, deviations, SETTINGS)
    done, width = 0, np.inf
    for n in SETTINGS.segments:
        cols = slice(done, done + len(hard.cuts(dims, n)) - 1)
        done = cols.stop
        low, high = hard._bounds(v, v, cols, False)
        assert (low <= values @ values.T).all() and (values @ values.T <= high).all()
        assert (high - low).mean() <= width + 1
        width = (high - low).mean()


def test_survivors_are_what_the_scores_keep():
    rng = np.random.default_rng(9)
    values = rng.integers(-300, 300, (60, 64))
    means, deviations = hard.summarised(values.astype(np.float64), SETTINGS.segments)
    v = hard.Vectors.of(np.arange(60), np.zeros(60), values, means, deviations, SETTINGS)
    scores = values @ values.T
    for share in (0.5, 0.98):
        low = np.quantile(scores, share, axis=1).astype(np.int64)
        high = np.full(60, hard.LONG)
        a, r, found = hard.survivors(v, v, low, high, np.ones((60, 60), bool), SETTINGS)
        want = np.nonzero(scores >= low[:, None])
        assert sorted(zip(a, r)) == sorted(zip(*want)) and (found == scores[a, r]).all()
