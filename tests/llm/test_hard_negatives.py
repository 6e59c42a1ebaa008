import math
import random

import numpy as np
import pytest

from addrlink.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, score string, v string, place int, low int"


def brute(rows, anchor, positives=5, negatives=10):
    items = [(i, label, [math.floor(256 * x) for x in np.asarray(v, np.float32).astype(float)]) for i, v, label, *_ in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, label, v) in enumerate(items):
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, other, w) in enumerate(items)
                        if m != n and len(w) == len(v))
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(s, k) for s, k, other in scored if other != label and -30 * score <= -100 * s <= -90 * score]
            out += [(i, j, r + 1, k, -score, -s) for r, (s, k) in enumerate(fit[:negatives])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "v", 1, 2) for r in rows], SCHEMA)


def vectors(n, dim, seed, labels=4, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    v = centres[rng.integers(0, clusters, n)] + 0.6 * rng.standard_normal((n, dim))
    return [(i, [float(x) for x in row], int(rng.integers(0, labels))) for i, row in enumerate(v.astype(np.float32))]


@pytest.mark.parametrize("dim", [3, 16])
def test_same_as_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(h, "TILE", 128)  # several slabs, tiles, inner nodes and blocks
    monkeypatch.setattr(h, "LEAF", 8)
    monkeypatch.setattr(h, "BLOCK", 7)
    monkeypatch.setattr(h, "OPEN", 20)
    rows = vectors(1500, dim, dim)
    got_ = got(h.mine(frame(spark, rows), h.F.col("vec_id") % 50 == 0))
    assert got_ == brute(rows, lambda i: i % 50 == 0) and len(got_) > 300


def test_ties_copies_and_repeated_rows(spark):
    """Half of the rows are one vector: equal scores go by id, and copies spread over tiles."""
    rows = vectors(300, 4, 9, labels=2)
    one = rows[0][1]
    rows += [(1000 + i, one, i % 2) for i in range(400)] + rows[:20] + rows[:1]
    assert got(h.mine(frame(spark, rows), h.F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (3, None, 1), (4, [1.0, None], 1),
            (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [1.0, 2.0, 3.0], 1), (8, [], 1), (9, [], 1), (100, [], 2),
            (None, [1.0, 2.0], 2), (10, [0.6, 1.0], None), (200, [-1.0, -2.0], 3), (11, [1.0, 2.0], 3), (300, [1.0, 1.0], 9)]
    every = got(h.mine(frame(spark, rows), h.F.lit(True)))
    assert every == brute(rows, lambda i: True) and (8, 9, 1, 100, 0, 0) in every
    assert h.mine(frame(spark, []), h.F.lit(True)).collect() == []
    assert h.mine(frame(spark, rows), h.F.lit(False)).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [1e30, 70_000.25, 3.0 + i], i % 2) for i in range(6)]
    v = h.whole_vectors(frame(spark, rows)).orderBy("vec_id").first()["v"]
    assert v == [h.LIMIT, 256 * 70_000 + 64, 768]
    scores = [r["positive_score"] for r in h.mine(frame(spark, rows), h.F.col("vec_id") == 0, low=0, high=200).collect()]
    assert scores and all(s == h.LIMIT**2 + (256 * 70_000 + 64) ** 2 + 768 * 256 * (3 + i) for s, i in zip(sorted(set(scores)), (2, 4)))


def test_boxes_bound_all_scores():
    rng = random.Random(2)
    v = np.array([[rng.randint(-99, 99) for _ in range(5)] for _ in range(700)], np.int32)
    order = h.str_order(v, h.LEAF, [0, 1, 2])
    assert sorted(order) == list(range(700))
    tile = h.Tile(5, v[order].tobytes(), *[np.zeros(700, np.int64).tobytes()] * 3)
    q = np.array([[rng.randint(-99, 99) for _ in range(5)] for _ in range(9)], np.int32)
    zero = np.zeros(9, np.int64).tobytes()
    block = h.Block(5, q.tobytes(), {c: zero for c in ("label", "rid", "place", "low", "high")}, 1, True)
    scores, width = q.astype(np.int64) @ tile.v.astype(np.int64).T, h.LEAF
    for lo, hi in tile.levels:
        least, most = block.bounds(lo, hi)
        for node in range(len(lo)):
            part = scores[:, node * width:(node + 1) * width]
            assert (least[:, node] <= part.min(axis=1)).all() and (part.max(axis=1) <= most[:, node]).all()
        width *= h.FAN
    assert len(tile.levels[-1][0]) <= h.FAN
