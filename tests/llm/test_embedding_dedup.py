import math

import numpy as np

from addrlink.llm import embedding_dedup as e


def brute(rows, cosine=0.9):
    """n_links and component of every (vec_id, vector) row."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(np.array(v, float))

    units = [None if i is None else unit(v) for i, v in rows]
    n, least = [0] * len(rows), {i: i for i, _ in rows}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) \
                    and units[a] @ units[b] >= cosine:
                n[a] += 1
                x, y = find(rows[a][0]), find(rows[b][0])
                least[max(x, y)] = min(x, y)
    return sorted(((i, n[k], None if i is None else find(i), i is not None and find(i) == i)
                   for k, (i, _) in enumerate(rows)), key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows],
                               "vec_id long, embedding array<float>, label int, n_links string")
    return sorted((tuple(r) for r in e.link(df, **more).collect()), key=str)


def around(rng, base, spread, n):
    noise = rng.standard_normal((n, len(base)))
    return (base + spread * noise / np.sqrt(len(base))).astype(np.float32).tolist()


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((150, 32)).astype(np.float32).tolist()
    for k in range(10):
        vectors += around(rng, rng.standard_normal(32), 0.3 + 0.02 * k, 12)
    rows = list(enumerate(vectors))
    got, want = run(spark, rows), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.97 * there <= found <= there
    assert sum(a == b for a, b in zip(got, want)) >= 0.95 * len(rows)


def test_odd_vectors(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v), (2, v), (2, v), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 2.0]),
            (8, [inf, 1.0, 2.0]), (9, [None, 1.0, 2.0]), (None, v), (10, [1.0, 2.0]), (11, [1.0, 2.0]), (12, [-1.0, -2.0, -3.0]),
            (13, [1e-20, 2e-20, 3e-20]), (20, [5.0, 0.0, 0.0]), (20, [0.0, 0.0, 9.0]), (21, [0.0, 0.0, 7.0])]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_large_group_is_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", 25)
    rng = np.random.default_rng(3)
    rows = list(enumerate(around(rng, rng.standard_normal(48), 0.2, 200) + rng.standard_normal((60, 48)).tolist()
                          + [[1.0] * 48] * 40))
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got, want = run(spark, rows), brute(rows)
    assert got == want
    assert max(r[1] for r in got) >= 150


def test_recall_of_the_calibration():
    for rows in (100, 10_000, 1_000_000):
        t = e.Tables(rows, 0.9)
        assert len(t.masks) >= 1 and 0 < t.least <= e.PROJECTIONS
    assert len(e.Tables(1_000_000, 0.9).masks) > len(e.Tables(10_000, 0.9).masks)
