"""Operator 6: SimHash near-duplicates, compared in bit slices.

Fingerprints: 64-bit majority of the XXH64 hashes of the word shingles.
Candidates: the 64 bits are cut into ``radius + 2`` parts; two fingerprints
within ``radius`` bits agree on at least two whole parts, so each pair of parts
is one table and equal parts are one bucket.  Nothing is missed.
Comparison: the fingerprints of a bucket are stored as 64 vertical bit planes,
64 fingerprints to a machine word; one query updates 64 distances at a time
with carry-save bitwise counters, and words whose lanes all exceed the radius
are dropped on the way.

Equal fingerprints are one node.  A bucket with more than ``BLOCK``
fingerprints (a large group of near copies) is split into blocks, and every
pair of blocks is a task of its own; a task emits a spanning forest of the
links it found, never all pairs, which keeps the components exact.

Cases: null text counts as empty; texts without words have fingerprint zero and
are linked like any other; repeated rows are all returned; a null doc_id never
becomes a component id, unless all rows of the component have none (then
null); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from addrlink.session import cut_lineage

from .common import UnionFind, components, text_parts

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of one bucket that one task compares with as many others.
BLOCK = 4096
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: A byte's bits, one to a byte of a 64-bit word.
_LANES = np.array([sum((b >> j & 1) << 8 * j for j in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every shingle; bytes.lower and bytes.split know ASCII only, as the contract does."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[size - 1:] if len(words) >= size else ends[-1:]) - 1
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, stops.tolist())), np.uint64, len(stops))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    n = len(hashes)
    if not n:
        return 0
    lanes = _LANES[hashes.view(np.uint8).reshape(n, 8)]
    # at most 255 ones fit a lane before it is widened
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    ones = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint ``fp`` (long) of every row."""
    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in text_parts(batches):
            yield pd.Series([majority(shingle_hashes(t, size)) for t in part], dtype="int64")

    return docs.select("doc_id", of("text").alias("fp"))


def part_masks(radius: int) -> list[int]:
    """Signed 64-bit masks of every two of the radius + 2 parts."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [(x | y) - (1 << 64) * ((x | y) >> 63) for x, y in combinations(parts, 2)]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) planes of ``fps``, whose length is a multiple of 64."""
    out = np.empty((64, len(fps) // 64), np.uint64)
    for a in range(0, len(fps), 64 * 512):
        part = fps[a:a + 64 * 512]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
        packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
        out[:, a // 64:(a + len(part)) // 64] = np.ascontiguousarray(packed).view(np.uint64)[..., 0]
    return out


def close_lanes(planes: np.ndarray, queries: np.ndarray, q: np.ndarray, w: np.ndarray,
                skip: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of a query and a word: the lanes within ``radius`` bits.

    ``skip`` marks lanes not to look at.  Returns the pairs that have such
    lanes (query, word) and the lanes as bits.
    """
    width = int(radius).bit_length()
    over = skip.copy()
    count = [np.zeros_like(over) for _ in range(width)]  # the distances, one bit of each per array
    left = np.arange(len(q))
    exceeds = over
    for k in range(64):
        carry = planes[k][w] ^ (np.uint64(0) - (queries[q] >> np.uint64(k) & np.uint64(1)))
        for c in count:
            c ^= carry
            carry = carry & ~c
        over |= carry
        if k % 8 == 7:
            # lanes whose counter is above the radius
            above, equal = over.copy(), ~over
            for bit in range(width - 1, -1, -1):
                if radius >> bit & 1:
                    equal &= count[bit]
                else:
                    above |= equal & count[bit]
                    equal &= ~count[bit]
            exceeds = above
            alive = exceeds != _ONES
            if alive.mean() < 0.8:
                q, w, over, exceeds, left = (x[alive] for x in (q, w, over, exceeds, left))
                count = [c[alive] for c in count]
            if not len(q):
                break
    found = exceeds != _ONES
    return q[found], w[found], ~exceeds[found]


def forest(fp: np.ndarray, group: np.ndarray, side: np.ndarray, cross: np.ndarray,
           radius: int = RADIUS, step: int = 16384) -> list[tuple[int, int]]:
    """Spanning forest (row numbers) of the links inside each group.

    Rows come sorted by (group, side).  In a ``cross`` group rows of side 0 are
    compared with rows of side 1 only, else all with all.
    """
    n = len(fp)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, n])
    gid = np.repeat(np.arange(len(first)), sizes)
    ones = np.add.reduceat(side, first)
    # rows looked at: side 1 of a cross group, else all; padded to whole words
    low = np.where(cross[first], first + sizes - ones, first)
    n_target = first + sizes - low
    words = -(-n_target // 64)
    word0 = np.r_[0, np.cumsum(words)[:-1]]
    row_of = np.repeat(low, words) + 64 * (np.arange(words.sum()) - np.repeat(word0, words))
    lane = np.arange(64)
    rows = row_of[:, None] + lane
    outside = rows >= np.repeat(first + sizes, words)[:, None]
    target = fp[np.where(outside, 0, rows)]
    planes = bit_planes(np.ascontiguousarray(target).reshape(-1))
    no_row = np.packbits(outside, axis=1, bitorder="little").view(np.uint64)[:, 0]
    # queries: side 0 of a cross group, else all; each against the words from its own on
    query = np.flatnonzero(~cross[first][gid] | (side == 0))
    g = gid[query]
    skip_words = np.where(cross[first][g], 0, (query - first[g]) // 64)
    n_words = words[g] - skip_words
    begins = np.r_[0, np.cumsum(n_words)]
    trees, label, used = UnionFind(n), np.arange(n), []
    a = 0
    while a < len(query):
        b = max(a + 1, int(np.searchsorted(begins, begins[a] + step, "right")) - 1)
        for c in range(0, int(begins[b] - begins[a]), step):  # a query with very many words
            at = np.arange(begins[a] + c, min(begins[b], begins[a] + c + step))
            i = np.searchsorted(begins, at, "right") - 1
            q = query[i]
            w = word0[g[i]] + skip_words[i] + at - begins[i]
            skip = no_row[w].copy()
            # of the query's own word only the lanes after the query
            ahead = np.clip(q - row_of[w] + 1, 0, 64)
            own = ~cross[first][g[i]] & (ahead > 0)
            skip[own] |= np.where(ahead[own] >= 64, _ONES,
                                  (np.uint64(1) << (ahead[own] % 64).astype(np.uint64)) - np.uint64(1))
            q, w, lanes = close_lanes(planes, fp, q, w, skip, radius)
            if len(q):
                bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                hit, at_lane = np.nonzero(bits)
                x, y = label[q[hit]], label[row_of[w[hit]] + at_lane]
                new = x != y
                if new.any():
                    pairs = np.unique(np.stack([x[new], y[new]], 1), axis=0)
                    used += trees.add(pairs[:, 0], pairs[:, 1])
                    label = trees.parent
                    while (label != label[label]).any():
                        label = label[label]
                    trees.parent = label
        a = b
    return used


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints ``fp`` within ``radius`` bits."""
    keys = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m)))
        for t, m in enumerate(part_masks(radius))])).alias("bucket"))
    counts = (keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
              .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rows = (keys.join(counts, "bucket")
            .withColumn("own", F.expr("cast(pmod(xxhash64(fp, 1), blocks) as int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"))
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def found(x):
            cols = {c: np.concatenate([p[c] for p in x]) for c in x[0]}
            edge = np.r_[True, np.any([np.diff(cols[c]) != 0 for c in ("bucket", "i", "j")], axis=0)]
            pairs = forest(cols["fp"].view(np.uint64), np.cumsum(edge), cols["side"],
                           cols["i"] != cols["j"], radius)
            a, b = np.array(pairs, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays(
                [pa.array(cols["fp"][a]), pa.array(cols["fp"][b])], schema=schema)

        held, n = [], 0
        for batch in batches:
            x = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            # whole groups leave; the last one may go on in the next batch
            last = len(x["fp"])
            if last and held and any(x[c][0] != held[-1][c][-1] for c in ("bucket", "i", "j")) and n >= block:
                yield found(held)
                held, n = [], 0
            if last:
                edge = np.flatnonzero(np.any([np.diff(x[c]) != 0 for c in ("bucket", "i", "j")], axis=0)) + 1
                cut = int(edge[-1]) if len(edge) else 0
                if cut and n + cut >= block:
                    yield found([*held, {c: v[:cut] for c, v in x.items()}])
                    held, n = [], 0
                    x = {c: v[cut:] for c, v in x.items()}
                held.append(x)
                n += len(x["fp"])
        if n:
            yield found(held)

    return rows.mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    fps = cut_lineage(fingerprints(docs, size))
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    comp = cut_lineage(components(links(reps.select("fp"), radius)))
    least = (comp.join(reps, comp["node"] == reps["fp"]).groupBy("component")
             .agg(F.min("rep").alias("component_id")))
    of_fp = comp.join(least, "component").select(F.col("node").alias("fp"), "component_id")
    ids = reps.join(of_fp, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    return (fps.join(ids, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest doc_id, same columns.

    Of several rows with that id one stays; rows without an id stay (nothing
    tells which of them is meant).
    """
    found = classes(docs, size, radius)
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(first, "doc_id", "left_semi")
    return kept.dropDuplicates(["doc_id"]).select(*docs.columns).unionByName(docs.where("doc_id is null"))
