"""Operator 2: embedding near-duplicates by collision counting on projections.

Every vector is projected on ``PROJECTIONS`` random lines.  On a line, a vector
at the wanted cosine lies within a fixed window around the query more often
than a random one; a pair whose collisions over all lines reach a count is
verified by its exact cosine.  The window of one line alone holds a constant
share of all rows (about a third at a useful recall), so lines are sorted
together: a table sorts the vectors by the signs of ``bits`` lines, its runs of
equal signs meet, and only pairs of a run have their collisions counted.  The
bits grow with the logarithm of the rows, which keeps the runs short; the count
and the number of tables are calibrated on pairs of exactly the wanted cosine
to a recall of ``RECALL``.

Equal vectors are one class (found by a 128-bit digest) and are counted, not
paired.  A pair belongs to the first table in which it shares a run, so no
table counts it again.  A run with more than ``BLOCK`` classes is split into
blocks, each pair of blocks being a task; a task gives sums of links and a
spanning forest, never all pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing (their own component); vectors of different lengths do not
link; a null vec_id links with nothing and has a null component; a repeated
vec_id is one node of the components while each of its rows counts its links;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

from .common import UnionFind, components

COSINE = 0.9
PROJECTIONS = 128
RECALL = 0.98
#: Rows of a run on average, which sets the bits of a table.
RUN = 12
BLOCK = 2048
#: Half a window, in standard deviations of the difference of two vectors at the wanted cosine.
WINDOW = 1.5
PAIRS = 1 << 16


def lines(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, PROJECTIONS))


def codes(projected: np.ndarray) -> np.ndarray:
    """Signs on all lines as two 64-bit numbers."""
    return np.packbits(projected > 0, axis=1, bitorder="little").view(np.int64)


class Tables:
    """Masks of the tables and the calibrated count, for a number of rows."""

    def __init__(self, rows: int, cosine: float, recall: float = RECALL, pairs: int = 4000, dim: int = 64):
        self.cosine = cosine
        self.half = WINDOW * np.sqrt(2 * (1 - cosine))
        bits = int(np.clip(round(np.log2(max(rows, 1) / RUN)), 3, PROJECTIONS // 2))
        rng = np.random.default_rng(bits)
        x, z = rng.standard_normal((2, pairs, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(axis=1, keepdims=True) * x
        z /= np.linalg.norm(z, axis=1, keepdims=True)
        p, q = x @ lines(dim), (cosine * x + np.sqrt(1 - cosine**2) * z) @ lines(dim)
        counts = (np.abs(p - q) <= self.half).sum(axis=1)
        self.least = int(np.quantile(counts, (1 - recall) / 4))
        differ, found = codes(p) ^ codes(q), np.zeros(pairs, bool)
        masks: list[np.ndarray] = []
        while (found & (counts >= self.least)).mean() < recall:
            chosen = np.zeros(PROJECTIONS, np.uint8)
            chosen[rng.permutation(PROJECTIONS)[:bits]] = 1
            masks.append(np.packbits(chosen, bitorder="little").view(np.int64))
            found |= ((differ & masks[-1]) == 0).all(axis=1)
        self.masks = np.array(masks)


def linked(x: np.ndarray, code: np.ndarray, group: np.ndarray, side: np.ndarray, cross: np.ndarray,
           table: np.ndarray, n: np.ndarray, t: Tables) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Rows linked to each row (weighted by ``n``) and a spanning forest, within the groups.

    Rows come sorted by (group, side); rows of a ``cross`` group meet the other side only.
    """
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    projected = (unit @ lines(x.shape[1])).astype(np.float32)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, len(group)])
    gid = np.repeat(np.arange(len(first)), sizes)
    ones = np.add.reduceat(side, first)
    start = np.where(cross[first], first + sizes - ones, 0)[gid]
    start = np.where(cross, start, np.arange(len(group)) + 1)  # a row's partners: from here to the group's end
    stop = (first + sizes)[gid]
    many = np.where(cross & (side == 1), 0, stop - start)
    links, trees, used = np.zeros(len(group), np.int64), UnionFind(len(group)), []
    label = trees.parent
    ends = np.cumsum(many)
    for a in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        at = np.arange(a, min(a + PAIRS, ends[-1]))
        i = np.searchsorted(ends, at, "right")
        j = start[i] + at - (ends[i] - many[i])
        differ = code[i] ^ code[j]
        own = np.ones(len(i), bool)
        for g in range(int(table[i].max())):  # pairs that an earlier table has
            own &= (table[i] <= g) | ((differ & t.masks[g]) != 0).any(axis=1)
        i, j = i[own], j[own]
        near = (np.abs(projected[i] - projected[j]) <= t.half).sum(axis=1) >= t.least
        i, j = i[near], j[near]
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= t.cosine
        i, j = i[near], j[near]
        links += np.bincount(i, n[j], len(group)).astype(np.int64) + np.bincount(j, n[i], len(group)).astype(np.int64)
        p, q = label[i], label[j]
        if (p != q).any():
            pairs = np.unique(np.stack([p, q], 1)[p != q], axis=0)
            used += trees.add(pairs[:, 0], pairs[:, 1])
            label = trees.parent
            while (label != label[label]).any():
                label = label[label]
            trees.parent = label
    return links, used


def with_digest(rows: DataFrame) -> DataFrame:
    """vec_id, embedding and its digest (h1, h2); the vector is null where it can't link."""
    fine = F.expr("vec_id is not null and embedding is not null and size(embedding) > 0"
                  " and forall(embedding, x -> x is not null and not isnan(x)"
                  " and abs(x) < double('infinity'))"
                  " and exists(embedding, x -> x <> 0)")
    v = F.when(fine, F.col("embedding").cast("array<double>"))
    return rows.select("vec_id", v.alias("embedding")).select(
        "vec_id", "embedding", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")).alias("h1"),
        F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(1), "embedding")).alias("h2"))


def search(classes: DataFrame, t: Tables) -> DataFrame:
    """Per class sums of links (h1, h2, links) and forest edges (a, b) of ``classes`` (rep, n, h1, h2, embedding)."""
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            out = np.zeros((len(vectors), 2), np.int64)
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            begin = np.cumsum(dims) - dims
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                out[at] = codes(flat[begin[at][:, None] + np.arange(d)] @ lines(int(d)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out[:, 0]), pa.array(out[:, 1])],
                names=[*batch.schema.names, "c1", "c2"])

    with_code = cut_lineage(classes.mapInArrow(
        coded, "rep long, n long, h1 long, h2 long, embedding array<double>, c1 long, c2 long"))
    runs = F.explode(F.array(*[F.struct(F.lit(g).alias("g"), F.xxhash64(
        F.lit(g), F.size("embedding"), F.col("c1").bitwiseAND(F.lit(int(m[0]))),
        F.col("c2").bitwiseAND(F.lit(int(m[1])))).alias("run")) for g, m in enumerate(t.masks)])).alias("r")
    rows = with_code.select("*", runs).select("*", "r.g", "r.run").drop("r")
    hot = (rows.groupBy("run").agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK)
           .select("run", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")))
    rows = (rows.join(hot, "run", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", F.expr("cast(pmod(xxhash64(h1, h2), blocks) as int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"),
                          "side": (F.col("own") > F.col("other")).cast("int")})
            .drop("own", "other", "blocks"))
    rows = rows.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j", "side", "h1", "h2")
    keys = ("run", "i", "j")
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("links", pa.int64()),
                        ("a", pa.int64()), ("b", pa.int64())])

    def found(parts: list[dict]) -> pa.RecordBatch:
        c = {k: np.concatenate([p[k] for p in parts]) for k in parts[0] if k != "x"}
        dims = np.concatenate([np.array([len(v) for v in p["x"]], np.int64) for p in parts])
        vectors = [v for p in parts for v in p["x"]]
        group = np.cumsum(np.r_[True, np.any([np.diff(c[k]) != 0 for k in keys], axis=0)])
        links, edges = np.zeros(len(group), np.int64), []
        for d in np.unique(dims):  # a run holds vectors of one length, but for colliding hashes
            at = np.flatnonzero(dims == d)
            got, pairs = linked(np.array([vectors[k] for k in at]), np.stack([c["c1"], c["c2"]], 1)[at],
                                group[at], c["side"][at], (c["i"] != c["j"])[at], c["g"][at], c["n"][at], t)
            links[at] = got
            edges += [(at[p], at[q]) for p, q in pairs]
        some = np.flatnonzero(links)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        none = [None] * len(some)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())]) for x, y in (
                (c["h1"][some], [None] * len(a)), (c["h2"][some], [None] * len(a)),
                (links[some], [None] * len(a)), (none, c["rep"][a]), (none, c["rep"][b]))], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {k: batch.column(k).to_numpy(zero_copy_only=False)
                 for k in batch.schema.names if k != "embedding"}
            x["x"] = list(batch.column("embedding").to_numpy(zero_copy_only=False))
            # whole groups leave; the last one may go on in the next batch
            edge = np.flatnonzero(np.any([np.diff(x[k]) != 0 for k in keys], axis=0)) + 1
            cut = int(edge[-1]) if len(edge) else 0
            if held and any(x[k][0] != held[-1][k][-1] for k in keys) and n >= BLOCK:
                yield found(held)
                held, n = [], 0
            if cut and n + cut >= BLOCK:
                yield found([*held, {k: v[:cut] for k, v in x.items()}])
                held, n = [], 0
                x = {k: v[cut:] for k, v in x.items()}
            held.append(x)
            n += len(x["x"])
        if n:
            yield found(held)

    return rows.mapInArrow(compare, "h1 long, h2 long, links long, a long, b long")


def link(rows: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``rows`` (vec_id, embedding)."""
    digests = with_digest(rows)
    good = digests.where("h1 is not null")
    classes = cut_lineage(good.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.any_value("embedding").alias("embedding"))
        .select("rep", "n", "h1", "h2", "embedding"))
    found = cut_lineage(search(classes, Tables(classes.count(), cosine, recall)))
    links = found.where("links is not null").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    of_class = cut_lineage(classes.join(links, ["h1", "h2"], "left").select(
        "h1", "h2", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    # every row of a class is tied to its smallest id; a row that can't link stands alone
    keyed = digests.select("vec_id", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    ties = keyed.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    comp = components(found.where("a is not null").select("a", "b").union(ties))
    return (keyed.join(comp, F.col("vec_id") == F.col("node"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
