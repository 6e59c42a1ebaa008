"""Operator 12: hard negatives from an STR-packed R-tree over integer vectors.

Every component ``x`` becomes ``floor(SCALE * x)``; the score of two rows is
the inner product of these whole numbers.  An anchor's positives are the rows
of its label with the highest scores; its negatives for a positive are the
highest rows of other labels whose score lies in a window around the positive's.

The tree is packed by sort-tile-recursive: rows are sorted into slabs of the
coordinate that varies most and, inside a slab, by the next one (a distributed
range sort in which equal coordinates are told apart by a row number, so copies
spread over tasks); runs of ``TILE`` rows are tiles, and a tile is packed the
same way on further coordinates into leaves of ``LEAF`` rows under ``FAN``-fold
inner nodes.  A tile is one row of a written table: vectors, labels and the
minimum bounding boxes of its nodes.

A box bounds every coordinate, so each product ``a[i] * x[i]`` lies in an
interval and their sums bound the scores of all rows below the box.  Anchors
are searched in blocks of ``BLOCK``, a block against one tile after another: a
queue holds the nodes, the one with the highest bound first; a node is left out
for an anchor if its interval misses the anchor's score window or ends strictly
below the anchor's kth score so far (equal ones stay, as ties go by id).  A first
group of tiles is searched ahead and its kth scores go to all tasks; a task
remembers those of a block over the tiles it meets.

Blocks meet tiles by an equi-join on a group of at most ``GROUP`` tiles: a
stated set of anchors against all rows, a block going once to each group.  A
task holds one group of tiles and the best rows of ``OPEN`` anchors.

Cases: rows with a null id, label or vector, or a null or non-finite component,
take no part; components stop at +-``LIMIT`` (beyond 131,000 before scaling),
which keeps scores exact; rows score only with rows of the same number of
components; empty vectors score 0; repeated rows are rows of their own (an
anchor that occurs twice is mined twice); ties go to the smaller id; an anchor
without other rows of its label gives nothing; a negative positive score leaves
an empty window; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

SCALE = 256
LIMIT = 1 << 25
POSITIVES = 5
NEGATIVES = 10
#: A negative's score is between these percentages of the positive's.
LOW, HIGH = 30, 90
TILE, LEAF, FAN = 1024, 64, 4
BLOCK = 256
#: Tiles of a group; anchors (of whole blocks) whose best rows a task remembers at a time.
GROUP, OPEN = 64, 16_384
#: Slabs of the first coordinate at most.
SLABS = 64
#: Candidates that a search gathers before it drops those beyond the kth.
BUFFER = 20_000
NONE = np.iinfo(np.int64).min

_TILE = {"vectors": np.int32, "label": np.int64, "rid": np.int64, "vec_id": np.int64}
_BLOCK = {"vectors": np.int32, "label": np.int64, "rid": np.int64, "place": np.int64, "low": np.int64, "high": np.int64}


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """rid, vec_id, label, v (whole components) of the rows that take part."""
    fine = F.expr("vec_id is not null and label is not null and embedding is not null and forall(embedding,"
                  " x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    whole = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return rows.where(fine).select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                                   F.col("label").cast("long").alias("label"), whole.alias("v"))


def str_order(v: np.ndarray, leaf: int, axes: list[int]) -> np.ndarray:
    """Sort-tile-recursive order of the rows of ``v`` into runs of ``leaf``."""
    n = len(v)
    if n <= leaf or not axes:
        return np.arange(n)
    order = np.argsort(v[:, axes[0]], kind="stable")
    tiles = -(-n // leaf)
    slab = leaf * -(-tiles // max(2, round(tiles ** (1 / min(len(axes), 2)))))
    return np.concatenate([order[i:i + slab][str_order(v[order[i:i + slab]], leaf, axes[1:])]
                           for i in range(0, n, slab)])


def boxes(v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Corners of the boxes over the rows of a tile: leaves first, then ``FAN`` nodes under one."""
    lo = hi = v
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    while not levels or len(lo) > FAN:
        first = np.arange(0, len(lo), FAN if levels else LEAF)
        lo, hi = np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first)
        levels.append((lo, hi))
    return levels


class Tile:
    """Rows of a tile and the boxes of its nodes."""

    def __init__(self, dim: int, vectors: bytes, label: bytes, rid: bytes, vec_id: bytes):
        self.label, self.rid, self.id = (np.frombuffer(b, np.int64) for b in (label, rid, vec_id))
        self.v = np.frombuffer(vectors, np.int32).reshape(len(self.rid), dim).astype(np.float64)
        self.levels = boxes(self.v)


class Block:
    """Anchors (or anchors with a score window), and the best rows found for each so far."""

    def __init__(self, dim: int, vectors: bytes, columns: dict[str, bytes], k: int, same: bool):
        of = {name: np.frombuffer(b, np.int64) for name, b in columns.items()}
        self.label, self.rid, self.place, self.low, self.high = (of[c] for c in ("label", "rid", "place", "low", "high"))
        self.q = np.frombuffer(vectors, np.int32).reshape(len(self.rid), dim).astype(np.float64)
        self.plus, self.minus = np.maximum(self.q, 0), np.minimum(self.q, 0)
        self.k, self.same = k, same
        self.kth = np.full(len(self.q), NONE)
        self.best = (np.zeros(0, np.int64),) * 3  # anchor, score, id
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_fresh = 0

    def product(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact whole inner products: in doubles while no sum can pass their 53 bits."""
        if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2.0**53:
            return (a @ b.T).astype(np.int64)
        return a.astype(np.int64) @ b.T.astype(np.int64)

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores of the anchors with anything inside the boxes (anchors x boxes)."""
        return (self.product(self.plus, lo) + self.product(self.minus, hi),
                self.product(self.plus, hi) + self.product(self.minus, lo))

    def open(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a box with these bounds can still hold a row for the anchor."""
        return (most >= np.maximum(self.kth, self.low)) & (least <= self.high)

    def settle(self) -> None:
        """Keep the k best of every anchor."""
        if not self.fresh:
            return
        a, s, i = (np.concatenate(x) for x in zip(self.best, *self.fresh))
        order = np.lexsort((i, -s, a))
        a, s, i = a[order], s[order], i[order]
        place = np.arange(len(a)) - np.searchsorted(a, a, "left")
        at = place == self.k - 1
        self.kth[a[at]] = s[at]
        keep = place < self.k
        self.best, self.fresh, self.n_fresh = (a[keep], s[keep], i[keep]), [], 0

    def search(self, tile: Tile) -> None:
        """Best-first through the boxes of a tile."""
        queue: list[tuple[int, int, int]] = []
        bound: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def push(level: int, nodes: range) -> None:
            if level not in bound:
                bound[level] = self.bounds(*tile.levels[level])
            for node in nodes:
                least, most = (b[:, node] for b in bound[level])
                want = self.open(least, most)
                if want.any():
                    heapq.heappush(queue, (-int(most[want].max()), level, node))

        top = len(tile.levels) - 1
        push(top, range(len(tile.levels[top][0])))
        while queue:
            _, level, node = heapq.heappop(queue)
            want = np.flatnonzero(self.open(*(b[:, node] for b in bound[level])))
            if not len(want):
                continue
            if level:
                push(level - 1, range(node * FAN, min((node + 1) * FAN, len(tile.levels[level - 1][0]))))
                continue
            rows = slice(node * LEAF, (node + 1) * LEAF)
            scores = self.product(self.q[want], tile.v[rows])
            fit = (scores >= np.maximum(self.kth, self.low)[want][:, None]) & (scores <= self.high[want][:, None])
            fit &= (self.label[want][:, None] == tile.label[rows]) == self.same
            if self.same:
                fit &= self.rid[want][:, None] != tile.rid[rows]
            a, r = np.nonzero(fit)
            if len(a):
                self.fresh.append((want[a], scores[a, r], tile.id[rows][r]))
                self.n_fresh += len(a)
                if self.n_fresh >= BUFFER:
                    self.settle()
        self.settle()

    def found(self) -> pa.RecordBatch:
        a, s, i = self.best
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.rid[a], self.place[a], s, i)],
                                          names=["rid", "place", "score", "id"])


def packed(rows: DataFrame, axes: list[int], bounds: list[int], size: int, columns: dict) -> DataFrame:
    """Runs of ``size`` rows in STR order, one row each: part (a number), dim and the columns as bytes."""
    at = [F.coalesce(F.get("v", F.lit(x)), F.lit(0)) for x in axes] or [F.lit(0)]
    slab = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<int>"), lambda b: at[0] > b))
    df = rows.withColumns({"dim": F.size("v"), "slab": slab, "_y": at[1 % len(at)]})
    order = ["dim", "slab", "_y", "rid"]
    df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    names = [c for c in columns if c != "vectors"]
    df = df.select("dim", "slab", "v", *names)
    schema = pa.schema([("part", pa.int64()), ("dim", pa.int32()), *[(c, pa.binary()) for c in columns]])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, key, n = TaskContext.get().partitionId() << 32, [], None, 0

        def leave() -> pa.RecordBatch:
            v = np.concatenate([h["v"] for h in held])
            inside = str_order(v, LEAF, axes[2:] or axes)
            out = {"vectors": v[inside]} | {c: np.concatenate([h[c] for h in held])[inside] for c in names}
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([v.shape[1]], pa.int32()),
                 *[pa.array([out[c].astype(columns[c]).tobytes()], pa.binary()) for c in columns]], schema=schema)

        for batch in batches:
            dims, slabs = (batch.column(c).to_numpy() for c in ("dim", "slab"))
            flat, ends = batch.column("v").flatten().to_numpy(), np.cumsum(dims)
            cuts = np.flatnonzero(np.r_[True, (np.diff(dims) != 0) | (np.diff(slabs) != 0), True])
            for i, j in zip(cuts[:-1], cuts[1:]) if batch.num_rows else ():
                if held and key != (dims[i], slabs[i]):
                    yield leave()
                    part, held, n = part + 1, [], 0
                key = (dims[i], slabs[i])
                while i < j:
                    m = min(j, i + size - n)
                    held.append({"v": flat[ends[i] - dims[i]:ends[m - 1]].reshape(m - i, dims[i])}
                                | {c: batch.column(c).to_numpy()[i:m] for c in names})
                    n, i = n + m - i, m
                    if n == size:
                        yield leave()
                        part, held, n = part + 1, [], 0
        if held:
            yield leave()

    return df.mapInArrow(runs, "part long, dim int, " + ", ".join(f"{c} binary" for c in columns))


class Tree:
    """The packed rows, and what is needed to pack anchors alike."""

    def __init__(self, items: DataFrame):
        spread = (items.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.variance("x").alias("s"))
                  .orderBy(F.desc_nulls_last("s"), "at").limit(4).collect())
        self.axes = [r["at"] for r in spread]
        slabs = min(SLABS, int(np.ceil(np.sqrt(items.count() / TILE))))
        self.bounds: list[int] = []
        if self.axes and slabs > 1:
            first = F.percentile_approx(F.get("v", F.lit(self.axes[0])), [k / slabs for k in range(1, slabs)])
            self.bounds = items.agg(first).first()[0] or []
        self.tiles = cut_lineage(packed(items, self.axes, self.bounds, TILE, _TILE))
        n = self.tiles.count()
        cores = items.sparkSession.sparkContext.defaultParallelism
        self.groups = max(1, min(n, max(2 * cores, -(-n // GROUP))))

    def found(self, anchors: DataFrame, k: int, same: bool, first: int, last: int) -> DataFrame:
        """rid, place, score, id: the k best rows of each anchor in every part of the groups that a task meets."""
        blocks = packed(anchors, self.axes, self.bounds, BLOCK, _BLOCK)
        blocks = blocks.select(F.col("part").alias("block"), "dim", *[F.col(c).alias("q_" + c) for c in _BLOCK],
                               F.explode(F.sequence(F.lit(first), F.lit(last))).alias("g"))
        tiles = self.tiles.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(self.groups)).cast("int"))
        met = blocks.join(tiles, ["g", "dim"]).select("block", "dim", *["q_" + c for c in _BLOCK], *_TILE)

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, Block] = {}
            n = 0
            for batch in batches:
                for row in batch.to_pylist():
                    block = held.pop(row["block"], None)
                    if block is None:
                        block = Block(row["dim"], row["q_vectors"],
                                      {c: row["q_" + c] for c in _BLOCK if c != "vectors"}, k, same)
                        n += len(block.rid)
                    held[row["block"]] = block  # the one used last comes last
                    block.search(Tile(row["dim"], *[row[c] for c in _TILE]))
                    while n > OPEN and len(held) > 1:
                        oldest = held.pop(next(iter(held)))
                        n -= len(oldest.rid)
                        yield oldest.found()
            for block in held.values():
                yield block.found()

        return met.mapInArrow(searched, "rid long, place long, score long, id long")

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """rid, place, rank, score, id: the k best rows of each anchor (rid, place, label, v, low, high).

        The first group of tiles goes ahead: where it holds k rows, the kth score
        is what all other groups have to reach, whichever task searches them.
        """
        of = Window.partitionBy("rid", "place").orderBy(F.desc("score"), "id")

        def ranked(rows: DataFrame) -> DataFrame:
            return rows.withColumn("rank", F.row_number().over(of)).where(F.col("rank") <= k)

        ahead = ranked(self.found(anchors, k, same, 0, 0))
        if self.groups == 1:
            return ahead
        ahead = cut_lineage(ahead)
        kth = ahead.where(F.col("rank") == k).select("rid", "place", F.col("score").alias("kth"))
        rest = anchors.join(kth, ["rid", "place"], "left").withColumn("low", F.greatest("low", "kth")).drop("kth")
        return ranked(ahead.drop("rank").union(self.found(rest, k, same, 1, self.groups - 1)))


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label; ``anchor`` (on vec_id) says which rows are anchors.
    """
    items = cut_lineage(whole_vectors(rows))
    tree = Tree(items)
    anchors = items.where(anchor)
    none = np.iinfo(np.int64)
    first = anchors.withColumns({"place": F.lit(0).cast("long"), "low": F.lit(none.min), "high": F.lit(none.max)})
    found = cut_lineage(tree.best(first, positives, True).select(
        "rid", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")))
    # of a negative score no share is both above the low and below the high one
    score, hundred = F.col("positive_score").cast("decimal(20,0)"), F.lit(100)
    windows = anchors.join(found.where("positive_score >= 0"), "rid").withColumns({
        "low": F.call_function("div", score * low + 99, hundred), "high": F.call_function("div", score * high, hundred)})
    best = tree.best(windows, negatives, False).select(
        "rid", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select("rid", F.col("vec_id").alias("anchor_id"))
    return (best.join(found, ["rid", "place"]).join(names, "rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
