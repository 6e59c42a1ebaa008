"""Helpers shared by the corpus operators."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

#: Words of the contracts are runs of anything but space and these characters.
OTHER_SPACES = "\t\n\x0b\x0c\r"


#: Characters of text that a task works on at a time.
STEP_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` does not have."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def literal_rows(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table written into the plan itself; ``names`` as in a struct type."""
    columns = [n.split(":")[0].strip() for n in names.split(",")]
    text = json.dumps([dict(zip(columns, r)) for r in rows])
    one = F.explode(F.from_json(F.lit(text), f"array<struct<{names}>>")).alias("r")
    return spark.range(1).select(one).select("r.*")


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; empty for null."""
    text = F.coalesce(text, F.lit(""))
    for c in OTHER_SPACES:  # a plain one-character split is three times as fast as a pattern
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null ids: fold of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def row_key(df: DataFrame, cols: list[str]) -> Column:
    """64-bit key of a row's values; nulls are marked, so (null, x) and (x, null) differ."""
    parts = []
    for c in cols:
        parts += [F.coalesce(df[c].cast("string"), F.lit("")), df[c].isNull()]
    return F.xxhash64(*parts)


def texts(batch: pd.Series) -> list[str]:
    """The texts of an Arrow batch with null as the empty text."""
    return ["" if t is None or t != t else t for t in batch]


def text_parts(batches: Iterator[pd.Series], step: int = STEP_CHARS) -> Iterator[list[str]]:
    """The texts of Arrow batches in lists of about ``step`` characters, whatever the batch holds."""
    for batch in batches:
        held, n = [], 0
        for text in texts(batch):
            held.append(text)
            n += len(text)
            if n >= step:
                yield held
                held, n = [], 0
        if held:
            yield held


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; loops and repeats are allowed.
    Alternating large-star and small-star steps: every step is one grouped
    minimum and one join, so no component is ever gathered in one task, and a
    node of huge degree is a skewed join that AQE splits (the other side has
    one row for it).  Returns ``node`` and ``component``; an empty input gives
    an empty result.
    """
    e = cut_lineage(edges.where("a <> b")
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*").alias("n"),
                      F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        # large star: all larger neighbours of u go to u's smallest neighbour (or u)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = cut_lineage(small)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


class UnionFind:
    """Forest over 0..n-1 inside one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Join the pairs; returns those that connected two trees (a spanning forest)."""
        used = []
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                used.append((x, y))
        return used
