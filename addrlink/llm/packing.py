"""Operator 9: best-fit packing of documents into sequences, in bulk-synchronous rounds.

Documents become pieces of at most ``capacity`` tokens.  Pieces are sorted by
length and numbered within their length in a distributed way (a count per
partition and length gives each partition its offset), so a length is a run of
ranks, and gaps of one size with one history are a run of sequences.  A round
sweeps both sorted sides from the largest size down: every run of pieces takes
its successor, the smallest run of gaps that still fits; pieces of one length
that want the same gaps are told apart by rank; each gap takes one piece, gaps
are updated, and the next round begins.  When nothing fits, the largest pieces
left open as many sequences as their tokens need at least.

The rounds see runs only - one number per length, at most ``capacity`` of them
however many documents there are - and give intervals of ranks; one join on
length and rank then places every piece.

Cases: null text counts as empty (its end token alone); empty texts fill one
token; a document longer than the capacity is cut into full pieces and a rest;
repeated rows are packed one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

from . import bpe

CAPACITY = 2048
END = 0
#: Intervals that are broadcast at most (40 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def cut_pieces(docs: DataFrame, vocabulary, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and the piece's ``ids`` (binary, 4 bytes each)."""
    closed = F.concat(bpe.encode(F.col("text"), vocabulary), F.lit(end.to_bytes(4, "little")))
    df = docs.select("doc_id", closed.alias("_ids"))
    df = df.withColumn("_n", F.expr("cast(octet_length(_ids) as bigint) div 4"))
    df = df.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.expr(f"cast((_n - 1) div {capacity} as int)"))))
    df = df.withColumn("start", F.col("piece").cast("long") * capacity)
    df = df.withColumn("length", F.least(F.lit(capacity), F.col("_n") - F.col("start")))
    return df.select("doc_id", "piece", "start", "length", F.expr(
        "substring(_ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"))


def plan(pieces_of: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Intervals (length, first rank, end rank, first sequence, offset) that place every piece.

    ``pieces_of``: number of pieces of each length.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in pieces_of.items():
        left[length] = n
    rank = np.zeros(capacity + 1, np.int64)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, number)
    out, sequences = [], 0

    def place(length: int, n: int, sequence: int, gap: int) -> None:
        out.append((length, int(rank[length]), int(rank[length]) + n, sequence, capacity - gap))
        rank[length] += n
        left[length] -= n

    lengths = np.arange(capacity + 1)
    while left.any():
        # sweep from the largest size down; the gap on top is the smallest that fits
        stack: list[tuple[int, int, int]] = []
        fresh: list[tuple[int, int, int]] = []
        matched = False
        for size in range(capacity, 0, -1):
            stack += [(size, s, n) for s, n in gaps[size]]
            gaps[size] = []
            while left[size] and stack:
                gap, sequence, n = stack.pop()
                m = min(n, int(left[size]))
                place(size, m, sequence, gap)
                fresh.append((gap - size, sequence, m))
                if m < n:
                    stack.append((gap, sequence + m, n - m))
                matched = True
        for gap, sequence, n in stack + fresh:
            if gap:
                gaps[gap].append((sequence, n))
        if not matched:
            need = int(max(-(-(left * lengths).sum() // capacity // 2), left[capacity // 2 + 1:].sum(), 1))
            for size in range(capacity, 0, -1):
                m = min(need, int(left[size]))
                if m:
                    place(size, m, sequences, capacity)
                    if size < capacity:
                        gaps[capacity - size].append((sequences, m))
                    sequences += m
                    need -= m
    return out


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` (written: their partitions must stay) with ``rank``, their number within their length."""
    part = pieces.withColumn("_p", F.spark_partition_id())
    before = Window.partitionBy("length").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (part.groupBy("_p", "length").agg(F.count("*").alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    inside = F.row_number().over(Window.partitionBy("_p", "length").orderBy(*pieces.columns)) - 1
    return (part.withColumn("_i", inside).join(sizes.drop("_n"), ["_p", "length"])
            .withColumn("rank", F.col("_before") + F.col("_i")).drop("_p", "_i", "_before"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = cut_lineage(pieces)
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    rows = plan(counts, capacity)
    intervals = spark.createDataFrame(rows, "length long, lo long, hi long, sequence long, offset long")
    if len(rows) <= BROADCAST_ROWS:
        intervals = F.broadcast(intervals)
    df = ranked(pieces).join(intervals, "length").where("rank >= lo and rank < hi")
    return (df.withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("lo"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_pieces(docs, vocabulary, capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length",
                              F.crc32("ids").alias("ids_crc32")), capacity)
