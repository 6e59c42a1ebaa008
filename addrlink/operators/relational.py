"""Joins, per-key selection and aggregates used by every stage (J*, A*, W*, O*).

All of these are DataFrame compositions; Catalyst picks the physical join, and
AQE broadcasts a dictionary side from its measured bytes.  Larger joins stay
sort-merge, so a hot key is split by the skew-join rule instead of landing in
one task.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# ---------------------------------------------------------------- J3 J4 J5
def unmatched(cands: DataFrame, links: DataFrame, key: str | Sequence[str],
              link_key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``cands`` whose key is absent from ``links``.

    NULL keys in ``links`` are dropped first (SQL ``NOT IN`` would return
    nothing at all when the list holds a NULL).
    """
    k = _cols(key)
    lk = _cols(link_key) if link_key is not None else k
    right = links.select(*[F.col(a).alias(b) for a, b in zip(lk, k)])
    # no distinct: duplicate keys do not change an anti join, and skipping it
    # saves a shuffle per call (twice per cascade pass)
    right = right.dropna(subset=k)
    return cands.join(right, k, "left_anti")


def matched(df: DataFrame, ref: DataFrame, key: str | Sequence[str],
            ref_key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` with at least one partner in ``ref`` (EXISTS)."""
    k = _cols(key)
    rk = _cols(ref_key) if ref_key is not None else k
    right = ref.select(*[F.col(a).alias(b) for a, b in zip(rk, k)])
    return df.join(right, k, "left_semi")


def join_known(df: DataFrame, src: DataFrame, key: str, blank: bool = True) -> DataFrame:
    """Left join on ``key``, unknown in any number of rows of ``df``: NULL or, with ``blank``, empty (never in ``src`` then).

    Rows without a key meet nothing: a hash of the row deals them out, where the
    empty key would put all of them into one task.
    """
    known = F.col(key) != "" if blank else F.col(key).isNotNull()
    spread = F.when(known, F.lit(0)).otherwise(F.xxhash64(*df.columns).bitwiseOR(F.lit(1)))
    return df.withColumn("_spread", spread).join(
        src.withColumn("_spread", F.lit(0).cast("long")), [key, "_spread"], "left").drop("_spread")


def append(*dfs: DataFrame) -> DataFrame:
    """O3/P10: UNION ALL by name, missing columns padded with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# ---------------------------------------------------------------- J6
def one_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under an explicit order (``DISTINCT ON``).

    Implemented with ``max_by``/``min_by`` over a struct so the reduction is
    a partial + final aggregate (map-side combine, no per-key sort of a hot
    key in one task).  ``order`` columns are ascending; the smallest wins.
    """
    k = _cols(key)
    others = [c for c in df.columns if c not in k]
    order_struct = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    payload = F.struct(*[F.col(c) for c in others])
    red = df.groupBy(*k).agg(F.min_by(payload, order_struct).alias("_p"))
    return red.select(*k, *[F.col("_p." + c).alias(c) for c in others])


def update_from(target: DataFrame, src: DataFrame, key: str | Sequence[str],
                cols: dict[str, str], order: Sequence[Column] | None = None) -> DataFrame:
    """``UPDATE target SET col = src.val FROM src WHERE key matches``.

    Several ``src`` rows per key: the first under ``order`` wins (the
    reference lets an arbitrary row win).  Columns not matched keep their
    old value.
    """
    k = _cols(key)
    if order is None:
        order = [F.col(v) for v in cols.values()]
    order = list(order)
    s = src.select(*k, *[F.col(v).alias("_new_" + t) for t, v in cols.items()],
                   *[o.alias(f"_ord{i}") for i, o in enumerate(order)])
    s = s.withColumn("_hit", F.lit(True))
    s = one_per_key(s, k, [F.col(f"_ord{i}") for i in range(len(order))])
    s = s.drop(*[f"_ord{i}" for i in range(len(order))])
    out = target.join(s, k, "left")
    for t in cols:
        new = F.col("_new_" + t)
        if t in target.columns:
            out = out.withColumn(t, F.when(F.col("_hit"), new).otherwise(F.col(t)))
        else:
            out = out.withColumn(t, new)
    return out.drop("_hit", *["_new_" + t for t in cols])


# ---------------------------------------------------------------- J7
#: first words of a dictionary that is sent to every task; a larger one is joined by shuffle
SMALL = 50_000


def first_word(label: Column) -> Column:
    """What stands before the first space (the whole label if there is none)."""
    return F.substring_index(label, " ", 1)


def join_leading_term(df: DataFrame, label_col: str, terms: DataFrame, term_col: str,
                      how: str = "inner", longest: bool = True) -> DataFrame:
    """``label LIKE term || ' %'`` as an equi-join on the first word, not a nested loop.

    The terms of one first word are one row (a dictionary has a handful of
    them), so the join multiplies nothing and ships no label twice; which of
    them lead the label is then decided inside the row.  With ``longest`` one
    row per input row is kept: the longest leading term (rows without a term
    survive a ``left`` join with NULL); otherwise one row per leading term.
    """
    t = terms.select(F.col(term_col).alias("_term")).dropna().distinct()
    t = cut_lineage(t.groupBy(first_word(F.col("_term")).alias("_w")).agg(F.collect_list("_term").alias("_terms")))
    if t.count() <= SMALL:  # counted: labels that begin with one word then stay where they are
        t = F.broadcast(t)
    out = df.withColumn("_fw", first_word(F.col(label_col))).join(t, F.col("_fw") == F.col("_w"), "left")
    out = out.withColumn("_hit", F.filter("_terms", lambda x: F.startswith(
        F.col(label_col), F.concat(x, F.lit(" ")))))
    if longest:
        best = F.array_max(F.transform("_hit", lambda x: F.struct(F.length(x).alias("n"), x.alias("t"))))
        out = out.withColumn(term_col, best["t"])
    else:
        out = out.withColumn(term_col, F.explode_outer("_hit"))
    out = out.drop("_fw", "_w", "_terms", "_hit")
    return out if how == "left" else out.filter(F.col(term_col).isNotNull())


# ---------------------------------------------------------------- J16
def join_any(df: DataFrame, arr_df: DataFrame, key: str, arr_col: str,
             how: str = "inner") -> DataFrame:
    """``df.key = ANY(arr_df.arr_col)`` via explode + equi-join."""
    ex = arr_df.withColumn(key, F.explode(arr_col))
    return df.join(ex, key, how)


# ---------------------------------------------------------------- A4 A5 A9
def one_to_one(pairs: DataFrame, keys: str | Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """A4: ``GROUP BY keys HAVING count(*) = 1`` with ``max()`` as "the" value."""
    g = pairs.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("_n"),
                                        *[c.alias(n) for n, c in aggs.items()])
    return g.filter(F.col("_n") == 1).drop("_n")


def duplicated_keys(df: DataFrame, key: str | Sequence[str], min_count: int = 2) -> DataFrame:
    """Key values with at least ``min_count`` rows (partial aggregation)."""
    k = _cols(key)
    return (df.dropna(subset=k).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def drop_ambiguous(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Delete every row whose key occurs more than once."""
    k = _cols(key)
    return df.join(duplicated_keys(df, k).select(*k), k, "left_anti")


def multi_key_rows(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    k = _cols(key)
    return df.join(duplicated_keys(df, k).select(*k), k, "left_semi")


def ordered_list(df: DataFrame, keys: str | Sequence[str], col: str, sep: str = ",") -> DataFrame:
    """Ordered distinct string aggregation plus the max value."""
    return df.groupBy(*_cols(keys)).agg(
        F.array_join(F.array_sort(F.collect_set(col)), sep).alias(f"{col}_list"),
        F.max(col).alias(f"{col}_max"))


def count_by(df: DataFrame, keys: Iterable[str] = (), cond: Column | None = None,
             name: str = "n") -> DataFrame:
    """Row counts per key, optionally only rows satisfying ``cond``."""
    agg = F.count_if(cond).alias(name) if cond is not None else F.count(F.lit(1)).alias(name)
    keys = list(keys)
    return df.groupBy(*keys).agg(agg) if keys else df.agg(agg)


# ---------------------------------------------------------------- A10
def assign_ids(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """A10: dense surrogate ids 1..n in ``order`` without a single-partition window.

    Rows are range-partitioned on the order and written to the checkpoint
    folder, numbered inside their partition, and shifted by the sizes of the
    preceding partitions (a tiny aggregate).  Ties are numbered in any order.
    """
    cols = list(order)
    n_parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # written once: range bounds come from a sample, so a second evaluation
    # could cut the rows elsewhere and numbers and sizes would not belong together
    ranged = cut_lineage(df.repartitionByRange(n_parts, *cols).withColumn("_pid", F.spark_partition_id()))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_sz"))
    offs = sizes.select("_pid", F.coalesce(
        F.sum("_sz").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))  # one row per partition
    numbered = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*cols)))
    out = numbered.join(offs, "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("long")).drop("_pid", "_rn", "_off")


# ---------------------------------------------------------------- W1 W2 J14
def stack_heads(df: DataFrame, stack_keys: Sequence[str], order: Sequence[str],
                id_col: str = "id", head_col: str = "id_hn") -> DataFrame:
    """Rank rows inside a semantic stack; every row gets its head id.

    ``rank = 1`` (first under ``order``) is the head.  The head is found with
    an aggregate (``min_by``) and joined back, so a hot stack is reduced
    map-side instead of being sorted in one task.  Rows whose stack key has a
    NULL get a NULL head (the reference's join on NULL never matches), except
    the head itself which always points to itself.
    """
    k = list(stack_keys)
    order_struct = F.struct(*[F.col(c) for c in order])
    heads = df.groupBy(*k).agg(F.min_by(F.col(id_col), order_struct).alias("_head"))
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(heads[c]) for c in k])
    out = df.join(heads, cond, "left").select(df["*"], heads["_head"])
    is_head = F.col("_head") == F.col(id_col)
    keys_known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k])
    head = F.when(is_head, F.col(id_col)).when(keys_known, F.col("_head"))
    return (out.withColumn("is_head", F.coalesce(is_head, F.lit(False)))
            .withColumn(head_col, head).drop("_head"))
