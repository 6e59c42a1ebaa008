"""Source-versus-result audit (R1-R12) as one tidy result.

Each check returns rows ``(check_name, k, n)``; ``audit`` stacks them.  Only
counts leave the executors; no check pulls rows to the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import duplicated_keys, unmatched
from .housenumbers import distance_m


def count_rows(name: str, df: DataFrame, k: Column | None = None) -> DataFrame:
    """A2: the number of rows under a name."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("check_name"), (k if k is not None else F.lit("")).alias("k"), "n")


def tidy(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counts as rows (check_name, k, n)."""
    rows = [F.struct(F.lit(n).alias("check_name"), F.lit("").alias("k"), F.col(f"`{n}`").alias("n")) for n in names]
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A2: rows of ``df`` for which each condition holds, all in one pass over it."""
    return tidy(df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()]), list(rules))


def differs(a: Column, b: Column) -> Column:
    """Values differ; a value on one side only counts as well."""
    return ~a.eqNullSafe(b)


def having(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], missing: Sequence[str] = (),
           known: Sequence[str] = ()) -> DataFrame:
    """Groups whose aggregates ``missing`` are NULL and ``known`` are not."""
    g = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    for n in missing:
        g = g.filter(F.col(n).isNull())
    for n in known:
        g = g.filter(F.col(n).isNotNull())
    return g


def count_check(name: str, src: DataFrame, dst: DataFrame) -> DataFrame:
    """Row counts of source and result side by side."""
    return count_rows(f"{name} source", src).unionByName(count_rows(f"{name} result", dst))


def lost_rows(src: DataFrame, dst: DataFrame, key: str | Sequence[str],
              dst_key: str | Sequence[str] | None = None) -> DataFrame:
    """R2: source rows whose id is absent from the result."""
    return unmatched(src, dst, key, dst_key)


def mismatch(src: DataFrame, dst: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Per column, matched rows whose values differ (NULL-aware: a value on
    one side only counts as a mismatch)."""
    j = src.alias("s").join(dst.alias("d"), F.col(f"s.{key}") == F.col(f"d.{key}"))
    aggs = [F.count_if(differs(F.col(f"s.{a}"), F.col(f"d.{b}"))).alias(f"R3 {a}") for a, b in cols.items()]
    return tidy(j.agg(*aggs), [f"R3 {a}" for a in cols])


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys present more than once."""
    return duplicated_keys(df, key)


def coherence(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule (e.g. source list says IGN but ign id is NULL)."""
    return checks(df, {f"R5 {n}": ~F.coalesce(c, F.lit(False)) for n, c in rules.items()})


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Value frequencies."""
    return df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit("∅")).alias("k")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit(f"R6 {col}").alias("check_name"), "k", "n")


def refound(lost: DataFrame, kept: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lost rows that have an identical neighbour (same values on ``cols``) kept."""
    return lost.join(kept.select(*cols).distinct(), list(cols), "left_semi")


def mapping_check(df: DataFrame, src_col: str, dst_col: str, expected: dict[str, str]) -> DataFrame:
    """Rows whose recoded value is not the expected one for their source value."""
    exp = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    bad = df.filter(~F.coalesce(F.element_at(exp, F.col(src_col)) == F.col(dst_col), F.lit(False)))
    return bad.groupBy(F.col(src_col).alias("k")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"R8 {src_col}->{dst_col}").alias("check_name"), "k", "n")


def restrict_department(tables: dict[str, DataFrame], dep: str) -> dict[str, DataFrame]:
    """One department through the hierarchy municipality -> group ->
    house number -> position (prefix filter pushed to the scan, then semi joins)."""
    m = tables["municipality"].filter(F.col("insee").startswith(dep))
    g = tables["group"].join(m.select(F.col("pk").alias("municipality_id")), "municipality_id", "left_semi")
    h = tables["housenumber"].join(g.select(F.col("pk").alias("parent_id")), "parent_id", "left_semi")
    p = tables["position"].join(h.select(F.col("pk").alias("housenumber_id")), "housenumber_id", "left_semi")
    return {"municipality": m, "group": g, "housenumber": h, "position": p}


def distance_outliers(df: DataFrame, metres: float, lon1="lon", lat1="lat", lon2="lon2", lat2="lat2") -> DataFrame:
    """Matched points further apart than ``metres``, farthest first.

    Distances are on the sphere (see ``distance_m``): against the spheroid they
    differ by 0.5 % at most, that is 0.5 mm at the 0.1 m limit and 5 cm at the
    10 m limit.
    """
    d = df.withColumn("dist_m", distance_m(lon1, lat1, lon2, lat2))
    return d.filter(F.col("dist_m") > metres).orderBy(F.desc("dist_m"))


def ordinal_mismatch(a: DataFrame, b: DataFrame, key: str, col: str) -> DataFrame:
    """Same key in two sources, different ordinal."""
    j = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"))
    return j.filter(~F.col(f"a.{col}").eqNullSafe(F.col(f"b.{col}")))


def bad_foreign_ids(df: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """Foreign ids grouped (one row per id with its count) that the register lacks."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return unmatched(g, ref, key, ref_key)


def audit(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
