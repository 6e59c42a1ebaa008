"""Tax-office <-> IGN street linking on the reference's schemas.

``link_tax_ign`` runs the whole ordered cascade:

* sides: ``dgfip_fantoir`` (fantoir_9, code_insee, nom_maj) as left,
  ``ign_group`` (id_pseudo_fpb, id_fantoir, code_insee, nom, nom_maj,
  insee_obs) as right, both joined to the label table (long -> court);
* the 30 automatic passes in the reference order, the purge of tax ids
  linked twice (M31), human decisions (M32) and the unmatched sets (M33).

The street-type passes use the dictionary of short types (J7 leading-term
join, longest type); M26 uses the merger table (former municipality name).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cascade as C
from ..operators.relational import join_leading_term, unmatched


def _nb(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def with_labels(df: DataFrame, labels: DataFrame, name: str = "name") -> DataFrame:
    lab = labels.select(F.col("long").alias("_long"), "court")
    return df.join(lab, df[name] == lab["_long"], "left").drop("_long")


def with_types(df: DataFrame, types: DataFrame, key: str = "court") -> DataFrame:
    """Leading street type (``t``), the label without it (``rest``), last word (``lw``)."""
    t = types.select(F.col("nom_court").alias("t")).dropna().distinct()
    out = join_leading_term(df, key, t, "t", how="left")
    rest = F.when(F.col("t").isNotNull(), F.substr(F.col(key), F.length("t") + 2)).otherwise(F.col(key))
    return out.withColumn("rest", rest).withColumn("lw", T.last_word(F.col(key)))


def ign_sides(fantoir: DataFrame, ign_group: DataFrame, labels: DataFrame, types: DataFrame,
              fusion: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    left = fantoir.select(F.col("fantoir_9").cast("string").alias("lid"), F.col("code_insee").alias("block"),
                          F.col("nom_maj").alias("name"))
    right = ign_group.select(F.col("id_pseudo_fpb").cast("string").alias("rid"),
                             F.col("code_insee").alias("block"), F.col("nom_maj").alias("name"),
                             F.col("id_fantoir").cast("string").alias("ref"), "nom", "insee_obs")
    left = with_types(with_labels(left, labels), types).withColumn("tri", T.trigram_codes("court"))
    right = with_types(with_labels(right, labels), types).withColumn("tri", T.trigram_codes("court"))
    # Former municipality name through the merger table
    if fusion is not None:
        fu = fusion.select(F.col("insee_old").alias("insee_obs"), "nom_old")
        right = right.join(fu, "insee_obs", "left")
        old = T.without_paren(T.unaccent_upper("nom_old"))
        old = F.regexp_replace(old, "(^| )((" + T.alt(T.ARTICLES) + ") )*", " ")
        right = right.withColumn("court_obs", T.replace_first(
            F.concat(F.col("court"), F.lit(" "), old), "  ", " "))
    else:
        right = right.withColumn("court_obs", F.lit(None).cast("string"))
    right = right.withColumn("paren", T.paren_name("name"))
    left = left.withColumn("paren", T.paren_name("name"))
    return left, right


# ----------------------------------------------------------------- key pairs, one set per measure
#: Finder of M15, M18, M30 (L14-L16): labels of a block within one edit
edit_keys = C.one_edit_keys(4)
#: Finder of M19: full names of a block within one edit
edit_names = C.one_edit_keys(5)


def longer(n: int) -> Column:
    """Both keys are longer than ``n`` characters."""
    return (F.col("llen") > n) & (F.col("rlen") > n)


# ----------------------------------------------------------------- passes
def _named(side: DataFrame) -> Column:
    return _nb(F.col("name"))


def _same_id(rule: str, pred) -> C.SameIdPass:
    return C.SameIdPass(rule, pred, right_filter=_named)


def _court(fmt) -> Callable:
    """Predicate: the tax label is the IGN label rewritten by ``fmt``."""
    return lambda l, r: F.col("l.court") == fmt(F.col("r.court"))


def final_letter(l, r) -> Column:
    """Labels that differ by one final E, S or X on either side."""
    lc, rc = F.col("l.court"), F.col("r.court")
    one = [a == F.concat(b, F.lit(x)) for x in "ESX" for a, b in ((rc, lc), (lc, rc))]
    return reduce(lambda a, b: a | b, one)


def m1(): return C.SameIdPass("M1", lambda l, r: F.col("l.name") == F.col("r.name"))
def m2(): return _same_id("M2", lambda l, r: F.col("l.court") == F.col("r.court"))


def m3() -> C.SameIdPass:
    """Same id, same leading type and same last word (last word is not the type)."""
    return C.SameIdPass("M3", lambda l, r: F.col("r.t").isNotNull() & (F.col("r.t") == F.col("l.t")) &
                        (F.col("r.lw") == F.col("l.lw")) & (F.col("r.lw") != F.col("r.t")),
                        left_filter=lambda l: F.col("name").isNotNull())


def m4(): return C.OneToOnePass("M4", "name", "name", C.equal_keys, group_side="l")
def m5(): return C.OneToOnePass("M5", "court", "court", C.equal_keys)


def m6() -> C.SameIdPass:
    """Same id, ``ENCEINTE x`` (IGN) <-> ``EN x`` (tax), IGN label longer than 11."""
    return C.SameIdPass(
        "M6", lambda l, r: F.col("r.court").startswith("ENCEINTE ") & F.col("l.court").startswith("EN ") &
        (F.regexp_replace("r.court", "^ENCEINTE ", "") == F.regexp_replace("l.court", "^EN ", "")) &
        (F.length("r.court") > 11), left_filter=_named)


def m7(): return C.SameIdPass("M7", final_letter, left_filter=_named)


def trigram_same_id(rule: str, cmp, guard: str = "r.court", left_filter=_named) -> C.SameIdPass:
    """Same id and a trigram distance for which ``cmp`` holds; ``guard`` is longer than 6."""
    distance = lambda l, r: T.trigram_distance_arrays("l.tri", "r.tri")
    return C.SameIdPass(rule, lambda l, r: cmp(distance(l, r)) & (F.length(guard) > 6),
                        left_filter=left_filter, trigram=distance)


def m8(): return trigram_same_id("M8", lambda d: d == 0)


_M9 = C.rewritten_keys(lambda lk: F.regexp_replace(lk, "^EN ", ""), lambda rk: rk, lcond=lambda lk: lk.startswith("EN "))
_M9B = C.rewritten_keys(lambda lk: lk, lambda rk: F.regexp_replace(rk, "^EN ", "EN"), rcond=lambda rk: rk.startswith("EN "))


def m9():
    """``EN x`` (tax) <-> ``x`` (IGN) inside the block, 1-1, id check."""
    return C.OneToOnePass("M9", "court", "court", _M9, id_check=True)


def m9b():
    """Second direction of M9: ``EN x`` (IGN) <-> ``ENx`` (tax)."""
    return C.OneToOnePass("M9", "court", "court", _M9B, id_check=True, with_previous=True)


def typed_keys(lcol: str, rcol: str, differ: bool = False, lt: str | None = "t", rt: str | None = "t"):
    """Finder: equal labels of a block once the leading types are off.

    ``lcol``/``rcol``: what is compared on each side (the whole key or its
    rest); ``lt``/``rt``: type columns that must be known; ``differ``: and differ.
    """
    def finder(la: DataFrame, ra: DataFrame) -> DataFrame:
        a = la.filter(F.col(lt).isNotNull()) if lt else la
        b = ra.filter(F.col(rt).isNotNull()) if rt else ra
        types = ([F.col(lt).alias("_lt")], [F.col(rt).alias("_rt")]) if differ else ([], [])
        j = C.keyed(a, "lk", "l", F.col(lcol), *types[0]).join(C.keyed(b, "rk", "r", F.col(rcol), *types[1]), ["block", "_j1", "_j2"])
        return (j.filter(F.col("_lt") != F.col("_rt")) if differ else j).drop("_j1", "_j2", "_lt", "_rt")
    return finder


def _typed_pass(rule: str, finder, id_check: bool) -> C.OneToOnePass:
    return C.OneToOnePass(rule, "court", "court", finder, id_check=id_check, extra_left=["t", "rest"],
                          extra_right=["t", "rest"])


def m10(id_check: bool = True): return _typed_pass("M10", typed_keys("rest", "rest", differ=True), id_check)
def m11(id_check: bool = True): return _typed_pass("M11", typed_keys("lk", "rest", lt=None), id_check)
def m12(id_check: bool = True): return _typed_pass("M12", typed_keys("rest", "rk", rt=None), id_check)
def m13(): return trigram_same_id("M13", lambda d: d < 0.15)


def _trigram(rule: str, t: float, **kw) -> C.OneToOnePass:
    return C.OneToOnePass(rule, "court", "court", C.TrigramGroups(t), rmin=6, **kw)


def _edits(rule: str, k: int, n: int, **kw) -> C.OneToOnePass:
    return C.OneToOnePass(rule, "court", "court", edit_keys, accept=(F.col("levenshtein") < k) & longer(n), **kw)


def m14(): return _trigram("M14", 0.4, id_check=True, left_filter=_named)
def m15(): return _edits("M15", 2, 6, id_check=True, left_filter=_named)
def m16(): return C.OneToOnePass("M16", "court", "court", C.EditGroups(2), lmin=10, rmin=10, id_check=True, left_filter=_named)
def m17(): return _trigram("M17", 0.15, drop_doubles=True)
def m18(): return _edits("M18", 2, 6, drop_doubles=True)


def m19():
    """One edit between full names longer than 5, 1-1 by tax name, id check, doubles dropped."""
    return C.OneToOnePass("M19", "name", "name", edit_names, group_side="l", id_check=True, drop_doubles=True,
                          left_filter=_named, accept=(F.col("levenshtein") < 2) & longer(5))


def m20(): return _same_id("M20", _court(lambda c: F.concat(c, F.lit(" SUD"))))
def m21(): return _same_id("M21", _court(lambda c: F.concat(c, F.lit(" NORD"))))
def m22(): return _same_id("M22", _court(lambda c: F.concat(c, F.lit(" EST"))))
def m23(): return _same_id("M23", _court(lambda c: F.concat(c, F.lit(" OUEST"))))
def m24(): return _same_id("M24", _court(lambda c: F.concat(c, F.lit(" HAM"))))
def m25(): return _same_id("M25", _court(lambda c: F.concat(F.lit("SOUS "), c)))
def m26(): return C.SameIdPass("M26", lambda l, r: F.col("l.court") == F.col("r.court_obs"),
                               right_filter=lambda r: _named(r) & F.col("insee_obs").isNotNull())
def m27(): return _same_id("M27", lambda l, r: F.col("r.court") == F.concat(F.col("l.court"), F.lit(" "), F.col("r.paren")))
def m28(): return _same_id("M28", lambda l, r: F.col("l.court") == F.concat(F.col("r.court"), F.lit(" "), F.col("l.paren")))


def m29():
    """The IGN label cut to the tax label's length (tax labels end at 26 characters)."""
    return _same_id("M29", lambda l, r: (F.length("l.court") > 9) & (
        F.col("l.court") == F.substr(F.col("r.court"), F.lit(1), F.length("l.court"))))


def m30(): return _edits("M30", 2, 4, id_check=True, left_filter=_named)


#: The automatic passes in the reference order (M9 runs both directions).
IGN_PASSES = [m1, m2, m3, m4, m5, m6, m7, m8, m9, m9b, m10, m11, m12, m13, m14, m15, m16, m17, m18, m19,
              m20, m21, m22, m23, m24, m25, m26, m27, m28, m29, m30]


def ign_passes() -> list[C.Pass]:
    """The cascade; the first three passes ask for a free IGN street only (M31 then purges doubles)."""
    passes = [p() for p in IGN_PASSES]
    return [replace(p, free="right") for p in passes[:3]] + passes[3:]


def link_tax_ign(fantoir: DataFrame, ign_group: DataFrame, labels: DataFrame, types: DataFrame,
                 fusion: DataFrame | None = None, decisions: DataFrame | None = None,
                 passes: list | None = None) -> dict[str, DataFrame]:
    """Links, the unmatched IGN groups, and the review set with an id.

    Returns ``links`` (lid = tax id, rid = IGN id, rule), ``ign_unmatched``
    (M33 all without link) and ``review`` (M33 with a tax id whose tax row is
    also unlinked, with previous decisions joined back, K7).
    """
    left, right = ign_sides(fantoir, ign_group, labels, types, fusion)
    res = C.run_cascade(left, right, passes if passes is not None else ign_passes())
    links = res.links
    if decisions is not None:
        # Still-unmatched IGN streets that a human confirmed get the tax id they carry
        dec = decisions.filter(F.col("app") == 1).select(F.col("id_pseudo_fpb").cast("string").alias("rid"))
        human = unmatched(right, links, "rid").join(dec, "rid", "left_semi").select(
            F.col("ref").alias("lid"), "rid", F.lit("M32").alias("rule"), "ref",
            F.lit(None).cast("float").alias("trigram"), F.lit(None).cast("float").alias("levenshtein"),
            F.lit(len(ign_passes()) + 1).alias("step"))
        links = links.unionByName(human)
    ign_un = unmatched(right, links, "rid")
    tax_un = unmatched(left, links, "lid")
    review = (ign_un.alias("i").join(tax_un.alias("f"), F.col("f.lid") == F.col("i.ref"))
              .select(F.col("i.ref").alias("id_fantoir"), F.col("i.rid").alias("id_pseudo_fpb"),
                      F.col("i.name").alias("nom_maj"), F.col("f.name").alias("nom_maj_fantoir"),
                      F.col("i.court").alias("court_ign"), F.col("f.court").alias("court_fantoir")))
    if decisions is not None:
        # previous decisions (two UPDATE ... FROM in the reference, any row
        # winning): the largest non-null value wins here
        prev = decisions.groupBy(F.col("id_pseudo_fpb").cast("string").alias("id_pseudo_fpb")).agg(
            F.max(F.col("app").cast("string")).alias("app"), F.max("comm").alias("comm"))
        review = review.join(prev, "id_pseudo_fpb", "left")
    return {"links": links, "ign_unmatched": ign_un, "tax_unmatched": tax_un,
            "review": review.orderBy("id_fantoir")}
