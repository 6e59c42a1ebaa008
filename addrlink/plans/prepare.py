"""Preparation of municipalities, streets and history.

All functions take and return DataFrames; dictionaries are joined on the words
they begin with, and AQE broadcasts them by their bytes.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import recode as RC
from ..functions import text as T
from ..operators.relational import first_word, join_leading_term, one_per_key


def blank_to_empty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> ``''`` on join columns that the reference compares with ``=``."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    return df


def municipality_name(article: str = "ARTMIN", name: str = "NCCENR") -> Column:
    """Display name = article + name, parentheses removed, apostrophe glued."""
    art = F.regexp_replace(F.coalesce(F.col(article), F.lit("")), "[()]", "")
    full = F.trim(F.concat_ws(" ", art, F.col(name)))
    return T.glue_apostrophe(full)


def redirect_insee(df: DataFrame, col: str, fusion: DataFrame, current: DataFrame,
                   current_col: str = "insee", move: dict[str, str] | None = None) -> DataFrame:
    """Codes that are not current and appear in the merger table move to the
    new code (one hop; a repeated old code keeps its latest merger, then the
    highest new code).

    ``move``: columns of a moved row that take the value of another column where
    they are blank (postcodes: the old name becomes line 5; one that is there stays).
    """
    fu = one_per_key(fusion.select("insee_old", "insee_new", "date"), "insee_old",
                     [-F.unix_date(F.to_date("date")), -F.col("insee_new").cast("long")])
    fu = fu.select(F.col("insee_old").alias("_old"), F.col("insee_new").alias("_new"))
    cur = current.select(F.col(current_col).alias("_cur")).distinct().withColumn("_is_cur", F.lit(True))
    out = df.join(cur, df[col] == cur["_cur"], "left").join(fu, df[col] == fu["_old"], "left")
    moved = F.col("_is_cur").isNull() & F.col("_new").isNotNull()
    changes = {to: F.when(moved & T.is_blank(to), F.col(by)).otherwise(F.col(to)) for to, by in (move or {}).items()}
    changes[col] = F.when(moved, F.col("_new")).otherwise(F.col(col))
    return out.withColumns(changes).drop("_cur", "_is_cur", "_old", "_new")


def drop_repeated_type(df: DataFrame, type_col: str, label_col: str, types: DataFrame) -> DataFrame:
    """D3: blank the street type when the label already starts with it, in its
    short or long form (four combinations)."""
    t = types.select("nom_court", "nom_long").dropna().distinct()
    forms = t.select(F.col("nom_court").alias("_k"), F.col("nom_court").alias("_f")).unionByName(
        t.select(F.col("nom_court").alias("_k"), F.col("nom_long").alias("_f"))).unionByName(
        t.select(F.col("nom_long").alias("_k"), F.col("nom_court").alias("_f"))).unionByName(
        t.select(F.col("nom_long").alias("_k"), F.col("nom_long").alias("_f"))).distinct()
    hits = join_leading_term(df.select(type_col, label_col).distinct(), label_col,
                             forms.select(F.col("_f").alias("_lead")), "_lead", longest=False)
    hits = hits.join(forms, (F.col(type_col) == F.col("_k")) & (F.col("_lead") == F.col("_f")))
    hits = hits.select(type_col, label_col).distinct().withColumn("_rep", F.lit(True))
    out = df.join(hits, [type_col, label_col], "left")
    return out.withColumn(type_col, F.when(F.col("_rep"), F.lit("")).otherwise(F.col(type_col))).drop("_rep")


def street_kind(df: DataFrame, label_col: str, types: DataFrame, prefer: str = "short") -> DataFrame:
    """Kind from the leading type (way/area), default area, numbered roads are ways."""
    t = types.select("nom_court", "nom_long", "kind")
    short = join_leading_term(df.select(label_col).distinct(), label_col,
                              t.select(F.col("nom_court").alias("_s")), "_s", how="left")
    short = short.join(t.select(F.col("nom_court").alias("_s"), F.col("kind").alias("_ks"))
                                          .dropDuplicates(["_s"]), "_s", "left")
    long_ = join_leading_term(short, label_col, t.select(F.col("nom_long").alias("_l")), "_l", how="left")
    long_ = long_.join(t.select(F.col("nom_long").alias("_l"), F.col("kind").alias("_kl"))
                                          .dropDuplicates(["_l"]), "_l", "left")
    kind = (F.coalesce("_ks", "_kl") if prefer == "short" else F.coalesce("_kl", "_ks"))
    kind = F.when(RC.road_number(label_col), F.lit("way")).otherwise(F.coalesce(kind, F.lit("area")))
    kinds = long_.select(label_col, kind.alias("kind"))
    return df.join(kinds, label_col, "left")


def tax_label(nature: str = "nature_voie", label: str = "libelle_voie") -> Column:
    """Full tax-office label = nature + label, trimmed, upper/unaccented."""
    return T.nom_maj(F.trim(F.concat_ws(" ", F.trim(F.col(nature)), F.trim(F.col(label)))))


def prepare_fantoir(fantoir: DataFrame) -> DataFrame:
    """Keep valid streets (cancel flag blank), 9-char id (the full id without ``_`` and key), nom_maj."""
    f = fantoir.filter(F.coalesce(F.col("caractere_annul"), F.lit(" ")).isin(" ", ""))
    nine = F.left(F.replace("fantoir", F.lit("_"), F.lit("")), F.lit(9))
    return f.withColumn("fantoir_9", nine).withColumn("nom_maj", tax_label())


def dict_2017(types: DataFrame, ways: Sequence[str], areas: Sequence[str]) -> DataFrame:
    """Kind and priority of the 2017 type dictionary by literal lists."""
    t = types.withColumn("kind", F.when(F.col("nom_maj").isin(*ways), F.lit("way"))
                         .when(F.col("nom_maj").isin(*areas), F.lit("area"))
                         .when(F.col("nom_maj").like("CHEMIN%"), F.lit("way")).otherwise(F.lit("area")))
    return t.withColumn("priorite", F.when(F.col("nom_maj").isin(*ways), F.lit(2))
                        .when(F.col("nom_maj").isin(*areas), F.lit(1)).otherwise(F.lit(0)))


def street_redirects(fantoir: DataFrame) -> DataFrame:
    """Cancelled street -> successor in the same municipality created
    the day it was cancelled, still valid, whose label contains the old last
    word (literal containment; a ``*`` last word is not used)."""
    old = fantoir.filter(F.col("date_annul").isNotNull() & (F.col("date_annul") != "0000000")).alias("o")
    new = fantoir.filter(F.col("date_annul") == "0000000").alias("n")
    j = old.join(new, (F.col("o.code_insee") == F.col("n.code_insee")) &
                 (F.col("o.date_annul") == F.col("n.date_creation")))
    j = j.filter((F.col("o.dernier_mot") != "*") &
                 F.col("n.libelle_voie").contains(F.trim(F.col("o.dernier_mot"))))
    bare = lambda c: F.replace(c, F.lit("_"), F.lit(""))
    return j.select(bare("o.fantoir").alias("old"), bare("n.fantoir").alias("new"))


def municipality_redirects(history: DataFrame) -> DataFrame:
    """Municipality -> successor code (0-based slice [11:16] of ``successors``,
    i.e. characters 12-16), not itself."""
    succ = F.substr(F.col("successors"), F.lit(12), F.lit(5))
    return history.select(F.col("insee_code").alias("old"), succ.alias("new")).filter(
        F.col("new").isNotNull() & (F.col("new") != "") & (F.col("new") != F.col("old"))).distinct()


# Display names rebuilt from abbreviated labels ------------------------------
def elide(c) -> Column:
    """``L``, ``D`` and ``QU`` before a vowel, H or Y get their apostrophe and lose their capitals (global)."""
    c = T._c(c)
    for a, b in (("L", "l"), ("D", "d"), ("QU", "qu")):
        c = F.regexp_replace(c, f"(^| ){a} ([AEIOUYH])", f"$1{b}'$2")
    return c


#: Words that are written out wherever they stand (fixed values)
WRITTEN_OUT = [("(^| )ST ", "$1Saint-")]


def unabbreviate(df: DataFrame, col: str, rules: DataFrame, out: str = "display") -> DataFrame:
    """Names rebuilt from abbreviated labels by an ordered rule table.

    ``rules``: rank, lead (abbreviation at the beginning), repeats (forms of the
    type that may follow it once more and are dropped), required (one of them
    must follow), shown (what is written).  The first rule by rank that fits
    applies; before it articles are elided, after it ``WRITTEN_OUT`` is.
    A label meets the rules of its first word in an equi-join.
    """
    of = rules.select(first_word(F.col("lead")).alias("_w"), F.struct("rank", "lead", "repeats", "required", "shown").alias("_r"))
    of = of.groupBy("_w").agg(F.array_sort(F.collect_list("_r")).alias("_rules"))
    names = df.select(F.col(col).alias("_label")).dropna().distinct().withColumn("_n", elide("_label"))
    j = names.withColumn("_w", first_word(F.col("_n"))).join(of, "_w", "left")

    def followed(r: Column) -> Column:
        """The longest repeat behind the lead of rule ``r``, as a struct of its length; null if there is none."""
        rest = F.concat(F.substr(F.col("_n"), F.length(r["lead"]) + 2), F.lit(" "))
        return F.array_max(F.transform(F.filter(r["repeats"], lambda x: rest.startswith(F.concat(x, F.lit(" ")))), F.length))

    fits = F.filter("_rules", lambda r: F.col("_n").startswith(F.concat(r["lead"], F.lit(" "))) & (
        ~r["required"] | followed(r).isNotNull()))
    j = j.withColumn("_rule", F.get(fits, F.lit(0)))
    skip = F.length("_rule.lead") + 2 + F.coalesce(followed(F.col("_rule")) + 1, F.lit(0))
    shown = F.when(F.col("_rule").isNotNull(), F.trim(F.concat(F.col("_rule.shown"), F.lit(" "), F.substr(F.col("_n"), skip)))
                   ).otherwise(F.col("_n"))
    for pattern, text in WRITTEN_OUT:
        shown = F.regexp_replace(shown, pattern, text)
    j = j.select("_label", shown.alias(out))
    return df.join(j, df[col] == j["_label"], "left").drop("_label")


def _replace_lead(df: DataFrame, col: str, pairs: DataFrame, out: str) -> DataFrame:
    """``out``: ``col`` with its leading term (column ``a`` of ``pairs``, longest) replaced by ``b``; null without one."""
    p = pairs.dropna().groupBy("a").agg(F.min("b").alias("b"))
    hit = join_leading_term(df.select(col).distinct(), col, p.select(F.col("a").alias("_a")), "_a", how="left")
    hit = hit.join(p.withColumnsRenamed({"a": "_a", "b": "_b"}), "_a", "left")
    new = F.when(F.col("_b").isNotNull(), F.concat("_b", F.lit(" "), F.substr(col, F.length("_a") + 2)))
    return df.join(hit.select(F.col(col).alias("_k"), new.alias(out)), F.col(col) == F.col("_k"), "left").drop("_k")


def restore_type(df: DataFrame, col: str, types: DataFrame) -> DataFrame:
    """Display name, normalised name and kind by the 2017 type dictionary (nom_maj, nom_min, nom_abbr, kind, priorite).

    * ``accented``: a leading type written without accents gets them back;
    * ``normalised``: upper case, unaccented, the leading type abbreviated (else as it is);
    * ``kind``: that of the abbreviation that leads the normalised name, else area;
    * ``display``: the accented name if it has small letters; else the normalised
      name with its type written out (types of priority 2); else the accented
      name - in capitalised small letters, roman numerals in capitals.
    """
    t = types
    df = _replace_lead(df, col, t.select(T.unaccent("nom_min").alias("a"), F.col("nom_min").alias("b")), "accented")
    df = df.withColumn("accented", F.coalesce("accented", F.col(col))).withColumn("_up", T.unaccent_upper("accented"))
    df = _replace_lead(df, "_up", t.select(F.col("nom_maj").alias("a"), F.col("nom_abbr").alias("b")), "normalised")
    df = df.withColumn("normalised", F.coalesce("normalised", "_up"))
    kinds = t.groupBy(F.col("nom_abbr").alias("_w")).agg(F.max("kind").alias("kind"))
    df = df.withColumn("_w", first_word(F.col("normalised"))).join(kinds, "_w", "left")
    df = df.withColumn("kind", F.coalesce("kind", F.lit("area")))
    full = t.filter(F.col("priorite") == 2).select(F.col("nom_abbr").alias("a"), F.col("nom_min").alias("b"))
    df = _replace_lead(df, "normalised", full, "_full")
    name = F.when(F.col("accented").rlike("[a-z]"), F.col("accented")).otherwise(F.coalesce("_full", "accented"))
    return df.withColumn("display", T.upper_romans(T.title_case(name))).drop("_up", "_w", "_full")
