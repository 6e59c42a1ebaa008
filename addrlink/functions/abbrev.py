"""Dictionary abbreviation folded into one per-row expression.

A regex join of every dictionary term against every label (the reference's
UPDATE ... FROM) recompiles patterns per row and is a nested-loop join.  Here
the dictionary, a small bounded input, is compiled once into

* one word-bounded alternation per length of the literal terms, tried from the
  longest length down; its leftmost hit is looked up in a literal map and
  spliced in place, and
* the few true-regex entries as ordered first-only replacements that take
  precedence (they are the longest entries).

Each pass rewrites at most one occurrence per label (the reference's
one-rule-per-row UPDATE); rule choice is deterministic: the longest term
anywhere in the label, of equally long ones the leftmost.

That is for curated dictionaries, whose pairs are given as Python values.  A
dictionary that is a table, of whatever size, is joined instead
(``abbreviate_join``): the words of a label meet the first words of the terms
in an equi-join, with the same choice of rule and the same result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _c, shift_groups, trie_alt

#: Characters of a word, as the word boundary of the patterns has them.
WORD = r"[\p{L}\p{Nd}_]"
_META = re.compile(r"[\\^$.|?*+()\[\]{}]")

# A small sample dictionary of our own (long form -> short form); the real one
# is an input file read with ``sources.readers.read_dictionary``.
SAMPLE_ABBREV = [
    ("AVENUE", "AV"), ("BOULEVARD", "BD"), ("CHEMIN", "CHE"), ("ROUTE", "RTE"),
    ("PLACE", "PL"), ("IMPASSE", "IMP"), ("ALLEE", "ALL"), ("LOTISSEMENT", "LOT"),
    ("RESIDENCE", "RES"), ("SAINT", "ST"), ("SAINTE", "STE"), ("GRANDE", "GDE"),
    ("GRAND", "GD"), ("QUARTIER", "QUA"), ("DOCTEUR", "DR"),
    ("GENERAL", "GAL"), ("MARECHAL", "MAL"), ("PROFESSEUR", "PR"), ("ZONE ARTISANALE", "ZA"),
    ("ZONE INDUSTRIELLE", "ZI"), ("SQUARE", "SQ"), ("PASSAGE", "PAS"), ("CHEMIN RURAL", "CR"),
]


@dataclass(frozen=True)
class AbbrevDict:
    literal: tuple[tuple[str, str], ...]
    regex: tuple[tuple[str, str], ...]

    @staticmethod
    def from_pairs(pairs) -> "AbbrevDict":
        pairs = [(str(a), str(b)) for a, b in pairs if a]
        lit, rx = {}, {}
        for a, b in pairs:
            (rx if _META.search(a) else lit).setdefault(a, b)
        by_len = lambda kv: (-len(kv[0]), kv[0])
        return AbbrevDict(tuple(sorted(lit.items(), key=by_len)),
                          tuple(sorted(rx.items(), key=by_len)))

    def by_length(self) -> list[list[tuple[str, str]]]:
        """Literal terms of one length each, from the longest down."""
        return [list(g) for _, g in groupby(self.literal, lambda kv: len(kv[0]))]


def abbreviate_once(c, d: AbbrevDict) -> Column:
    """One pass: at most one term rewritten per label."""
    c = _c(c)
    out = c
    for terms in reversed(d.by_length()):  # the longest ends up outermost and is tried first
        word = "\\b(" + trie_alt(a for a, _ in terms) + ")\\b"
        first = "(?s)^(.*?)" + word
        prefix, hit = F.regexp_extract(c, first, 1), F.regexp_extract(c, first, 2)
        short = F.element_at(F.create_map(*[F.lit(x) for kv in terms for x in kv]), hit)
        spliced = F.concat(prefix, short, F.substr(c, F.length(prefix) + F.length(hit) + 1))
        out = F.when(c.rlike(word), spliced).otherwise(out)
    # regex entries: the first (longest) one that changes the label wins
    for a, b in reversed(d.regex):
        pat = "\\b(?:" + a + ")\\b"
        rewritten = F.regexp_replace(c, "(?s)^(.*?)" + pat, "$1" + shift_groups(b, 1))
        out = F.when(c.rlike(pat) & (rewritten != c), rewritten).otherwise(out)
    return out


def abbreviate(c, d: AbbrevDict, rounds: int = 4) -> Column:
    """``rounds`` passes (the reference runs four).

    A pass names the label many times; bound to a variable, it is computed once
    per pass instead of being repeated inside the next one.
    """
    out = _c(c)
    for _ in range(rounds):
        out = F.get(F.transform(F.array(out), lambda label: abbreviate_once(label, d)), F.lit(0))
    return out


def sample_dictionary() -> AbbrevDict:
    return AbbrevDict.from_pairs(SAMPLE_ABBREV)


def abbreviate_join(df: DataFrame, col: str, dictionary: DataFrame, long_col: str = "txt_long",
                    short_col: str = "txt_court", rounds: int = 4) -> DataFrame:
    """T18 / J8 with a dictionary table of literal terms: ``col`` abbreviated in ``rounds`` passes.

    Every distinct label is split into its words and their places; a word
    meets the terms that begin with it (one row per first word), and a term
    hits where the label goes on with it and a word ends there.  Nothing of
    the dictionary is collected.  Terms begin and end with a letter, digit or
    underscore; of two shorts for one term the smaller is used.
    """
    lit = dictionary.select(F.col(long_col).alias("a"), F.col(short_col).alias("b")).dropna().filter("a <> ''")
    lit = lit.groupBy("a").agg(F.min("b").alias("b"))
    lit = lit.groupBy(F.regexp_extract("a", f"^{WORD}+", 0).alias("_w")).agg(
        F.collect_list(F.struct("a", "b")).alias("_terms"))
    labels = df.select(F.col(col).alias("_label")).dropna().distinct()
    now = labels.withColumn("_out", F.col("_label"))
    for _ in range(rounds):
        words = now.withColumn("_p", F.explode(_word_places(F.col("_out"))))
        words = words.select("_label", "_out", F.col("_p.at").alias("_i"), F.col("_p.s").alias("_w"))
        hits = words.join(lit, "_w").withColumn("_t", F.explode(F.filter(
            "_terms", lambda t: F.startswith(F.substr(F.col("_out"), F.col("_i")), t["a"]))))
        after = F.substr(F.col("_out"), F.col("_i") + F.length("_t.a"), F.lit(1))
        hits = hits.filter(~after.rlike(f"^{WORD}"))
        first = hits.groupBy("_label").agg(F.min_by(
            F.struct("_i", "_t"), F.struct(-F.length("_t.a"), F.col("_i"))).alias("_h"))
        now = now.join(first, "_label", "left").select("_label", F.when(
            F.col("_h").isNotNull(),
            F.concat(F.substr(F.col("_out"), F.lit(1), F.col("_h._i") - 1), F.col("_h._t.b"),
                     F.substr(F.col("_out"), F.col("_h._i") + F.length("_h._t.a")))).otherwise(F.col("_out")).alias("_out"))
    out = df.join(now, df[col] == now["_label"], "left")
    return out.withColumn(col, F.col("_out")).drop("_label", "_out")


def _word_places(c: Column) -> Column:
    """The words of a text (``s``) and where they begin, from 1 (``at``)."""
    parts = F.regexp_extract_all(c, F.lit(f"({WORD}+|[^{WORD[1:]}+)"))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at:int,s:string>>").alias("held"))
    placed = F.aggregate(parts, begin, lambda acc, p: F.struct(
        (acc["at"] + F.length(p)).alias("at"),
        F.concat(acc["held"], F.array(F.struct(acc["at"].alias("at"), p.alias("s")))).alias("held")))
    return F.filter(placed["held"], lambda e: e["s"].rlike(f"^{WORD}"))
