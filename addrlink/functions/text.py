"""Scalar text expressions as Spark Columns.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python UDF is used.

Regex dialect notes:
* the reference's ``regexp_replace`` without the ``g`` flag replaces the first
  match only; Spark replaces all.  ``replace_first`` rewrites a pattern into a
  prefix-capturing one so only the first match is touched.
* alternations are written longest-first because Java takes the first
  alternative that lets the match succeed.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# --------------------------------------------------------------------------
# Accented letters folded to their base letter (unaccent), same order on both
# lines; ligatures are expanded before folding.
ACCENTED = "ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖØòóôõöøÙÚÛÜùúûüÝýÿ"
PLAIN = "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOOooooooUUUUuuuuYyy"
LIGATURES = [("Œ", "OE"), ("œ", "oe"), ("Æ", "AE"), ("æ", "ae"), ("ß", "ss")]

# French articles removed from short labels (fixed values).
ARTICLES = ["LE", "LA", "LES", "L", "D", "DE", "DES", "DU", "A", "AU", "AUX", "ET"]

# Digit zero typed instead of letter O (fixed values, applied in this order).
ZERO_FOR_O = [("0S", "OS"), ("0N", "ON"), ("0U", "OU"), ("0I", "OI"), ("0R", "OR"),
              ("C0", "CO"), ("N0", "NO"), ("L0", "L ")]

# Months shortened in labels (fixed values, applied in this order).
MONTHS = ["JANVIER", "JANV", "FEVRIER", "FEVR", "MARS", "AVRIL", "MAI", "JUIN", "JUILLET",
          "JUIL", "AOUT", "SEPTEMBRE", "SEPT", "OCTOBRE", "OCT", "NOVEMBRE", "NOV",
          "DECEMBRE", "DEC"]
MONTH_SHORT = [("JANVIER", "JANV"), ("FEVRIER", "FEVR"), ("JUILLET", "JUIL"),
               ("SEPTEMBRE", "SEPT"), ("OCTOBRE", "OCT"), ("NOVEMBRE", "NOV"),
               ("NOVENBRE", "NOV"), ("DECEMBRE", "DEC")]

# Number words that take a plural S in labels (fixed values).
PLURAL_NUMBERS = ["UN", "QUATRE", "CINQ", "SEPT", "HUIT", "NEUF", "ONZE", "DOUZE", "TREIZE",
                  "QUATORZE", "QUINZE", "SEIZE", "VINGT", "TRENTE", "QUARANTE", "CINQUANTE",
                  "SOIXANTE", "CENT"]

# Roman numerals rewritten to digits, in the reference order (fixed values).
# (numeral, value, names that must precede it or None when it applies anywhere)
ROMAN_RULES = [
    ("I", 1, ["HENRI", "LOUIS", "NAPOLEON"]),
    ("II", 2, None), ("III", 3, None), ("IV", 4, None),
    ("V", 5, ["CHARLES", "LOUIS", "GEORGES", "GUSTAVE", "HENRI", "MOHAMMED"]),
    ("VI", 6, ["CHARLES", "GEORGES", "HENRI", "LOUIS"]),
    ("VII", 7, None), ("VIII", 8, None), ("IX", 9, None),
    ("X", 10, ["CHARLES", "LOUIS"]),
    ("XI", 11, None), ("XII", 12, None), ("XIII", 13, None), ("XIV", 14, None),
    ("XV", 15, None), ("XVI", 16, None), ("XVII", 17, None), ("XVIII", 18, None),
    ("XIX", 19, None), ("XX", 20, None), ("XXI", 21, None), ("XXII", 22, None),
    ("XXIII", 23, None),
]

# Spellings of "departmental" and of path / road words (fixed values).
DEPT_WORDS_PATH = ["DEP", "DEPT", "DEPTA", "DEPTAL", "DEPART", "DEPARTE", "DEPARTEM",
                   "DEPARTEME", "DEPARTEMEN", "DEPARTEMENT", "DEPARTEMENTA",
                   "DEPARTEMTAL", "DEPARTEMENTAL", "DEPARTEMENTALE", "DEPTARMENTAL",
                   "DEPARMENTAL", "DEPARTEMEMTAL", "DEPAETEMENTAL", "DEPARTEMTALE"]
DEPT_GUARD_PATH = ["DEP", "DEPT", "DEPART", "DEPARTEM", "DEPARTEMTAL", "DEPARTEMENTA",
                   "DEPARTEMENTAL", "DEPARTE", "DEPTARMENTAL"]
DEPT_WORDS_ROAD = ["DEP", "DEPT", "DEPTA", "DEPTAL", "DEPART", "DEPARTE", "DEPARTEM",
                   "DEPARTEME", "DEPARTEMEN", "DEPARTEMENT", "DEPARTEMENTA",
                   "DEPARTEMTAL", "DEPARTEMENTAL", "DEPARTMENTAL", "DEPARTEMENATALE",
                   "DEPARTENTALE", "DEPARTMEMENTALE", "DEPARTT", "DEPTARMENTAL",
                   "DEPARMENTAL", "DEPARTEMEMTAL", "DEPAETEMENTAL", "DEPARTEMANTAL",
                   "DEPATREMENTAL", "DEPARTEMETAL", "DEPATEMENTALE"]
PATH_WORDS = ["CH", "CHE", "CHEM", "CHEMIN"]
ROAD_WORDS = ["CD", "CHE", "RTE", "ROUTE", "ROUTES", "CHEMIN", "CHENIN", "VC", "VOIE", "RUE"]
NUMBER_WORDS_PATH = ["N", "NO", "NR", "NUM", "NUMER", "NUMERO", "N\\.", "N°"]
NUMBER_WORDS_ROAD = ["N", "NO", "NR", "NUM", "NUMER", "NUMERO", "N 0"]

# Old rural path families (fixed values).
OLD_PATH_WORDS = ["CH", "CHE", "CHEM", "CHEMIN", "C R", "CR", "C C", "CC", "CV", "C V",
                  "CVO", "C V O"]
OLD_PATH_KINDS = ["RURAL", "COMMUNAL", "VICINAL", "ORDINAIRE"]
DIT_PATH_HEADS = ["CC", "CE", "CH", "CHE", "CHEMD", "CHV", "CR"]
DIT_PATH_QUALS = ["CHE", "COM", "C R", "CR", "EXP", "EXPL", "EXPLOIT", "EXPLOITATION", "R",
                  "RUR", "RURAL"]
NUMBERED_PATH_HEADS = ["CH", "CE", "CC", "CHEM", "CHE", "CR", "CV", "CVO"]

# Words before HAMEAU that keep it (fixed values).
HAMLET_KEEP = ["LE", "DU", "D", "L", "AU", "JEAN", "GRAND", "PETIT", "VIEUX"]

# Scrap fixes on whole short labels (fixed values).
SCRAPS = [("GD RUE", "GR"), ("GDE GR", "GR"), ("GDE RUE", "GR"), ("GR GRD RUE", "GR"),
          ("ZA ZA", "ZA"), ("ZI ZI", "ZI")]

# First / second ordinal spellings (fixed values).
FIRST_SUFFIXES = ["E", "EM", "EME", "ER", "ERE", "ERS", "ERES"]
FIRST_WORDS = ["PREM", "PREMI", "PREMIER", "PREMIERS", "PREMIERE", "PREMIERES"]
SECOND_SUFFIXES = ["E", "EM", "EME", "ND", "NDE"]
SECOND_GUARD_SUFFIXES = ["E", "EM", "EME", "ND", "NDE", "NDS", "NDES"]
SECOND_WORDS = ["SECOND", "SECONDAI", "SECONDAIR", "SECONDAIRE", "SECONDE"]

# Words for generated ordinals 1..999 (fixed values).
ORD_HUNDREDS = ["", "CENT", "DEUX CENT", "TROIS CENT", "QUATRE CENT", "CINQ CENT",
                "SIX CENT", "SEPT CENT", "HUIT CENT", "NEUF CENT"]
ORD_TENS = ["", "DIX", "VINGT", "TRENTE", "QUARANTE", "CINQUANTE", "SOIXANTE",
            "SOIXANTE DIX", "QUATRE VINGT", "QUATRE VINGT DIX"]
ORD_UNITS = ["UNIEME", "DEUXIEME", "TROISIEME", "QUATRIEME", "CINQUIEME", "SIXIEME",
             "SEPTIEME", "HUITIEME", "NEUVIEME", "DIXIEME", "ONZIEME", "DOUZIEME",
             "TREIZIEME", "QUATORZIEME", "QUINZIEME", "SEIZIEME"]


def alt(words: Iterable[str], escape: bool = False) -> str:
    """Regex alternation, longest first (Java picks the first that fits)."""
    ws = sorted(set(words), key=lambda w: (-len(w), w))
    if escape:
        ws = [re.escape(w) for w in ws]
    return "|".join(ws)


def trie_alt(words: Iterable[str]) -> str:
    """Alternation factored as a prefix trie (same matches as ``alt``).

    At a given position the terms that can match form a chain of prefixes;
    greedy optional continuations try the longer ones first and backtrack to
    shorter ones, exactly like a longest-first alternation, but the engine
    follows one branch per character instead of testing every term.
    """
    trie: dict = {}
    for w in set(words):
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        ends = "" in node
        branches = [re.escape(ch) + emit(child) for ch, child in sorted(node.items()) if ch != ""]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        if ends:
            return "(?:" + body + ")?"
        return body
    return emit(trie)


# --------------------------------------------------------------------------
# Generic helpers
# --------------------------------------------------------------------------
def shift_groups(replacement: str, by: int = 1) -> str:
    """Renumber ``$n`` / ``\\n`` references in a replacement by ``by``."""
    return re.sub(r"[$\\](\d)", lambda m: "$" + str(int(m.group(1)) + by), replacement)


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace only the first match of ``pattern`` (first-only semantics ①).

    ``replacement`` uses ``$n`` (or ``\\n``) group references of ``pattern``.
    """
    return F.regexp_replace(_c(c), "(?s)^(.*?)" + pattern, "$1" + shift_groups(replacement))


def is_blank(c: ColumnOrName) -> Column:
    c = _c(c)
    return c.isNull() | (c == "")


def nullif_blank(c: ColumnOrName) -> Column:
    c = _c(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


# --------------------------------------------------------------------------
# upper/unaccent, punctuation, quotes
# --------------------------------------------------------------------------
def unaccent(c: ColumnOrName) -> Column:
    out = _c(c)
    for a, b in LIGATURES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, ACCENTED, PLAIN)


def unaccent_upper(c: ColumnOrName) -> Column:
    """``upper(unaccent(x))``."""
    return F.upper(unaccent(c))


def squeeze_punct(c: ColumnOrName) -> Column:
    """Apostrophes, hyphens and space runs become one space (fixpoint)."""
    return F.regexp_replace(_c(c), "[' -]+", " ")


def nom_maj(c: ColumnOrName) -> Column:
    """Upper-case unaccented name with punctuation squeezed (the ``nom_maj`` column)."""
    return squeeze_punct(unaccent_upper(c))


def glue_apostrophe(c: ColumnOrName) -> Column:
    """An apostrophe followed by spaces/apostrophes becomes one apostrophe."""
    return F.regexp_replace(_c(c), "'[' ]*", "'")


def keep_alnum(c: ColumnOrName) -> Column:
    """Keep ``A-Z 0-9 space`` only, then squeeze spaces (global)."""
    return F.regexp_replace(F.regexp_replace(_c(c), "[^A-Z 0-9]", " "), " +", " ")


def drop_articles(c: ColumnOrName) -> Column:
    """Remove runs of articles after a space or at the start (global), trim."""
    pat = "(^| )((" + alt(ARTICLES) + ") )*"
    return F.trim(F.regexp_replace(_c(c), pat, " "))


def drop_place_prefix(c: ColumnOrName) -> Column:
    """Leading ``LIEU DIT`` / ``LD``."""
    return F.regexp_replace(_c(c), "^(LIEU DIT|LD) ", "")


def halve_repeat(c: ColumnOrName) -> Column:
    """``X X`` or ``X/X`` -> ``X`` (backreference)."""
    return F.regexp_replace(_c(c), "^(.*)[/ ]\\1$", "$1")


def zero_to_o(c: ColumnOrName) -> Column:
    """Digit zero typed for letter O, guarded by ``[^0-9 ]0[^0-9 ]``."""
    c = _c(c)
    fixed = c
    for a, b in ZERO_FOR_O:
        fixed = F.replace(fixed, F.lit(a), F.lit(b))
    return F.when(c.rlike("[^0-9 ][0][^0-9 ]"), fixed).otherwise(c)


def drop_star(c: ColumnOrName) -> Column:
    """T14."""
    c = _c(c)
    return F.when(c.contains("*"), F.trim(F.replace(c, F.lit("*"), F.lit("")))).otherwise(c)


def split_digits(c: ColumnOrName) -> Column:
    """A space between letter and digit, each direction first match only."""
    c1 = replace_first(c, "([^0-9 ])([0-9])", "$1 $2")
    return replace_first(c1, "([0-9])([^0-9 ])", "$1 $2")


def squeeze_spaces(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), " +", " ")


# --------------------------------------------------------------------------
# Roads, scraps, paths, hamlets, Breton CH
# --------------------------------------------------------------------------
def dept_road(c: ColumnOrName) -> Column:
    """Departmental path/road spellings -> ``CD`` (first match), guarded."""
    c = _c(c)
    num_p = "(" + alt(NUMBER_WORDS_PATH) + ")"
    pat1 = ("(^| )(CD |CHE |)?(" + alt(PATH_WORDS) + ")\\.? (" + alt(DEPT_WORDS_PATH) +
            ")($|\\.? (" + num_p + "([0-9 ]))?)")
    # group 8 is the character after the number word
    step1 = squeeze_spaces(F.replace(replace_first(c, pat1, "$1CD $8"),
                                     F.lit("CD CD"), F.lit("CD ")))
    guard1 = "(" + alt(PATH_WORDS) + ")\\.? (" + alt(DEPT_GUARD_PATH) + ")\\.?( N)?"
    c1 = F.when(c.rlike(guard1), step1).otherwise(c)

    num_r = "(" + alt(NUMBER_WORDS_ROAD) + ")"
    pat2 = ("(^| )(CD |RD |RTE |CHE )?(" + alt(ROAD_WORDS) + ")\\.? (" +
            alt(DEPT_WORDS_ROAD) + ")E?($|\\.? (" + num_r + "([0-9 ]))?)")
    step2 = squeeze_spaces(F.replace(replace_first(c1, pat2, "$1CD $8"),
                                     F.lit("CD CD"), F.lit("CD ")))
    return F.when(c1.rlike(pat2), step2).otherwise(c1)


def path_road(court: ColumnOrName, long: ColumnOrName) -> Column:
    """``CH CD``/``CH RD`` -> ``CD`` unless the long name reads ``DU .. A|AU``."""
    court, long = _c(court), _c(long)
    pat = "^(" + alt(PATH_WORDS) + ") (CD|RD) "
    return F.when(court.rlike(pat) & ~long.rlike("DU.* (A|AU) "),
                  F.regexp_replace(court, pat, "CD ")).otherwise(court)


def fix_scraps(c: ColumnOrName) -> Column:
    """Whole-label scrap fixes, then a leading ``R `` becomes ``RUE ``."""
    c = _c(c)
    out = c
    for a, b in SCRAPS:
        out = F.when(out == a, F.lit(b)).otherwise(out)
    return F.regexp_replace(out, "^R ", "RUE ")


def old_paths(c: ColumnOrName) -> Column:
    """old/rural path families -> ``ACH`` / ``CHE``; numbered ``.. NO 12 DIT ..``."""
    c = _c(c)
    p1 = ("^AN(C|) (" + alt(OLD_PATH_WORDS) + ")(" +
          "|".join(" " + k for k in OLD_PATH_KINDS) + "|)( DIT |) ")
    c = F.regexp_replace(c, p1, "ACH ")
    quals = "|".join(" " + q for q in sorted(DIT_PATH_QUALS, key=lambda w: (-len(w), w)))
    p2 = "^(" + alt(DIT_PATH_HEADS) + ")(" + quals + ")( NUMERO|) .* (DIT|DITE)( CHE|) "
    guard2 = "^(" + alt(DIT_PATH_HEADS) + ")(" + quals + ")( NUMERO|) .* (DIT|DITE) "
    c = F.when(c.rlike(guard2), F.regexp_replace(c, p2, "CHE ")).otherwise(c)
    c = replace_first(c, " (N|NO) [0-9]* (DIT|DITE) ", " ")
    p4 = "^(" + alt(NUMBERED_PATH_HEADS) + ") (NUMERO |)[0-9]+ DIT (CHE |)"
    return F.regexp_replace(c, p4, "CHE ")


def drop_hamlet(court: ColumnOrName, long: ColumnOrName) -> Column:
    """Trailing ``HAMEAU`` (with exceptions on the long name), leading ``HAM``."""
    court, long = _c(court), _c(long)
    keep = long.rlike("(^| )(" + alt(HAMLET_KEEP) + ") HAMEAU$")
    out = F.when(court.rlike(" HAMEAU$") & ~keep,
                 F.regexp_replace(court, " HAMEAU$", "")).otherwise(court)
    return F.regexp_replace(out, "^HAM ", "")


def breton_ch(c: ColumnOrName) -> Column:
    """``xC H`` -> ``xCH`` (global)."""
    return F.regexp_replace(_c(c), "([A-Z]C) H( |$)", "$1H$2")


# --------------------------------------------------------------------------
# Numerals, dates, ordinals, plurals
# --------------------------------------------------------------------------
def roman_to_arabic(c: ColumnOrName) -> Column:
    """Roman numerals -> digits, one first-only replace per rule, in order.

    A pattern is searched only where the literal text that it begins with occurs.
    """
    def rule(numeral: str, value: int, names: list[str] | None):
        heads = [f" {name} {numeral}" for name in names] if names else [f" {numeral}"]
        pattern = " (" + alt(names) + ") " + numeral + "( |$)" if names else " " + numeral + "( |$)"
        to = f" $1 {value}$2" if names else f" {value}$1"
        return lambda x: F.when(reduce(lambda a, b: a | b, [F.contains(x, F.lit(head)) for head in heads]),
                                replace_first(x, pattern, to)).otherwise(x)

    out = _c(c)
    for r in ROMAN_RULES:  # an array of one: the label is bound once a rule, not copied into each branch
        out = F.transform(F.array(out), rule(*r))[0]
    return out


def normalise_dates(c: ColumnOrName, strict_compat: bool = False) -> Column:
    """``1ER``/``PREMIER`` before a month -> ``1``; month names shortened.

    ``11 NOV 1918`` and ``8 MAI 1945`` tails are dropped as regexes (the
    reference passed them to a literal replace, so they never fired; set
    ``strict_compat`` to keep that behaviour).
    """
    out = replace_first(c, " (1 ER|1ER|PREMIER) (" + alt(MONTHS) + ")( |$)", " 1 $2$3")
    for a, b in MONTH_SHORT:
        out = F.replace(out, F.lit(" " + a), F.lit(" " + b))
    if not strict_compat:
        out = replace_first(out, " 11 NOV (1918|18( |$))", " 11 NOV$2")
        out = replace_first(out, " 8 MAI (1945|45( |$))", " 8 MAI$2")
    return out


def ordinal_1_2(c: ColumnOrName) -> Column:
    """First / second ordinal spellings -> ``1E`` / ``2E`` (first only)."""
    out = replace_first(c, " 1 (" + alt(FIRST_SUFFIXES) + ")( |$)", " 1E$2")
    out = replace_first(out, " (" + alt(FIRST_WORDS) + ")( |$)", " 1E$2")
    guard = " 2(( |)(" + alt(SECOND_GUARD_SUFFIXES) + "))( |$)"
    fixed = replace_first(out, " 2(( |)(" + alt(SECOND_SUFFIXES) + "))( |$)", " 2E$4")
    out = F.when(out.rlike(guard), fixed).otherwise(out)
    return replace_first(out, " (" + alt(SECOND_WORDS) + ")(S|)( |$)", " 2E$3")


def ordinal_words() -> list[tuple[int, str]]:
    """(value, words) for every generated ordinal, squeezed, 1..999.

    Built by rule from the hundreds x tens x units lists (1 600 combinations).
    """
    out = []
    for hi, h in enumerate(ORD_HUNDREDS):
        for ti, t in enumerate(ORD_TENS):
            for ui, u in enumerate(ORD_UNITS):
                words = " ".join(w for w in (h, t, u) if w)
                out.append((hi * 100 + ti * 10 + ui + 1, words))
    return out


def apply_ordinals(c: ColumnOrName) -> Column:
    """Spelled or numbered ordinals -> ``<n>E`` (one rewrite per label).

    One alternation of all spelled forms (longest first, so ``VINGT
    QUATRIEME`` beats ``QUATRIEME``) with the value looked up in a literal
    map; otherwise the numbered ``12 EME`` forms for values 1..1006.
    """
    by_words: dict[str, int] = {}
    for v, w in ordinal_words():
        by_words.setdefault(w, v)
    c = _c(c)
    spelled = " (" + trie_alt(by_words) + ")(E|ES|S|)( |$)"
    numeric = " (100[0-6]|[1-9][0-9]{0,2})( EME| EM|EME|EM)(E|ES|S|)( |$)"
    kv = []
    for w, v in sorted(by_words.items()):
        kv += [F.lit(w), F.lit(str(v))]
    hit = F.regexp_extract(c, spelled, 1)
    value = F.element_at(F.create_map(*kv), hit)
    spelled_out = F.regexp_replace(c, "(?s)^(.*?)" + spelled,
                                   F.concat(F.lit("$1 "), value, F.lit("E$4")))
    numeric_out = replace_first(c, numeric, " $1E$4")
    return F.when(hit != "", spelled_out).otherwise(numeric_out)


def singular_numbers(c: ColumnOrName) -> Column:
    """Plural number words -> singular (global)."""
    return F.regexp_replace(_c(c), " (" + alt(PLURAL_NUMBERS) + ")S( |$)", " $1$2")


def dedupe_words(c: ColumnOrName) -> Column:
    """T12 bis: a repeated word (2+ letters) after a space or at end, first only."""
    return replace_first(c, "( |$)([A-Z]{2,}) \\2( |$)", "$1$2$3")


# --------------------------------------------------------------------------
# Keys and pieces
# --------------------------------------------------------------------------
def split_number(c: ColumnOrName) -> tuple[Column, Column]:
    """T5: ``'12 BIS'`` -> (``'12'``, ``'BIS'``); no space -> (``x``, ``''``)."""
    c = _c(c)
    padded = F.concat(c, F.lit(" "))
    pos = F.instr(padded, " ")
    number = F.substring_index(padded, " ", 1)
    ordinal = F.upper(F.trim(F.substr(padded, pos + 1)))
    return number, ordinal


def pad8(c: ColumnOrName) -> Column:
    """``right('0000000' || x, 8)``."""
    return F.right(F.concat(F.lit("0000000"), _c(c)), F.lit(8))


def cia(insee_or_fantoir: ColumnOrName, number: ColumnOrName, ordinal: ColumnOrName,
        fantoir4: ColumnOrName | None = None) -> Column:
    """``INSEE_FANTOIR4_NUMBER_ORDINAL`` upper-cased; NULL parts print empty.

    With one id argument it is the 9/10-char street id (insee = first 5,
    street = last 4 characters).
    """
    a = _c(insee_or_fantoir)
    if fantoir4 is None:
        insee, street = F.left(a, F.lit(5)), F.right(a, F.lit(4))
    else:
        insee, street = a, _c(fantoir4)
    parts = [F.coalesce(x, F.lit("")) for x in (insee, street, _c(number), _c(ordinal))]
    return F.upper(F.concat_ws("_", *parts))


def source_list(*flags: tuple[Column, str]) -> Column:
    """``DGFIP|IGN|LAPOSTE`` from (condition, name) pairs; NULL parts skipped."""
    return F.concat_ws("|", *[F.when(cond, F.lit(name)) for cond, name in flags])


def last_word(c: ColumnOrName) -> Column:
    """``regexp_replace(c, '^.* ', '')``."""
    return F.regexp_replace(_c(c), "^.* ", "")


def paren_name(c: ColumnOrName) -> Column:
    """Name inside parentheses (``X (Y)`` -> ``Y``), first match."""
    return replace_first(c, "([A-Z ]*) \\(([A-Z 1-9]*)\\)", "$2")


def without_paren(c: ColumnOrName) -> Column:
    """Name without the parenthesised part (``X (Y)`` -> ``X``), first match."""
    return replace_first(c, "([A-Z ]*) \\(([A-Z 1-9]*)\\)", "$1")


def strip_zeros(c: ColumnOrName) -> Column:
    """T39."""
    return F.regexp_replace(_c(c), "^0*", "")


def split_type(c: ColumnOrName, types: Iterable[str] = ("RUE", "CHEMIN", "ROUTE")
               ) -> tuple[Column, Column]:
    """Split a label into (type, rest) for a few frequent leading types."""
    c = _c(c)
    kind = F.lit(None).cast("string")
    rest = c
    for t in types:
        hit = c.startswith(t + " ")
        kind = F.when(hit, F.lit(t)).otherwise(kind)
        rest = F.when(hit, F.substr(c, F.lit(len(t) + 2))).otherwise(rest)
    return kind, rest


def title_case(c: ColumnOrName) -> Column:
    """Capitalise after any non-alphanumeric character (PG ``initcap``)."""
    c = F.lower(_c(c))
    # split keeping separators: words are alnum runs, separators the rest
    parts = F.regexp_extract_all(c, F.lit("([a-z0-9à-ÿ]+|[^a-z0-9à-ÿ]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substr(p, F.lit(1), F.lit(1))),
                                                              F.substr(p, F.lit(2)))), "")


ROMAN_WORD = "^(?i)(x{0,3})(ix|iv|v?i{0,3})$"


def upper_romans(c: ColumnOrName) -> Column:
    """Words that are roman numerals (I..XXXIX) written back in capitals."""
    words = F.split(_c(c), " ")
    return F.array_join(F.transform(words, lambda w: F.when((w != "") & w.rlike(ROMAN_WORD),
                                                            F.upper(w)).otherwise(w)), " ")


# --------------------------------------------------------------------------
# Similarity measures
# --------------------------------------------------------------------------
def trigrams(c: ColumnOrName) -> Column:
    """T31 helper: set of padded trigrams of the lower-cased alphanumeric words."""
    words = F.filter(F.split(F.lower(_c(c)), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_codes(c: ColumnOrName) -> Column:
    """T31 helper: the same trigram set as ``trigrams`` encoded as integers.

    Words hold only ``[a-z0-9]`` and padding spaces, so a trigram is three bytes,
    and CRC-32 tells all messages of three bytes apart; set sizes, intersections and
    therefore distances are identical, while hashing and shuffling ints is
    much cheaper than 3-character strings.  A word counts once, however often it stands.
    """
    words = F.filter(F.array_distinct(F.split(F.lower(_c(c)), "[^a-z0-9]+")), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - 2), lambda i: (F.crc32(F.substr(p, i, F.lit(3))) - F.lit(1 << 31)).cast("int")))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity_arrays(a: ColumnOrName, b: ColumnOrName) -> Column:
    """|a ∩ b| / |a ∪ b| as float32 (0 when both are empty)."""
    a, b = _c(a), _c(b)
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter  # both are sets
    return F.when(union == 0, F.lit(0.0).cast("float")).otherwise(
        (inter.cast("double") / union).cast("float"))


def trigram_distance_arrays(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``1 - similarity`` in float32 (the ``<->`` operator)."""
    return (F.lit(1.0).cast("float") - trigram_similarity_arrays(a, b)).cast("float")


def trigram_distance(a: ColumnOrName, b: ColumnOrName) -> Column:
    """T31 on two label columns."""
    return trigram_distance_arrays(trigrams(a), trigrams(b))


def edit_within(a: ColumnOrName, b: ColumnOrName, k: int) -> Column:
    """``levenshtein(a, b) < k`` with the threshold form (early exit)."""
    return F.levenshtein(_c(a), _c(b), k - 1) >= 0


# --------------------------------------------------------------------------
# Display names
# --------------------------------------------------------------------------
def first_rule(c: ColumnOrName, rules: list[tuple[str, str]]) -> Column:
    """The first rule whose anchored pattern matches rewrites the value.

    A rule is (regex, replacement); the test is anchored at the start, the
    replacement is global and unanchored, the result is stripped.
    """
    c = _c(c)
    out = None
    for pat, rep in reversed(rules):
        applied = F.trim(F.regexp_replace(c, pat, rep))
        test = c.rlike("^(?:" + pat + ")")
        out = F.when(test, applied).otherwise(out if out is not None else c)
    return out if out is not None else c
