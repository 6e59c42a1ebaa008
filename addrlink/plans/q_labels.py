"""Label queries (T1-T30 on driver text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlfrag as S
from ..catalog import query
from ..functions import text as T
from ..functions.abbrev import abbreviate_join
from ..session import read_table
from .driver_map import light_court

_NOM = S.nom_maj("text")


# ------------------------------------------------------------------ label_clean
@query("label_clean", f"""
WITH d AS (SELECT {_NOM} AS long FROM documents),
c AS (SELECT long, CASE WHEN regexp_matches(long, '[^A-Z 0-9]') THEN {S.keep_alnum('long')} ELSE long END AS c0 FROM d),
s AS (SELECT long, trim(CASE WHEN contains(c0, '*') THEN trim(replace(c0, '*', '')) ELSE c0 END) AS court FROM c)
SELECT DISTINCT long, court FROM s WHERE long IS NOT NULL AND long <> ''
""")
def label_clean(spark, sf):
    """nom_maj, A-Z/0-9 cleaning, distinct labels."""
    d = read_table(spark, sf, "documents", spread=True).select(T.nom_maj("text").alias("long"))
    # distinct long names first: court is a function of long, so the label
    # chain runs once per distinct name and the shuffle carries one text
    d = d.filter(~T.is_blank("long")).distinct()
    c = F.col("long")
    c0 = F.when(c.rlike("[^A-Z 0-9]"), T.keep_alnum(c)).otherwise(c)
    out = d.withColumn("court", c0).withColumn("court", F.trim(T.drop_star("court")))
    return out.select("long", "court")


# ------------------------------------------------------------------ label_articles
@query("label_articles", f"""
SELECT doc_id,
  regexp_replace({S.drop_articles(S.keep_alnum(_NOM))}, '^(LIEU DIT|LD) ', '') AS court,
  regexp_replace({S.unaccent_upper('text')}, '''['' ]*', '''', 'g') AS glued
FROM documents
""")
def label_articles(spark, sf):
    """Articles removed, LIEU DIT dropped, apostrophes glued."""
    d = read_table(spark, sf, "documents", spread=True)
    court = T.drop_place_prefix(T.drop_articles(T.keep_alnum(T.nom_maj("text"))))
    glued = T.glue_apostrophe(T.unaccent_upper("text"))
    return d.select("doc_id", court.alias("court"), glued.alias("glued"))


# ------------------------------------------------------------------ label_first_only
def _first_only_sql(x: str) -> str:
    x = S.first(x, "([^0-9 ])([0-9])", "\\1 \\2")
    x = S.first(x, "([0-9])([^0-9 ])", "\\1 \\2")
    return x


@query("label_first_only", f"""
WITH c AS (SELECT doc_id, {S.light_court(_NOM)} AS c0 FROM documents)
SELECT doc_id, {_first_only_sql('c0')} AS digits,
  regexp_replace(c0, ' (N|NO) [0-9]* (DIT|DITE) ', ' ') AS numbered,
  regexp_replace(regexp_replace(c0, ' 1 ({T.alt(T.FIRST_SUFFIXES)})( |$)', ' 1E\\2'),
                 ' ({T.alt(T.FIRST_WORDS)})( |$)', ' 1E\\2') AS first_ord
FROM c
""")
def label_first_only(spark, sf):
    """T15 T20 T25 and ``replace_first``: first-match-only rewrites on whole texts."""
    d = read_table(spark, sf, "documents", spread=True)
    c0 = light_court(T.nom_maj("text"))
    b = d.select("doc_id", c0.alias("c0"))
    first_ord = T.replace_first(T.replace_first("c0", " 1 (" + T.alt(T.FIRST_SUFFIXES) + ")( |$)",
                                                " 1E$2"),
                                " (" + T.alt(T.FIRST_WORDS) + ")( |$)", " 1E$2")
    return b.select("doc_id", T.split_digits("c0").alias("digits"),
                    T.replace_first("c0", " (N|NO) [0-9]* (DIT|DITE) ", " ").alias("numbered"),
                    first_ord.alias("first_ord"))


# ------------------------------------------------------------------ label_repeat
@query("label_repeat", """
WITH p AS (SELECT p_partkey, upper(p_name) AS n, p_brand FROM part),
x AS (
  SELECT p_partkey, n || ' ' || n AS twice, n || ' ' || upper(p_brand) AS other,
         upper(regexp_replace(n, ' .*', '')) || 'S ' || n AS plural FROM p)
SELECT p_partkey,
  CASE WHEN length(twice) % 2 = 1 AND left(twice, (length(twice) - 1) // 2) = right(twice, (length(twice) - 1) // 2)
            AND substr(twice, (length(twice) + 1) // 2, 1) IN (' ', '/')
       THEN left(twice, (length(twice) - 1) // 2) ELSE twice END AS halved,
  CASE WHEN length(other) % 2 = 1 AND left(other, (length(other) - 1) // 2) = right(other, (length(other) - 1) // 2)
            AND substr(other, (length(other) + 1) // 2, 1) IN (' ', '/')
       THEN left(other, (length(other) - 1) // 2) ELSE other END AS kept,
  regexp_replace(' ' || plural, ' (""" + T.alt(T.PLURAL_NUMBERS) + """)S( |$)', ' \\1\\2', 'g') AS singular
FROM x
""")
def label_repeat(spark, sf):
    """Repeated label halved (backreference), plural number words."""
    p = read_table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("n"), "p_brand")
    x = p.select("p_partkey", F.concat_ws(" ", "n", "n").alias("twice"),
                 F.concat_ws(" ", "n", F.upper("p_brand")).alias("other"),
                 F.concat(F.regexp_replace("n", " .*", ""), F.lit("S "), F.col("n")).alias("plural"))
    return x.select("p_partkey", T.halve_repeat("twice").alias("halved"),
                    T.halve_repeat("other").alias("kept"),
                    T.singular_numbers(F.concat(F.lit(" "), F.col("plural"))).alias("singular"))


# ------------------------------------------------------------------ label_roman / dates / digits
def _roman_sql(x: str) -> str:
    for numeral, value, names in T.ROMAN_RULES:
        if names:
            x = S.first(x, " (" + T.alt(names) + ") " + numeral + "( |$)", f" \\1 {value}\\2")
        else:
            x = S.first(x, " " + numeral + "( |$)", f" {value}\\1")
    return x


_ROMAN_INPUT = ("(' ' || c0 || ' LOUIS XIV ' || CASE WHEN length(c0) % 3 = 0 THEN 'HENRI V' "
                "WHEN length(c0) % 3 = 1 THEN 'XX' ELSE 'X' END)")


@query("label_roman", f"""
WITH c AS (SELECT doc_id, {S.light_court(_NOM)} AS c0 FROM documents),
r AS (SELECT doc_id, {_ROMAN_INPUT} AS s FROM c)
SELECT doc_id, {_roman_sql('s')} AS court FROM r
""")
def label_roman(spark, sf):
    """Roman numerals to digits, in rule order, first match each."""
    d = read_table(spark, sf, "documents", spread=True).select("doc_id", light_court(T.nom_maj("text")).alias("c0"))
    c0 = F.col("c0")
    tail = (F.when(F.length(c0) % 3 == 0, F.lit("HENRI V"))
            .when(F.length(c0) % 3 == 1, F.lit("XX")).otherwise(F.lit("X")))
    s = F.concat(F.lit(" "), c0, F.lit(" LOUIS XIV "), tail)
    return d.select("doc_id", T.roman_to_arabic(s).alias("court"))


def _dates_sql(x: str) -> str:
    x = S.first(x, " (1 ER|1ER|PREMIER) (" + T.alt(T.MONTHS) + ")( |$)", " 1 \\2\\3")
    for a, b in T.MONTH_SHORT:
        x = f"replace({x}, ' {a}', ' {b}')"
    x = S.first(x, " 11 NOV (1918|18( |$))", " 11 NOV\\2")
    x = S.first(x, " 8 MAI (1945|45( |$))", " 8 MAI\\2")
    return x


_DATE_INPUT = ("(' RUE ' || CASE WHEN o_orderkey % 4 = 0 THEN 'PREMIER' WHEN o_orderkey % 4 = 1 THEN '1ER' "
               "WHEN o_orderkey % 4 = 2 THEN '11' ELSE '8' END || ' ' || "
               "upper(monthname(o_orderdate)) || ' ' || CAST(year(o_orderdate) AS VARCHAR))")


def _month_fr(col):
    names = ["JANVIER", "FEVRIER", "MARS", "AVRIL", "MAI", "JUIN", "JUILLET", "AOUT",
             "SEPTEMBRE", "OCTOBRE", "NOVEMBRE", "DECEMBRE"]
    m = F.month(col)
    out = F.lit(None)
    for i, n in enumerate(names, start=1):
        out = F.when(m == i, F.lit(n)).otherwise(out)
    return out


_MONTH_FR_SQL = ("CASE month(o_orderdate) " + " ".join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate(
        ["JANVIER", "FEVRIER", "MARS", "AVRIL", "MAI", "JUIN", "JUILLET", "AOUT",
         "SEPTEMBRE", "OCTOBRE", "NOVEMBRE", "DECEMBRE"], start=1)) + " END")

_DATE_INPUT = _DATE_INPUT.replace("upper(monthname(o_orderdate))", _MONTH_FR_SQL)


@query("label_dates", f"""
WITH r AS (SELECT o_orderkey, {_DATE_INPUT} AS s FROM orders)
SELECT o_orderkey, {_dates_sql('s')} AS court FROM r
""")
def label_dates(spark, sf):
    """Day-of-month and month names in dates (whole ``orders`` table)."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    day = (F.when(k == 0, F.lit("PREMIER")).when(k == 1, F.lit("1ER"))
           .when(k == 2, F.lit("11")).otherwise(F.lit("8")))
    s = F.concat(F.lit(" RUE "), day, F.lit(" "), _month_fr(F.col("o_orderdate")), F.lit(" "),
                 F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", T.normalise_dates(s).alias("court"))


def _digits_sql(x: str, long: str) -> str:
    z = x
    for a, b in T.ZERO_FOR_O:
        z = f"replace({z}, '{a}', '{b}')"
    x = f"CASE WHEN regexp_matches({x}, '[^0-9 ][0][^0-9 ]') THEN {z} ELSE {x} END"
    x = f"CASE WHEN regexp_matches({x}, '([A-Z]C) H( |$)') THEN {S.glob(x, '([A-Z]C) H( |$)', chr(92) + '1H' + chr(92) + '2')} ELSE {x} END"
    keep = "(^| )(" + T.alt(T.HAMLET_KEEP) + ") HAMEAU$"
    x = (f"CASE WHEN regexp_matches({x}, ' HAMEAU$') AND NOT regexp_matches({long}, '{keep}') "
         f"THEN regexp_replace({x}, ' HAMEAU$', '') ELSE {x} END")
    x = f"regexp_replace({x}, '^HAM ', '')"
    return x


_DIGIT_INPUT = ("(CASE WHEN doc_id % 3 = 0 THEN 'C0' || c0 || ' KERC H' WHEN doc_id % 3 = 1 "
                "THEN c0 || ' HAMEAU' ELSE 'HAM ' || c0 END)")


@query("label_digits", f"""
WITH c AS (SELECT doc_id, {S.light_court(_NOM)} AS c0 FROM documents),
r AS (SELECT doc_id, {_DIGIT_INPUT} AS s FROM c)
SELECT doc_id, {_digits_sql('s', 's')} AS court FROM r
""")
def label_digits(spark, sf):
    """0/O repair, HAMEAU rules, Breton CH on whole texts."""
    d = read_table(spark, sf, "documents", spread=True).select("doc_id", light_court(T.nom_maj("text")).alias("c0"))
    k = F.col("doc_id") % 3
    s = (F.when(k == 0, F.concat(F.lit("C0"), F.col("c0"), F.lit(" KERC H")))
         .when(k == 1, F.concat(F.col("c0"), F.lit(" HAMEAU")))
         .otherwise(F.concat(F.lit("HAM "), F.col("c0"))))
    d = d.withColumn("s", s)
    c = T.zero_to_o("s")
    c = F.when(c.rlike("([A-Z]C) H( |$)"), T.breton_ch(c)).otherwise(c)
    return d.select("doc_id", T.drop_hamlet(c, F.col("s")).alias("court"))


# ------------------------------------------------------------------ abbreviate
ABBREV_VALUES = [("SMALL", "SM"), ("LARGE", "LG"), ("MEDIUM", "MED"), ("WIDGET", "WDG"),
                 ("GIZMO", "GZ"), ("ANVIL", "ANV"), ("PLATE", "PL"), ("BLUE", "BL"),
                 ("RED", "RD"), ("OLD", "O"), ("RED RING", "RRG"), ("SM", "S"), ("WDG", "W")]


def _abbrev_sql(x: str) -> str:
    """One pass, written on its own: the longest term found anywhere, of equally long ones the leftmost."""
    out = x
    for n in sorted({len(a) for a, _ in ABBREV_VALUES}):
        terms = [(a, b) for a, b in ABBREV_VALUES if len(a) == n]
        pat = S.q("\\b(" + "|".join(a for a, _ in terms) + ")\\b")
        hit = f"regexp_extract({x}, {pat}, 1)"
        cases = " ".join(f"WHEN {S.q(a)} THEN regexp_replace({x}, {pat}, {S.q(b)})" for a, b in terms)
        out = f"CASE {hit} {cases} ELSE {out} END"
    return out


def _scraps_sql(x: str) -> str:
    for a, b in T.SCRAPS:
        x = f"CASE WHEN {x} = '{a}' THEN '{b}' ELSE {x} END"
    return f"regexp_replace({x}, '^R ', 'RUE ')"


@query("abbreviate", """
WITH p AS (SELECT p_partkey, upper(p_name) || ' ' || upper(p_name) AS a0 FROM part),
a1 AS (SELECT p_partkey, a0, """ + _abbrev_sql("a0") + """ AS a1 FROM p),
a2 AS (SELECT *, """ + _abbrev_sql("a1") + """ AS a2 FROM a1),
a3 AS (SELECT *, """ + _abbrev_sql("a2") + """ AS a3 FROM a2),
a4 AS (SELECT *, """ + _abbrev_sql("a3") + """ AS a4 FROM a3)
SELECT p_partkey, a1 AS pass1, a4 AS court,
  """ + _scraps_sql("CASE WHEN p_partkey % 7 = 0 THEN 'ZA ZA' WHEN p_partkey % 7 = 1 THEN 'R ' || a4 ELSE a4 END") + """ AS fixed
FROM a4
""")
def abbreviate(spark, sf):
    """Abbreviation by a dictionary table, four passes, one rule per pass."""
    dictionary = spark.createDataFrame(ABBREV_VALUES, "txt_long string, txt_court string")
    p = read_table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", F.upper("p_name"), F.upper("p_name")).alias("a1"))
    p = abbreviate_join(p, "a1", dictionary, rounds=1)
    p = abbreviate_join(p.withColumn("a4", F.col("a1")), "a4", dictionary, rounds=3)
    k = F.col("p_partkey") % 7
    pre = (F.when(k == 0, F.lit("ZA ZA")).when(k == 1, F.concat(F.lit("R "), F.col("a4")))
           .otherwise(F.col("a4")))
    return p.select("p_partkey", F.col("a1").alias("pass1"), F.col("a4").alias("court"),
                    T.fix_scraps(pre).alias("fixed"))


# ------------------------------------------------------------------ label_ordinals
def _ordinals_sql(x: str) -> str:
    by_words = {}
    for v, w in T.ordinal_words():
        by_words.setdefault(w, v)
    spelled = " (" + T.alt(by_words) + ")(E|ES|S|)( |$)"
    numeric = " (100[0-6]|[1-9][0-9]{0,2})( EME| EM|EME|EM)(E|ES|S|)( |$)"
    case = "CASE hit " + " ".join(f"WHEN '{w}' THEN '{v}'" for w, v in sorted(by_words.items())) + " END"
    return (f"(SELECT CASE WHEN hit <> '' THEN regexp_replace({x}, {S.q(spelled)}, ' ' || {case} || 'E\\3') "
            f"ELSE regexp_replace({x}, {S.q(numeric)}, ' \\1E\\4') END "
            f"FROM (SELECT regexp_extract({x}, {S.q(spelled)}, 1) AS hit))")


_ORD_INPUT = ("(' RUE ' || CASE o_orderkey % 5 WHEN 0 THEN 'VINGT QUATRIEME' WHEN 1 THEN "
              "CAST(o_orderkey % 1200 AS VARCHAR) || ' EME' WHEN 2 THEN 'CENT UNIEME' WHEN 3 THEN "
              "'QUATRE VINGT DIX NEUVIEMES' ELSE 'TROISIEME' END || ' ' || o_orderpriority)")


def _ord_input_spark():
    k = F.col("o_orderkey") % 5
    mid = (F.when(k == 0, F.lit("VINGT QUATRIEME"))
           .when(k == 1, F.concat((F.col("o_orderkey") % 1200).cast("string"), F.lit(" EME")))
           .when(k == 2, F.lit("CENT UNIEME")).when(k == 3, F.lit("QUATRE VINGT DIX NEUVIEMES"))
           .otherwise(F.lit("TROISIEME")))
    return F.concat(F.lit(" RUE "), mid, F.lit(" "), F.col("o_orderpriority"))


@query("label_ordinals", f"""
WITH r AS (SELECT o_orderkey, {_ORD_INPUT} AS s FROM orders)
SELECT o_orderkey, {_ordinals_sql('s')} AS court FROM r
""")
def label_ordinals(spark, sf):
    """Generated ordinal table (1 600 rules) as one lookup."""
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", T.apply_ordinals(_ord_input_spark()).alias("court"))


# ------------------------------------------------------------------ label_dept_road
def _dept_sql(x: str, long: str) -> str:
    num_p = "(" + T.alt(T.NUMBER_WORDS_PATH) + ")"
    pat1 = ("(^| )(CD |CHE |)?(" + T.alt(T.PATH_WORDS) + ")\\.? (" + T.alt(T.DEPT_WORDS_PATH) +
            ")($|\\.? (" + num_p + "([0-9 ]))?)")
    guard1 = "(" + T.alt(T.PATH_WORDS) + ")\\.? (" + T.alt(T.DEPT_GUARD_PATH) + ")\\.?( N)?"
    step1 = f"regexp_replace(replace(regexp_replace({x}, {S.q(pat1)}, '\\1CD \\8'), 'CD CD', 'CD '), ' +', ' ', 'g')"
    c1 = f"(CASE WHEN regexp_matches({x}, {S.q(guard1)}) THEN {step1} ELSE {x} END)"
    num_r = "(" + T.alt(T.NUMBER_WORDS_ROAD) + ")"
    pat2 = ("(^| )(CD |RD |RTE |CHE )?(" + T.alt(T.ROAD_WORDS) + ")\\.? (" +
            T.alt(T.DEPT_WORDS_ROAD) + ")E?($|\\.? (" + num_r + "([0-9 ]))?)")
    step2 = f"regexp_replace(replace(regexp_replace({c1}, {S.q(pat2)}, '\\1CD \\8'), 'CD CD', 'CD '), ' +', ' ', 'g')"
    c2 = f"(CASE WHEN regexp_matches({c1}, {S.q(pat2)}) THEN {step2} ELSE {c1} END)"
    pat3 = "^(" + T.alt(T.PATH_WORDS) + ") (CD|RD) "
    return (f"CASE WHEN regexp_matches({c2}, {S.q(pat3)}) AND NOT regexp_matches({long}, 'DU.* (A|AU) ') "
            f"THEN regexp_replace({c2}, {S.q(pat3)}, 'CD ') ELSE {c2} END")


_ROAD_INPUT = ("(CASE o_orderkey % 6 WHEN 0 THEN 'CHEMIN DEPARTEMENTAL N 12 ' WHEN 1 THEN 'CD CHE DEPT ' "
               "WHEN 2 THEN 'ROUTE DEPARTEMENTALE ' WHEN 3 THEN 'CH CD ' WHEN 4 THEN 'RUE DEPT NO 4' "
               "ELSE 'VOIE ' END || upper(o_orderpriority) || ' ' || upper(o_orderstatus))")


def _road_input_spark():
    k = F.col("o_orderkey") % 6
    head = (F.when(k == 0, F.lit("CHEMIN DEPARTEMENTAL N 12 ")).when(k == 1, F.lit("CD CHE DEPT "))
            .when(k == 2, F.lit("ROUTE DEPARTEMENTALE ")).when(k == 3, F.lit("CH CD "))
            .when(k == 4, F.lit("RUE DEPT NO 4")).otherwise(F.lit("VOIE ")))
    return F.concat(head, F.upper("o_orderpriority"), F.lit(" "), F.upper("o_orderstatus"))


@query("label_dept_road", f"""
WITH r AS (SELECT o_orderkey, {_ROAD_INPUT} AS s FROM orders)
SELECT o_orderkey, {_dept_sql('s', 's')} AS court FROM r
""")
def label_dept_road(spark, sf):
    """Departmental road spellings -> CD; CH CD -> CD."""
    o = read_table(spark, sf, "orders").withColumn("s", _road_input_spark())
    return o.select("o_orderkey", T.path_road(T.dept_road("s"), F.col("s")).alias("court"))
