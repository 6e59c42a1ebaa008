"""Preparation of municipalities, streets, display names and history redirects through the library, on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlfrag as S
from ..catalog import query
from ..functions import recode as RC
from ..functions import text as T
from ..operators import relational as R
from ..session import read_table
from . import prepare as P

# ------------------------------------------------------------------ D1 D3-D7 D9
TYPES = [("AV", "AVENUE", "way"), ("LOT", "LOTISSEMENT", "area"), ("RUE", "RUE", "way"), ("BD", "BOULEVARD", "way")]
_TYPES_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{k}')" for a, b, k in TYPES) + ") AS ty(s, l, kind)"
_LEAD = ["AV ", "AVENUE ", "LOTISSEMENT ", "D 12 ", "", "RUE ", "BD "]
_LEAD_SQL = "CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_LEAD)) + " END"
_NATURE_SQL = "CASE p_partkey % 3 WHEN 0 THEN 'AV' WHEN 1 THEN 'LOTISSEMENT' ELSE 'RUE' END"


def _one_of(index, values):
    out = F.when(F.lit(False), F.lit(None))
    for i, v in enumerate(values):
        out = out.when(index == i, F.lit(v))
    return out


@query("prepare_streets", f"""
WITH p AS (
  SELECT p_partkey AS k, {_LEAD_SQL} || upper(p_name) AS label, {_NATURE_SQL} AS nature, p_size,
         CASE WHEN p_partkey % 11 = 0 THEN '2015001' ELSE ' ' END AS annul,
         right('0000' || CAST(p_partkey % 97000 AS VARCHAR), 5) || '_' || right('000' || CAST(p_partkey AS VARCHAR), 4) || 'K' AS fantoir FROM part),
ok AS (SELECT * FROM p WHERE annul = ' '),
x AS (
  SELECT *, EXISTS (SELECT 1 FROM {_TYPES_SQL} WHERE (nature = s OR nature = l) AND (label LIKE s || ' %' OR label LIKE l || ' %')) AS again,
         (SELECT max(kind) FROM {_TYPES_SQL} WHERE label LIKE s || ' %') AS ks, (SELECT max(kind) FROM {_TYPES_SQL} WHERE label LIKE l || ' %') AS kl
  FROM ok)
SELECT k, left(replace(fantoir, '_', ''), 9) AS fantoir_9, nature || ' ' || label AS nom_maj, CASE WHEN again THEN '' ELSE nature END AS nature,
  CASE WHEN regexp_matches(label, '^[ND] ?[0-9]+ ') THEN 'way' ELSE coalesce(ks, kl, 'area') END AS kind_short,
  CASE WHEN regexp_matches(label, '^[ND] ?[0-9]+ ') THEN 'way' ELSE coalesce(kl, ks, 'area') END AS kind_long,
  CASE WHEN k % 2 = 0 THEN left(fantoir, 5) || right('000' || CAST(k AS VARCHAR), 4) ELSE fantoir END AS full_id,
  CASE WHEN k % 5 = 0 THEN 'EN ' || label WHEN k % 5 = 1 THEN 'SENTE ' || label WHEN k % 5 = 2 THEN 'ENCEINTE ' || label ELSE label END AS corrected,
  trim(CASE k % 3 WHEN 0 THEN 'L''' WHEN 1 THEN 'Le ' ELSE '' END || label) AS town
FROM x
""")
def prepare_streets(spark, sf):
    """Names, repeated types, kinds, ids and AFNOR corrections of streets (from ``part``)."""
    types = spark.createDataFrame(TYPES, "nom_court string, nom_long string, kind string")
    k = F.col("p_partkey")
    p = read_table(spark, sf, "part").select(
        k.alias("k"), F.concat(_one_of(k % 7, _LEAD), F.upper("p_name")).alias("libelle_voie"),
        F.when(k % 3 == 0, "AV").when(k % 3 == 1, "LOTISSEMENT").otherwise("RUE").alias("nature_voie"),
        F.when(k % 11 == 0, "2015001").otherwise(" ").alias("caractere_annul"),
        F.concat(F.right(F.concat(F.lit("0000"), (k % 97000).cast("string")), F.lit(5)), F.lit("_"),
                 F.right(F.concat(F.lit("000"), k.cast("string")), F.lit(4)), F.lit("K")).alias("fantoir"))
    f = P.prepare_fantoir(p).withColumns({"nature": F.col("nature_voie"), "label": F.col("libelle_voie")})
    f = P.drop_repeated_type(f, "nature", "label", types)
    for prefer in ("short", "long"):
        f = P.street_kind(f, "label", types, prefer).withColumnRenamed("kind", f"kind_{prefer}")
    even, five = F.col("k") % 2 == 0, F.col("k") % 5
    code = F.when(even, F.right(F.concat(F.lit("000"), F.col("k").cast("string")), F.lit(4))).otherwise(F.col("fantoir"))
    name = F.concat(F.when(five.isin(0, 2), "ENCEINTE ").when(five == 1, "SENTIER ").otherwise(""), F.col("label"))
    afnor = F.concat(F.when(five == 0, "EN ").when(five == 1, "SENTE ").otherwise("X "), F.col("label"))
    f = f.withColumns({"full_id": RC.complete_id(code, F.left("fantoir", F.lit(5))), "corrected": RC.afnor_fix(name, afnor),
                       "ARTMIN": F.when(F.col("k") % 3 == 0, "(L')").when(F.col("k") % 3 == 1, "(Le)").otherwise(""), "NCCENR": F.col("label")})
    return f.select("k", "fantoir_9", "nom_maj", "nature", "kind_short", "kind_long", "full_id", "corrected",
                    P.municipality_name().alias("town"))


# ------------------------------------------------------------------ D2 D10 J13 J16
_MERGERS = [(str(25 + i), str(i), f"2016-01-0{1 + i % 9}") for i in range(25)] + [(str(25 + i), str((i + 1) % 25), "2017-01-01") for i in range(0, 25, 5)]
_MERGER_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{d}')" for a, b, d in _MERGERS) + ") AS f(insee_old, insee_new, date)"


@query("history_redirects", f"""
WITH fu AS (SELECT insee_old, max_by(insee_new, (date, insee_new::INT)) AS insee_new FROM {_MERGER_SQL} GROUP BY insee_old),
cp AS (SELECT c_custkey, CAST(c_nationkey + c_custkey % 3 * 25 AS VARCHAR) AS code, c_name AS l6,
         CASE WHEN c_custkey % 4 = 0 THEN 'LIEU' WHEN c_custkey % 4 = 1 THEN '' END AS l5 FROM customer),
d2 AS (SELECT cp.*, fu.insee_new IS NOT NULL AND code NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AS moved, fu.insee_new
       FROM cp LEFT JOIN fu ON fu.insee_old = cp.code),
e AS (SELECT event_id AS k, 'M' || CAST(user_id % 40 AS VARCHAR) AS insee, CAST(event_id % 500 AS VARCHAR) AS day, event_type,
        event_id % 3 = 0 AS gone FROM events)
SELECT 'D2' AS part, CAST(c_custkey AS VARCHAR) AS a, CASE WHEN moved THEN insee_new ELSE code END AS b,
       CASE WHEN moved AND coalesce(l5, '') = '' THEN l6 ELSE l5 END AS c FROM d2
UNION ALL SELECT 'J13', o.insee || 'S' || CAST(o.k AS VARCHAR), n.insee || 'S' || CAST(n.k AS VARCHAR), NULL
FROM e o JOIN e n ON o.insee = n.insee AND o.day = n.day AND o.gone AND NOT n.gone
WHERE o.event_type <> 'error' AND contains('RUE ' || n.event_type, o.event_type)
UNION ALL SELECT DISTINCT 'D10', CAST(10000 + c_custkey AS VARCHAR), CAST(10000 + c_custkey // 2 AS VARCHAR), NULL FROM customer
WHERE c_custkey // 2 <> c_custkey
UNION ALL SELECT 'J16', CAST(c_custkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), NULL
FROM customer JOIN nation ON c_nationkey IN (n_nationkey, n_nationkey + 2, n_nationkey * 2)
""")
def history_redirects(spark, sf):
    """D2 with the old name moved to line 5, J13/D10 successors of streets and municipalities, J16 array membership."""
    c, n, e = (read_table(spark, sf, t) for t in ("customer", "nation", "events"))
    k = F.col("c_custkey")
    cp = c.select(k, (F.col("c_nationkey") + k % 3 * 25).cast("string").alias("code"), F.col("c_name").alias("lb_l6"),
                  F.when(k % 4 == 0, "LIEU").when(k % 4 == 1, "").alias("lb_l5_nn"))
    fusion = spark.createDataFrame(_MERGERS, "insee_old string, insee_new string, date string")
    moved = P.redirect_insee(cp, "code", fusion, n.select(F.col("n_nationkey").cast("string").alias("insee")), move={"lb_l5_nn": "lb_l6"})
    none = F.lit(None).cast("string")
    text = lambda *cols: [F.col(x).cast("string") if isinstance(x, str) else x for x in cols]
    i = F.col("event_id")
    gone, day = i % 3 == 0, (i % 500).cast("string")
    insee = F.concat(F.lit("M"), (F.col("user_id") % 40).cast("string"))
    streets = e.select(
        F.concat(insee, F.lit("_S"), i.cast("string")).alias("fantoir"), insee.alias("code_insee"),
        F.concat(F.lit("RUE "), F.col("event_type")).alias("libelle_voie"), F.when(gone, day).otherwise("0000000").alias("date_annul"),
        F.when(gone, F.lit("1900001")).otherwise(day).alias("date_creation"),
        F.when(F.col("event_type") == "error", "*").otherwise(F.col("event_type")).alias("dernier_mot"))
    history = c.select((10000 + k).cast("string").alias("insee_code"), F.concat(
        F.lit("fr:commune:"), (10000 + F.expr("c_custkey div 2")).cast("string"), F.lit("@2016")).alias("successors"))
    arrays = n.select("n_nationkey", F.array_distinct(F.array(
        "n_nationkey", F.col("n_nationkey") + 2, F.col("n_nationkey") * 2)).alias("near"))
    parts = [moved.select(F.lit("D2"), *text("c_custkey", "code", "lb_l5_nn")),
             P.street_redirects(streets).select(F.lit("J13"), *text("old", "new", none)),
             P.municipality_redirects(history).select(F.lit("D10"), *text("old", "new", none)),
             R.join_any(c, arrays, "c_nationkey", "near").select(F.lit("J16"), *text("c_custkey", "n_nationkey", none))]
    return R.append(*[p.toDF("part", "a", "b", "c") for p in parts])


# ------------------------------------------------------------------ T34 T35
RULES = [(1, "AV", ["AV", "AVENUE"], False, "Avenue"), (2, "GR", ["GDE RUE", "GRANDE RUE"], True, "Grande Rue"),
         (3, "GR", ["SCO", "SCOLAIRE"], True, "Groupe Scolaire"), (4, "LOT", ["LOT", "LOTISSEMENT"], False, "Lotissement"),
         (5, "CHE", ["CHE", "CHEMIN"], False, "Chemin")]
_HEADS = ["AV ", "AV AVENUE D ", "GR GDE RUE ", "GR SCOLAIRE ST ", "GR ", "LOT L ", "CHE CHEMINS ", "QU "]
_HEADS_SQL = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_HEADS)) + " END"


def _elide_sql(x: str) -> str:
    for a, b in (("L", "l"), ("D", "d"), ("QU", "qu")):
        x = f"regexp_replace({x}, '(^| ){a} ([AEIOUYH])', '\\1{b}''\\2', 'g')"
    return x


def _rules_sql(x: str) -> str:
    out = x
    for _, lead, repeats, required, shown in reversed(RULES):
        alternatives = "|".join(sorted(repeats, key=len, reverse=True))
        pat = S.q(f"^{lead} ({alternatives})( |$)")
        plain = f"{S.q(shown + ' ')} || substr({x}, {len(lead) + 2})"
        both = f"trim({S.q(shown + ' ')} || regexp_replace({x}, {pat}, ''))"
        out = f"CASE WHEN regexp_matches({x}, {pat}) THEN {both} " + (
            "" if required else f"WHEN {x} LIKE '{lead} %' THEN {plain} ") + f"ELSE {out} END"
    return f"regexp_replace({out}, '(^| )ST ', '\\1Saint-', 'g')"


@query("unabbreviate", f"""
WITH p AS (SELECT p_partkey, {_HEADS_SQL} || CASE WHEN p_partkey % 3 = 0 THEN 'ILE ' ELSE '' END || upper(p_name) AS label FROM part),
e AS (SELECT *, {_elide_sql('label')} AS n FROM p)
SELECT p_partkey, label, {_rules_sql('n')} AS display FROM e
""")
def unabbreviate(spark, sf):
    """Display names by an ordered rule table - elided articles, repeated types, rules that need a repeat."""
    k = F.col("p_partkey")
    p = read_table(spark, sf, "part").select(k, F.concat(
        _one_of(k % 8, _HEADS), F.when(k % 3 == 0, "ILE ").otherwise(""), F.upper("p_name")).alias("label"))
    rules = spark.createDataFrame(RULES, "rank int, lead string, repeats array<string>, required boolean, shown string")
    return P.unabbreviate(p, "label", rules)


DICT = [("ALLEE", "allée", "ALL", "way", 2), ("CHEMIN", "chemin", "CHE", "way", 2), ("COTE", "côte", "COT", "area", 0),
        ("GRANDE RUE", "grande rue", "GR", "way", 1)]
_FORMS = ["ALLEE ", "allee ", "ALL ", "COTE ", "cote ", "GRANDE RUE ", "", "CHE "]
_FORMS_SQL = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_FORMS)) + " END"


def _leads_sql(x: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {x} LIKE '{a} %' THEN '{b} ' || substr({x}, {len(a) + 2})" for a, b in pairs) + " END"


@query("restore_type", f"""
WITH p AS (SELECT p_partkey, {_FORMS_SQL} || CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) || ' XIV' END AS label FROM part),
a AS (SELECT *, coalesce({_leads_sql('label', [('allee', 'allée'), ('cote', 'côte'), ('chemin', 'chemin'), ('grande rue', 'grande rue')])}, label) AS accented FROM p),
u AS (SELECT *, {S.unaccent_upper('accented')} AS up FROM a),
n AS (SELECT *, coalesce({_leads_sql('up', [(d[0], d[2]) for d in DICT])}, up) AS normalised FROM u),
f AS (SELECT *, CASE WHEN split_part(normalised, ' ', 1) IN ('ALL', 'CHE', 'GR') THEN 'way' ELSE 'area' END AS kind,
        CASE WHEN regexp_matches(accented, '[a-z]') THEN accented
             ELSE coalesce({_leads_sql('normalised', [(d[2], d[1]) for d in DICT if d[4] == 2])}, accented) END AS shown FROM n),
w AS (SELECT *, list_transform(string_split(lower(shown), ' '), lambda x: upper(left(x, 1)) || substr(x, 2)) AS ws FROM f)
SELECT p_partkey, label, accented, normalised, kind,
       array_to_string(list_transform(ws, lambda x: CASE WHEN x = 'Xiv' THEN 'XIV' ELSE x END), ' ') AS display FROM w
""")
def restore_type(spark, sf):
    """Accents of the leading type, normalised name, kind and display name by the 2017 dictionary."""
    k = F.col("p_partkey")
    p = read_table(spark, sf, "part").select(k, F.concat(_one_of(k % 8, _FORMS), F.when(k % 2 == 0, F.col("p_name")).otherwise(
        F.concat(F.upper("p_name"), F.lit(" XIV")))).alias("label"))
    types = spark.createDataFrame(DICT, "nom_maj string, nom_min string, nom_abbr string, kind string, priorite int")
    return P.restore_type(p, "label", types).select("p_partkey", "label", "accented", "normalised", "kind", "display")
