"""Relational, recode and display-name queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlfrag as S
from ..catalog import query
from ..functions import recode as RC
from ..functions import text as T
from ..operators import relational as R
from ..session import read_table


# ------------------------------------------------------------------ update_from
@query("update_from", """
WITH last AS (
  SELECT o_custkey, o_orderpriority FROM (
    SELECT o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)
SELECT c.c_custkey, c.c_name,
       CASE WHEN l.o_custkey IS NOT NULL THEN l.o_orderpriority ELSE c.c_mktsegment END AS c_mktsegment
FROM customer c LEFT JOIN last l ON c.c_custkey = l.o_custkey
""")
def update_from(spark, sf):
    """UPDATE customer SET segment = priority of the latest order (explicit winner)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"),
                                               "o_orderpriority", "o_orderdate", "o_orderkey")
    order = [-F.unix_micros(F.col("o_orderdate").cast("timestamp")), -F.col("o_orderkey")]
    return R.update_from(c, o, "c_custkey", {"c_mktsegment": "o_orderpriority"}, order=order)


# ------------------------------------------------------------------ unmatched / matched / append
@query("unmatched", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
""")
def unmatched(spark, sf):
    """Customers without any finished order (anti join, NULL keys dropped)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    o = read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return R.unmatched(c, o, "c_custkey", "o_custkey")


@query("matched", """
SELECT c_custkey, c_name, c_nationkey FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
""")
def matched(spark, sf):
    """Customers with at least one finished order (semi join, no duplication)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    o = read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return R.matched(c, o, "c_custkey", "o_custkey")


@query("append_missing", """
SELECT o_orderkey, o_custkey AS custkey, 'orders' AS source_init FROM orders
UNION ALL
SELECT NULL AS o_orderkey, c_custkey AS custkey, 'customer' AS source_init FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def append_missing(spark, sf):
    """O3 H3 H5 P10: append the rows of a second source that are not present yet."""
    o = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"),
                                               F.lit("orders").alias("source_init"))
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"),
                                                 F.lit("customer").alias("source_init"))
    missing = R.unmatched(c, o, "custkey")
    return R.append(o, missing).select("o_orderkey", "custkey", "source_init")


# ------------------------------------------------------------------ one_to_one / drop_ambiguous / multi_key
@query("one_to_one", """
SELECT user_id, event_type, CAST(ts AS DATE) AS d, max(event_id) AS event_id, max(value) AS value
FROM events GROUP BY user_id, event_type, CAST(ts AS DATE) HAVING count(*) = 1
""")
def one_to_one(spark, sf):
    """A4: groups with exactly one row, ``max()`` giving "the" value."""
    e = read_table(spark, sf, "events").withColumn("d", F.to_date("ts"))
    return R.one_to_one(e, ["user_id", "event_type", "d"],
                        {"event_id": F.max("event_id"), "value": F.max("value")})


@query("drop_ambiguous", """
SELECT doc_id, lang FROM documents
WHERE text NOT IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
""")
def drop_ambiguous(spark, sf):
    """Every document whose text occurs more than once is dropped (all copies)."""
    d = read_table(spark, sf, "documents").select("doc_id", "lang", F.xxhash64("text").alias("h"),
                                                  "text")
    # the duplicate check runs on the text itself; the hash only narrows the shuffle key
    return R.drop_ambiguous(d, ["h", "text"]).select("doc_id", "lang")


@query("multi_key", """
WITH f AS (
  SELECT user_id, event_type, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS rn FROM events),
m AS (SELECT user_id FROM events GROUP BY user_id, event_type HAVING count(*) > 1)
SELECT f.user_id, f.event_type, f.event_id,
       f.user_id IN (SELECT user_id FROM m) AS has_repeats
FROM f WHERE rn = 1
""")
def multi_key(spark, sf):
    """First row per key (``DISTINCT ON``) and keys with repeated rows."""
    e = read_table(spark, sf, "events").select("user_id", "event_type", "event_id")
    first = R.one_per_key(e, "user_id", [F.col("event_type"), F.col("event_id")])
    rep = R.multi_key_rows(e, ["user_id", "event_type"]).select("user_id").distinct()
    rep = rep.withColumn("has_repeats", F.lit(True))
    out = first.join(rep, "user_id", "left")
    return out.select("user_id", "event_type", "event_id",
                      F.coalesce("has_repeats", F.lit(False)).alias("has_repeats"))


# ------------------------------------------------------------------ leading_type
TYPE_DICT = [("SMALL", "S", "way"), ("LARGE", "L", "area"), ("RED", "R", "way"),
             ("SMALL RING", "SR", "area"), ("BLUE", "B", "way"), ("ECONOMY", "E", "area")]
_TYPE_VALUES = "(VALUES " + ", ".join(f"('{a}', '{b}', '{k}')" for a, b, k in TYPE_DICT) + ") AS t(nom_long, nom_court, kind)"


@query("leading_type", f"""
WITH p AS (
  SELECT p_partkey, upper(p_type) AS type_voie,
         CASE WHEN p_size % 10 = 0 THEN 'D ' || CAST(p_size AS VARCHAR) || ' ' || upper(p_name)
              ELSE upper(p_name) END AS label FROM part),
h AS (
  SELECT p.p_partkey, max_by(t.nom_long, length(t.nom_long)) AS term
  FROM p JOIN {_TYPE_VALUES} ON p.label LIKE t.nom_long || ' %' GROUP BY p.p_partkey)
SELECT p.p_partkey, p.label,
  CASE WHEN p.label LIKE p.type_voie || ' %' THEN '' ELSE p.type_voie END AS type_voie,
  h.term,
  CASE WHEN regexp_matches(p.label, '^[ND] ?[0-9]+ ') THEN 'way'
       ELSE coalesce((SELECT max(kind) FROM {_TYPE_VALUES} WHERE t.nom_long = h.term), 'area') END AS kind
FROM p LEFT JOIN h ON p.p_partkey = h.p_partkey
""")
def leading_type(spark, sf):
    """Longest leading dictionary term (equi-join on word prefixes),
    repeated type blanked, kind from the term with the road-number override."""
    p = read_table(spark, sf, "part")
    label = F.when(F.col("p_size") % 10 == 0,
                   F.concat(F.lit("D "), F.col("p_size").cast("string"), F.lit(" "), F.upper("p_name"))
                   ).otherwise(F.upper("p_name"))
    p = p.select("p_partkey", F.upper("p_type").alias("type_voie"), label.alias("label"))
    terms = spark.createDataFrame(TYPE_DICT, "nom_long string, nom_court string, kind string")
    hit = R.join_leading_term(p, "label", terms.select(F.col("nom_long").alias("term")), "term", how="left")
    hit = hit.join(F.broadcast(terms.select(F.col("nom_long").alias("term"), "kind")), "term", "left")
    kind = F.when(RC.road_number("label"), F.lit("way")).otherwise(F.coalesce("kind", F.lit("area")))
    typ = F.when(RC.starts_with_word("label", "type_voie"), F.lit("")).otherwise(F.col("type_voie"))
    return hit.select("p_partkey", "label", typ.alias("type_voie"), "term", kind.alias("kind"))


# ------------------------------------------------------------------ redirect
MERGERS = [(str(25 + i), str(i), f"2016-01-0{1 + i % 9}") for i in range(25)] + \
          [(str(25 + i), str((i + 1) % 25), "2017-01-01") for i in range(0, 25, 5)]
_MERGER_VALUES = "(VALUES " + ", ".join(f"('{a}', '{b}', '{d}')" for a, b, d in MERGERS) + ") AS f(insee_old, insee_new, date)"


@query("redirect", f"""
WITH c AS (SELECT c_custkey, CAST(c_nationkey + (c_custkey % 3) * 25 AS VARCHAR) AS code FROM customer),
cur AS (SELECT CAST(n_nationkey AS VARCHAR) AS code FROM nation),
fu AS (SELECT insee_old, max_by(insee_new, (date, insee_new)) AS insee_new FROM {_MERGER_VALUES} GROUP BY insee_old)
SELECT c.c_custkey, c.code,
  CASE WHEN c.code NOT IN (SELECT code FROM cur) AND fu.insee_old IS NOT NULL THEN fu.insee_new ELSE c.code END AS code_new
FROM c LEFT JOIN fu ON c.code = fu.insee_old
""")
def redirect(spark, sf):
    """Codes that are not current and were merged move to the new code
    (one hop; duplicated old codes resolved by latest date, then highest new code)."""
    c = read_table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_nationkey") + (F.col("c_custkey") % 3) * 25).cast("string").alias("code"))
    cur = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"))
    fus = spark.createDataFrame(MERGERS, "insee_old string, insee_new string, date string")
    fus = R.one_per_key(fus, "insee_old", [-F.unix_date(F.to_date("date")), -F.col("insee_new").cast("int")])
    stale = R.unmatched(c, cur, "code").select("code").distinct().withColumn("_stale", F.lit(True))
    out = c.join(stale, "code", "left").join(F.broadcast(fus.select(F.col("insee_old").alias("code"), "insee_new")),
                                             "code", "left")
    new = F.when(F.col("_stale") & F.col("insee_new").isNotNull(), F.col("insee_new")).otherwise(F.col("code"))
    return out.select("c_custkey", "code", new.alias("code_new"))


# ------------------------------------------------------------------ recode_kind
_ADDR_SQL = "CASE " + " ".join(f"WHEN src = '{a}' THEN '{b}'" for a, b in RC.ADDRESSING) + " ELSE '' END"


def _src_spark():
    k = F.col("user_id") % 6
    names = [a for a, _ in RC.ADDRESSING] + ["Autre"]
    out = F.lit(names[-1])
    for i, n in enumerate(names):
        out = F.when(k == i, F.lit(n)).otherwise(out)
    return out


_SRC_SQL = "CASE user_id % 6 " + " ".join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate([a for a, _ in RC.ADDRESSING] + ["Autre"])) + " END"
_LOC = ["A la plaque", "Projetée du centre parcelle", "A la zone d'adressage", "Interpolée", "Autre"]
_LOC_SQL = "CASE event_id % 5 " + " ".join(f"WHEN {i} THEN {S.q(n)}" for i, n in enumerate(_LOC)) + " END"


@query("recode_kind", f"""
WITH e AS (SELECT event_id, user_id, event_type, value, {_SRC_SQL} AS src, {_LOC_SQL} AS loc,
                  CAST(event_id % 7 AS VARCHAR) AS idx,
                  CASE WHEN user_id % 4 = 0 THEN '97123' WHEN user_id % 4 = 1 THEN '97127'
                       ELSE CAST(10000 + user_id AS VARCHAR) END AS insee FROM events)
SELECT event_id, {_ADDR_SQL} AS addressing,
  CASE WHEN idx = '5' THEN 'area' WHEN loc = 'A la plaque' THEN 'entrance'
       WHEN loc = 'Projetée du centre parcelle' THEN 'segment' WHEN loc LIKE 'A la zone%' THEN 'area'
       WHEN loc = 'Interpolée' THEN 'segment' ELSE 'unknown' END AS kind,
  CASE WHEN loc = 'Projetée du centre parcelle' THEN 'projection' WHEN loc = 'Interpolée' THEN 'interpolation'
       ELSE 'other' END AS positioning,
  CASE insee WHEN '97123' THEN '97701' WHEN '97127' THEN '97801' ELSE insee END AS insee,
  (upper(event_type) || ' X') LIKE upper(event_type) || ' %' AS starts_word,
  regexp_matches(event_type, '^' || substr(event_type, 1, 1) || '[a-z]+$') AS col_pattern,
  (event_type = 'click' OR event_type = 'view') AS is_any,
  CASE WHEN length(CAST(user_id AS VARCHAR)) <= 2 THEN '9' || right('000' || CAST(user_id AS VARCHAR), 4)
       ELSE CAST(user_id AS VARCHAR) END AS completed
FROM e
WHERE NOT (value > 90) OR value IS NULL
""")
def recode_kind(spark, sf):
    """CASE recodes, constant recodes, column-pattern LIKE/regex,
    multi-column IN and NULL-aware delete (``DELETE WHERE cond`` keeps NULL cond)."""
    e = read_table(spark, sf, "events")
    k = F.col("event_id") % 5
    loc = F.lit(_LOC[-1])
    for i, n in enumerate(_LOC):
        loc = F.when(k == i, F.lit(n)).otherwise(loc)
    u = F.col("user_id") % 4
    insee = (F.when(u == 0, F.lit("97123")).when(u == 1, F.lit("97127"))
             .otherwise((F.col("user_id") + 10000).cast("string")))
    e = e.select("event_id", "user_id", "event_type", "value", _src_spark().alias("src"),
                 loc.alias("loc"), (F.col("event_id") % 7).cast("string").alias("idx"),
                 insee.alias("insee"))
    e = e.filter(~(F.col("value") > 90) | F.col("value").isNull())
    uid = F.col("user_id").cast("string")
    completed = F.when(F.length(uid) <= 2, F.concat(F.lit("9"), F.right(F.concat(F.lit("000"), uid), F.lit(4)))
                       ).otherwise(uid)
    return e.select(
        "event_id", RC.addressing_code("src").alias("addressing"),
        RC.position_kind("idx", "loc").alias("kind"), RC.positioning("loc").alias("positioning"),
        RC.replace_values("insee", RC.INSEE_RECODE).alias("insee"),
        RC.starts_with_word(F.concat(F.upper("event_type"), F.lit(" X")), F.upper("event_type")).alias("starts_word"),
        F.regexp_like(F.col("event_type"), F.concat(F.lit("^"), F.substr("event_type", F.lit(1), F.lit(1)),
                                                     F.lit("[a-z]+$"))).alias("col_pattern"),
        RC.is_any("event_type", F.lit("click"), F.lit("view")).alias("is_any"),
        completed.alias("completed"))


# ------------------------------------------------------------------ split_number
@query("split_number", """
WITH o AS (
  SELECT o_orderkey, o_custkey,
         CAST(o_orderkey % 400 AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' ' || lower(substr(o_orderpriority, 3, 3)) END AS numero,
         CAST(o_custkey AS VARCHAR) AS street FROM orders),
s AS (
  SELECT *, split_part(numero || ' ', ' ', 1) AS number,
         upper(trim(substr(numero || ' ', strpos(numero || ' ', ' ') + 1))) AS ordinal FROM o)
SELECT o_orderkey, number, ordinal, right('0000000' || street, 8) AS street8,
  upper(concat_ws('_', left(right('0000000' || street, 8), 5), right(right('0000000' || street, 8), 4), number, ordinal)) AS cia,
  concat_ws('|', CASE WHEN o_orderkey % 2 = 0 THEN 'DGFIP' END, CASE WHEN o_custkey % 2 = 0 THEN 'IGN' END,
            CASE WHEN o_orderkey % 5 = 0 THEN 'LAPOSTE' END) AS source_init,
  regexp_replace('00' || number, '^0*', '') AS stripped,
  CASE WHEN numero LIKE '1%' THEN 'RUE' END AS type_voie
FROM s
""")
def split_number(spark, sf):
    """number/ordinal split, zero padding, cia key, source list."""
    o = read_table(spark, sf, "orders")
    num = F.concat((F.col("o_orderkey") % 400).cast("string"),
                   F.when(F.col("o_orderkey") % 3 == 0, F.lit(""))
                   .otherwise(F.concat(F.lit(" "), F.lower(F.substr("o_orderpriority", F.lit(3), F.lit(3))))))
    o = o.select("o_orderkey", "o_custkey", num.alias("numero"),
                 F.col("o_custkey").cast("string").alias("street"))
    number, ordinal = T.split_number("numero")
    street8 = T.pad8("street")
    src = T.source_list((F.col("o_orderkey") % 2 == 0, "DGFIP"), (F.col("o_custkey") % 2 == 0, "IGN"),
                        (F.col("o_orderkey") % 5 == 0, "LAPOSTE"))
    return o.select("o_orderkey", number.alias("number"), ordinal.alias("ordinal"),
                    street8.alias("street8"), T.cia(street8, number, ordinal).alias("cia"),
                    src.alias("source_init"),
                    T.strip_zeros(F.concat(F.lit("00"), number)).alias("stripped"),
                    F.when(F.col("numero").startswith("1"), F.lit("RUE")).alias("type_voie"))


# ------------------------------------------------------------------ last_word / paren_name
@query("last_word", f"""
WITH c AS (SELECT c_custkey, upper(c_name) || ' (' || c_mktsegment || ' ' || CAST(c_nationkey + 1 AS VARCHAR) || ')' AS nm,
                  'RUE ' || upper(c_mktsegment) || ' ' || replace(upper(c_name), '#', ' ') AS label FROM customer)
SELECT c_custkey, regexp_replace(label, '^.* ', '') AS last_word,
  regexp_replace(nm, '([A-Z ]*) \\(([A-Z 1-9]*)\\)', '\\2') AS paren_name,
  regexp_replace(nm, '([A-Z ]*) \\(([A-Z 1-9]*)\\)', '\\1') AS without_paren,
  regexp_extract(label, '[0-9]+$', 0) AS tail_digits
FROM c
""")
def last_word(spark, sf):
    """Last word, name in parentheses, name without them, regex extract."""
    c = read_table(spark, sf, "customer")
    nm = F.concat(F.upper("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(" "),
                  (F.col("c_nationkey") + 1).cast("string"), F.lit(")"))
    label = F.concat(F.lit("RUE "), F.upper("c_mktsegment"), F.lit(" "),
                     F.replace(F.upper("c_name"), F.lit("#"), F.lit(" ")))
    c = c.select("c_custkey", nm.alias("nm"), label.alias("label"))
    return c.select("c_custkey", T.last_word("label").alias("last_word"),
                    T.paren_name("nm").alias("paren_name"), T.without_paren("nm").alias("without_paren"),
                    F.regexp_extract("label", "[0-9]+$", 0).alias("tail_digits"))


# ------------------------------------------------------------------ display_name
@query("display_name", """
WITH p AS (
  SELECT p_partkey, p_name || ' ' || CASE p_partkey % 4 WHEN 0 THEN 'xiv' WHEN 1 THEN 'ii' WHEN 2 THEN 'vi-bis' ELSE 'l''église' END AS nm,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE upper(p_name) END AS postal,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE upper(p_brand) END AS ign,
         upper(p_type) AS tax FROM part)
SELECT p_partkey,
  array_to_string(list_transform(regexp_extract_all(lower(nm), '([a-z0-9à-ÿ]+|[^a-z0-9à-ÿ]+)', 1),
     lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '') AS title,
  coalesce(postal, ign, tax) AS name_fnal, coalesce(ign, tax) AS ign_or_tax
FROM p
""")
def display_name(spark, sf):
    """Title case (capital after any non-alphanumeric) and name priority."""
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    tail = (F.when(k == 0, F.lit("xiv")).when(k == 1, F.lit("ii")).when(k == 2, F.lit("vi-bis"))
            .otherwise(F.lit("l'église")))
    p = p.select("p_partkey", F.concat(F.col("p_name"), F.lit(" "), tail).alias("nm"),
                 F.when(F.col("p_partkey") % 3 == 0, F.lit(None)).otherwise(F.upper("p_name")).alias("postal"),
                 F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(F.upper("p_brand")).alias("ign"),
                 F.upper("p_type").alias("tax"))
    return p.select("p_partkey", T.title_case("nm").alias("title"),
                    F.coalesce("postal", "ign", "tax").alias("name_fnal"),
                    F.coalesce("ign", "tax").alias("ign_or_tax"))


# ------------------------------------------------------------------ linker_2016
@query("linker_2016", """
WITH a AS (SELECT p_partkey, p_brand, upper(p_name) AS nm FROM part WHERE p_partkey % 2 = 0),
b AS (SELECT p_partkey, p_brand, upper(p_name) AS nm FROM part WHERE p_partkey % 2 = 1),
j AS (SELECT a.p_partkey AS pa, b.p_partkey AS pb, a.p_brand FROM a JOIN b
      ON a.p_brand = b.p_brand AND regexp_replace(a.nm, '^.* ', '') = regexp_replace(b.nm, '^.* ', '')
      AND (a.nm = b.nm OR regexp_replace(a.nm, '^(RED|BLUE) ', '') = b.nm))
SELECT pa, max(pb) AS pb_max, string_agg(DISTINCT CAST(pb AS VARCHAR), ',' ORDER BY CAST(pb AS VARCHAR)) AS pb_list
FROM j GROUP BY pa
""")
def linker_2016(spark, sf):
    """Link by block + last word + (equal | prefix-stripped) name;
    keep the max id and the ordered distinct list of all ids."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand", F.upper("p_name").alias("nm"))
    a = p.filter(F.col("p_partkey") % 2 == 0)
    b = p.filter(F.col("p_partkey") % 2 == 1).select(F.col("p_partkey").alias("pb"), "p_brand",
                                                     F.col("nm").alias("nb"))
    # the two names of the left side are two rows of one equi-join on (brand, name)
    stripped = F.regexp_replace("nm", "^(RED|BLUE) ", "")
    a = a.select(F.col("p_partkey").alias("pa"), F.struct("p_brand", "nm").alias("k")).filter("k.p_brand is not null")
    # the ids of a name are listed once, not once for every left row that has the name
    ids = b.groupBy("p_brand", "nb").agg(F.collect_set(F.col("pb").cast("string")).alias("pbs"), F.max("pb").alias("top"))
    names = a.select("k").distinct().select("k", "k.*").select(
        "k", "p_brand", "nm", F.explode(F.array_distinct(F.array(F.col("nm"), stripped))).alias("nb"))
    names = names.filter(T.last_word(F.col("nm")) == T.last_word(F.col("nb"))).join(ids, ["p_brand", "nb"])
    names = names.select("k", "nb", "pbs", "top")
    # a left id stands for its names (one, unless rows repeat it); equal sets of names share one list
    own = a.groupBy("pa").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    lists = own.select("ks").distinct().select("ks", F.explode("ks").alias("k")).join(names, "k").groupBy("ks").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("pbs")))), ",").alias("pb_list"),
        F.max("top").alias("pb_max"))
    return own.join(lists, "ks").select("pa", "pb_max", "pb_list")


# ------------------------------------------------------------------ map_attrs
@query("map_attrs", """
WITH e AS (SELECT user_id, event_id, event_type,
                  CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events),
agg AS (SELECT user_id, list(event_type ORDER BY event_id) AS types, count(*) AS n FROM e GROUP BY user_id)
SELECT a.user_id, len(a.types) AS n_types, a.types[1] AS first_type,
       list_contains(a.types, 'click') AS has_click,
       (SELECT count(*) FROM e WHERE e.user_id = a.user_id AND e.k LIKE '1%') AS k1
FROM agg a
""")
def map_attrs(spark, sf):
    """JSON attributes as a map, ``element_at`` + LIKE, ordered
    ``collect_list``, ``size``/``element_at``/``array_contains``."""
    e = read_table(spark, sf, "events").select(
        "user_id", "event_id", "event_type",
        F.from_json("props", "map<string,string>").alias("attributes"))
    e = e.withColumn("k", F.element_at("attributes", F.lit("k")))
    agg = e.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("s"),
        F.count_if(F.col("k").like("1%")).alias("k1"))
    types = F.transform("s", lambda x: x["event_type"])
    return agg.select("user_id", F.size(types).alias("n_types"),
                      F.element_at(types, 1).alias("first_type"),
                      F.array_contains(types, "click").alias("has_click"), "k1")


# ------------------------------------------------------------------ successors
@query("successors", """
WITH e AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS d FROM events)
SELECT o.event_id AS old_id, n.event_id AS new_id, o.user_id
FROM e o JOIN e n ON o.user_id = n.user_id AND o.d = n.d
WHERE o.event_type = 'error' AND n.event_type <> 'error' AND contains(n.event_type, substr(o.event_type, 5, 1))
""")
def successors(spark, sf):
    """Self-join cancelled -> successor in the same block on the same
    date, successor still valid, label containing the old one's last letter."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "event_type",
                                               F.to_date("ts").alias("d"))
    o = e.filter(F.col("event_type") == "error").alias("o")
    n = e.filter(F.col("event_type") != "error").alias("n")
    j = o.join(n, (F.col("o.user_id") == F.col("n.user_id")) & (F.col("o.d") == F.col("n.d")))
    j = j.filter(F.col("n.event_type").contains(F.substr(F.col("o.event_type"), F.lit(5), F.lit(1))))
    return j.select(F.col("o.event_id").alias("old_id"), F.col("n.event_id").alias("new_id"),
                    F.col("o.user_id").alias("user_id"))


# ------------------------------------------------------------------ rename_rules
RENAME_RULES = [("EN ", "EN-"), ("THE [A-Z]+", "THE_X"), ("IN", "DANS"), ("[A-Z]+ AND", "ET"),
                ("ER", "ER")]


def _rename_sql(x: str) -> str:
    out = x
    for pat, rep in reversed(RENAME_RULES):
        out = (f"CASE WHEN regexp_matches({x}, {S.q('^(?:' + pat + ')')}) "
               f"THEN trim(regexp_replace({x}, {S.q(pat)}, {S.q(rep)}, 'g')) ELSE {out} END")
    return out


@query("rename_rules", f"""
WITH d AS (SELECT doc_id, {S.light_court(S.nom_maj('text'))} AS name FROM documents)
SELECT doc_id, {_rename_sql('name')} AS new_name,
  {_rename_sql('name')} <> name AS changed
FROM d
""")
def rename_rules(spark, sf):
    """First rule whose anchored pattern matches rewrites the name
    (global unanchored replacement, stripped); the patch batch is ``changed``."""
    from .driver_map import light_court
    d = read_table(spark, sf, "documents", spread=True).select(
        "doc_id", light_court(T.nom_maj("text")).alias("name"))
    new = T.first_rule("name", RENAME_RULES)
    return d.select("doc_id", new.alias("new_name"), (new != F.col("name")).alias("changed"))
