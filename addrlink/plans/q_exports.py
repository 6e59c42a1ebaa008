"""Exports, producer-file readers, audit and merged groups on driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sqlfrag as S
from ..catalog import query
from ..functions import text as T
from ..operators import cascade as C
from ..operators import relational as R
from ..session import ensure_checkpoint_dir, read_table
from ..sinks import ndjson as K
from ..sources import readers as SR
from . import housenumbers as H
from .q_housenumbers import MODEL_SQL, _fantoir, _hn, all_numbers, model
from . import audit as A
from . import cascade_ign as I
from .q_matching import PARITY_SQL, doc_groups, sql_one_to_one


def scratch_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:8]}"


# ------------------------------------------------------------------ JSON documents
def _json_sql(*keys: tuple[str, str, bool] | str) -> str:
    """A document as text: (key, SQL value, always written) or a piece of JSON with its leading comma, in this order."""
    out = ["'{'"]
    for n, k in enumerate(keys):
        comma = "," if n else ""
        if isinstance(k, str):
            out.append(k)
            continue
        name, value, always = k
        head = S.q(f'{comma}"{name}":')
        out.append(f"{head} || to_json(coalesce({value}, ''))" if always else
                   f"CASE WHEN {value} IS NOT NULL THEN {head} || to_json({value}) ELSE '' END")
    return " || ".join([*out, "'}'"])


def _dep_sql(insee: str) -> str:
    return f"CASE WHEN {insee} LIKE '97%' THEN left({insee}, 3) ELSE left({insee}, 2) END"


def _source_sql(name: str) -> str:
    return S.q(f',"attributes":{{"source_init_name":"{name}"}}')


def written_and_read(spark, docs, name: str):
    """K6: the documents as they come back from the files of a partitioned write."""
    path = scratch_dir(spark, name)
    K.write_ndjson(docs, path)
    return K.read_ndjson(spark, path)


_GF_SQL = """gf AS (SELECT CAST(10000 + c_custkey % 25 AS VARCHAR) || right('0000' || CAST(c_custkey AS VARCHAR), 4) AS id_fantoir,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 'I' || CAST(c_custkey AS VARCHAR) END AS id_pseudo_fpb,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE right('0000000' || CAST(c_custkey AS VARCHAR), 8) END AS co_voie,
    CASE WHEN c_nationkey = 3 THEN '97' ELSE '10' END || CAST(100 + c_custkey % 25 AS VARCHAR) AS code_insee,
    'RUE ' || upper(c_name) AS nom_maj_fantoir,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'Rue "' || lower(c_name) || '" é\\' END AS nom_ign_retenu,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'R ' || upper(c_name) END AS lb_voie,
    CASE WHEN c_acctbal > 0 THEN 'Rue ' || c_name END AS nom_cadastre,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'area' ELSE 'way' END AS kind_fantoir,
    CASE WHEN c_nationkey % 4 > 0 THEN 'way' END AS kind_ign, 'way' AS kind_laposte,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Al ' || c_name END AS alias_ign,
    CASE WHEN c_nationkey % 2 = 0 THEN 'classical' END AS addressing FROM customer)"""
_T, _PLACE = ("type", "'group'", True), ("municipality:insee", "code_insee", True)
_GROUP_SQL = {
    "03_A_groups": ("id_fantoir", _json_sql(
        _T, ("group", "kind_fantoir", True), ("fantoir", "id_fantoir", True), _PLACE, ("name", "nom_maj_fantoir", True),
        _source_sql("FANTOIR"))),
    "03_B_groups": ("id_pseudo_fpb", _json_sql(
        _T, ("group", "kind_ign", True), _PLACE, ("name", "nom_ign_retenu", True), ("ign", "id_pseudo_fpb", True),
        _source_sql("IGN"), ("fantoir", "id_fantoir", False), ("alias", "alias_ign", False), ("addressing", "addressing", False))),
    "03_C_groups": ("co_voie", _json_sql(
        _T, ("group", "kind_laposte", True), _PLACE, ("name", "lb_voie", True), ("laposte", "co_voie", True),
        _source_sql("LAPOSTE"), ("fantoir", "id_fantoir", False), ("ign", "id_pseudo_fpb", False))),
    "03_D_groups": ("nom_cadastre", _json_sql(
        _T, ("fantoir", "id_fantoir", True), ("name", "nom_cadastre", True), _source_sql("DGFIP"))),
}


@query("json_groups", f"WITH {_GF_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT {_dep_sql('code_insee')} AS dep, '{file}' AS file, {doc} AS json FROM gf WHERE {known} IS NOT NULL"
    for file, (known, doc) in _GROUP_SQL.items()))
def json_groups(spark, sf):
    """The four versions of the street documents, whole texts, written and read back by department."""
    c = read_table(spark, sf, "customer")
    k, seg, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    gf = c.select(
        _fantoir(k).alias("id_fantoir"),
        F.when(seg != "AUTOMOBILE", F.concat(F.lit("I"), k.cast("string"))).alias("id_pseudo_fpb"),
        F.when(seg != "FURNITURE", T.pad8(k.cast("string"))).alias("co_voie"),
        F.concat(F.when(nation == 3, F.lit("97")).otherwise(F.lit("10")), (100 + k % 25).cast("string")).alias("code_insee"),
        F.concat(F.lit("RUE "), F.upper("c_name")).alias("nom_maj_fantoir"),
        F.when(seg != "AUTOMOBILE", F.concat(F.lit('Rue "'), F.lower("c_name"), F.lit('" é\\'))).alias("nom_ign_retenu"),
        F.when(seg != "FURNITURE", F.concat(F.lit("R "), F.upper("c_name"))).alias("lb_voie"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Rue "), F.col("c_name"))).alias("nom_cadastre"),
        F.when(seg == "BUILDING", F.lit("area")).otherwise(F.lit("way")).alias("kind_fantoir"),
        F.when(nation % 4 > 0, F.lit("way")).alias("kind_ign"), F.lit("way").alias("kind_laposte"),
        F.when(nation % 3 == 0, F.concat(F.lit("Al "), F.col("c_name"))).alias("alias_ign"),
        F.when(nation % 2 == 0, F.lit("classical")).alias("addressing"))
    return written_and_read(spark, R.append(*[K.export_groups(gf, v) for v in (1, 2, 3, 4)]), "groups")


_LOCATED = [f"CASE WHEN co_postal IS NOT NULL THEN ',\"postcode:code\":' || to_json(co_postal) || "
            f"',\"municipality:insee\":' || to_json(code_insee) ELSE '' END", ("postcode:complement", "lb_l5", False),
            "',\"attributes\":{\"source_init\":' || to_json(source_init) || CASE WHEN destination IS NOT NULL THEN "
            "',\"destination_dgfip\":' || to_json(destination) ELSE '' END || '}'"]
_NUMBER = [("numero", "number", True), ("ordinal", "ordinal", True), *_LOCATED]
_HN_SQL = {
    "04_housenumbers": ("group_fantoir IS NOT NULL", _json_sql(
        ("type", "'housenumber'", True), ("group:fantoir", "group_fantoir", True), ("cia", "cia", True), ("ign", "ign", False),
        ("laposte", "laposte", False), *_NUMBER)),
    "05_housenumbers": ("group_fantoir IS NULL AND group_ign IS NOT NULL", _json_sql(
        ("type", "'housenumber'", True), ("group:ign", "group_ign", True), ("cia", "''", True), ("ign", "ign", True),
        ("laposte", "laposte", True), *_NUMBER)),
    "06_housenumbers": ("group_fantoir IS NULL AND group_ign IS NULL AND group_laposte IS NOT NULL", _json_sql(
        ("type", "'housenumber'", True), ("group:laposte", "group_laposte", True), ("cia", "''", True),
        ("laposte", "laposte", True), *_NUMBER)),
}


@query("json_housenumbers", f"WITH {MODEL_SQL.strip()}\n" + "\nUNION ALL\n".join(
    f"SELECT {_dep_sql('code_insee')} AS dep, '{file}' AS file, {doc} AS json FROM hn_all WHERE {known}"
    for file, (known, doc) in _HN_SQL.items()))
def json_housenumbers(spark, sf):
    """K4: house numbers in three disjoint sets by parent id, optional keys, nested attributes; whole texts."""
    return K.export_housenumbers(all_numbers(spark, sf))


def _position_sql(*keys) -> str:
    return _json_sql(("type", "'position'", True), ("kind", "kind", True), ("name", "name", False),
                     ("positioning", "positioning", True), *keys,
                     "',\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}'",
                     ("source", "source_init", True))


@query("json_positions", f"""
WITH {MODEL_SQL.strip()},
gi AS (SELECT id_pseudo_fpb, id_fantoir FROM groups),
ip AS (SELECT s.*, CASE WHEN indice_de_positionnement = '5' THEN 'area' WHEN type_de_localisation = 'A la plaque' THEN 'entrance'
    WHEN type_de_localisation = 'Projetée du centre parcelle' THEN 'segment' WHEN type_de_localisation LIKE 'A la zone%' THEN 'area'
    WHEN type_de_localisation = 'Interpolée' THEN 'segment' ELSE 'unknown' END AS kind,
    CASE WHEN type_de_localisation LIKE 'Projetée%' THEN 'projection' WHEN type_de_localisation = 'Interpolée' THEN 'interpolation'
         ELSE 'other' END AS positioning,
    CASE WHEN gi.id_fantoir IS NOT NULL THEN concat_ws('_', left(gi.id_fantoir, 5), right(gi.id_fantoir, 4), s.numero, s.rep)
         ELSE '' END AS cia
    FROM stacked s LEFT JOIN gi ON gi.id_pseudo_fpb = s.id_pseudo_fpb),
pos AS (SELECT cia, CAST(round(CAST(lon AS DECIMAL(20,10)), 6) AS DECIMAL(17,6)) AS lon,
    CAST(round(CAST(lat AS DECIMAL(20,10)), 6) AS DECIMAL(17,6)) AS lat, id AS ign, id_hn AS housenumber_ign, kind, positioning,
    designation_de_l_entree AS name, 'IGN (2018)' AS source_init
    FROM ip WHERE kind <> 'unknown' AND indice_de_positionnement <> '6'
    UNION ALL
    SELECT cia, CAST(round(CAST(lon AS DECIMAL(20,10)), 6) AS DECIMAL(17,6)), CAST(round(CAST(lat AS DECIMAL(20,10)), 6) AS DECIMAL(17,6)),
    NULL, NULL, CASE WHEN position_type = 'parcel' THEN 'parcel' ELSE 'entrance' END, 'other', NULL, 'DGFIP/ETALAB (2018)'
    FROM taxc WHERE position_type IS NOT NULL),
pk1 AS (SELECT cia, max(code_insee) AS insee1 FROM hn_all WHERE cia IS NOT NULL AND cia <> '' GROUP BY cia),
pk2 AS (SELECT ign, max(code_insee) AS insee2 FROM hn_all WHERE ign IS NOT NULL AND ign <> '' GROUP BY ign),
p AS (SELECT pos.*, {_dep_sql('insee1')} AS d1, {_dep_sql('insee2')} AS d2
      FROM pos LEFT JOIN pk1 ON pos.cia = pk1.cia LEFT JOIN pk2 ON pos.housenumber_ign = pk2.ign
      WHERE (pos.cia IS NOT NULL AND pos.cia <> '' AND pk1.insee1 IS NOT NULL) OR pk2.insee2 IS NOT NULL),
d AS (SELECT p.*, unnest([x FOR x IN CASE WHEN d1 = d2 THEN [d1] ELSE [d1, d2] END IF x IS NOT NULL]) AS dep FROM p)
SELECT dep, '07_positions' AS file, {_position_sql(("housenumber:cia", "cia", True))} AS json FROM d WHERE source_init LIKE '%DGFIP%'
UNION ALL
SELECT dep, '08_positions', {_position_sql(("housenumber:ign", "housenumber_ign", True), ("ign", "ign", True))}
FROM d WHERE source_init LIKE '%IGN%'
""")
def json_positions(spark, sf):
    """Positions as GeoJSON points in the department of either municipality, written and read back."""
    m, stacked, tax, hn = _hn(spark, sf)
    p = H.build_positions(H.ign_positions(stacked, m["groups"]), tax, hn)
    return written_and_read(spark, K.export_positions(p), "positions")


@query("json_places", f"""
WITH m AS (SELECT DISTINCT CASE WHEN c_nationkey = 3 THEN '97' ELSE '10' END || CAST(100 + c_custkey % 25 AS VARCHAR) AS insee FROM customer),
n AS (SELECT insee, 'L''"' || insee AS name FROM m),
p AS (SELECT DISTINCT CASE WHEN c_nationkey = 3 THEN '97' ELSE '10' END || CAST(100 + c_custkey % 25 AS VARCHAR) AS co_insee,
        CAST(20000 + c_nationkey AS VARCHAR) AS co_postal, upper(c_mktsegment) AS lb_l6,
        CASE WHEN c_acctbal < 1000 THEN 'L5 ' || c_mktsegment END AS lb_l5_nn FROM customer)
SELECT {_dep_sql('insee')} AS dep, '01_municipalities' AS file,
       {_json_sql(("type", "'municipality'", True), ("insee", "insee", True), ("name", "name", True))} AS json FROM n
UNION ALL
SELECT {_dep_sql('co_insee')}, '02_postcodes', {_json_sql(
    ("type", "'postcode'", True), ("postcode", "co_postal", True), ("name", "lb_l6", True),
    ("municipality:insee", "co_insee", True), ("complement", "lb_l5_nn", True))} FROM p
""")
def json_places(spark, sf):
    """K1 K2 K6: municipality and postcode documents, written by department and read back."""
    c = read_table(spark, sf, "customer")
    insee = F.concat(F.when(F.col("c_nationkey") == 3, F.lit("97")).otherwise(F.lit("10")),
                     (100 + F.col("c_custkey") % 25).cast("string"))
    towns = c.select(insee.alias("insee")).distinct().withColumn("name", F.concat(F.lit("L'\""), F.col("insee")))
    codes = c.select(insee.alias("co_insee"), (20000 + F.col("c_nationkey")).cast("string").alias("co_postal"),
                     F.upper("c_mktsegment").alias("lb_l6"),
                     F.when(F.col("c_acctbal") < 1000, F.concat(F.lit("L5 "), F.col("c_mktsegment"))).alias("lb_l5_nn")).distinct()
    return written_and_read(spark, R.append(K.export_municipalities(towns), K.export_postcodes(codes)), "places")


@query("json_patches", """
SELECT '{"method":"PATCH","path":"/group/' || CAST(c_custkey AS VARCHAR) || '","body":{"name":' ||
       to_json(CASE WHEN c_mktsegment = 'BUILDING' THEN replace('Ch ' || c_name, 'Ch ', 'Chemin ') ELSE replace('Rte ' || c_name, 'Rte ', 'Route ') END)
       || ',"version":"' || CAST(c_nationkey + 1 AS VARCHAR) || '"}}' AS json
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def json_patches(spark, sf):
    """Rename patches - method, path, new name and next version - of the streets that a rule changes."""
    c = read_table(spark, sf, "customer")
    head = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Ch ")).when(F.col("c_mktsegment") == "MACHINERY", F.lit("Rte ")).otherwise(F.lit("Rue "))
    g = c.select(F.col("c_custkey").alias("id"), F.concat(head, F.col("c_name")).alias("name"), F.col("c_nationkey").alias("version"))
    g = g.withColumn("renamed", T.first_rule("name", [("Ch ", "Chemin "), ("Rte ", "Route ")]))
    return K.export_patches(g, "renamed")


# ------------------------------------------------------------------ merged groups
@query("merge_groups", f"""
WITH {PARITY_SQL.strip()},
k AS ({sql_one_to_one('l', 'r', 'l.court = r.court')}),
lk AS (SELECT l.lid, k.rid, l.block, l.name AS nom_fantoir, r.name AS nom_ign FROM l
       LEFT JOIN k ON l.lid = k.lid LEFT JOIN r ON k.rid = r.rid),
ru AS (SELECT NULL AS lid, r.rid, r.block, NULL AS nom_fantoir, r.name AS nom_ign FROM r
       WHERE r.rid NOT IN (SELECT rid FROM k)),
mg AS (SELECT * FROM lk UNION ALL SELECT * FROM ru),
n AS (SELECT *, coalesce(nom_ign, nom_fantoir) AS nom_maj_fnal FROM mg WHERE coalesce(nom_ign, nom_fantoir) <> '')
SELECT row_number() OVER (ORDER BY coalesce(lid, ''), coalesce(rid, '')) AS id, lid, rid, block,
       length(nom_maj_fnal) AS name_len, nom_ign IS NOT NULL AS has_ign
FROM n
""")
def merge_groups(spark, sf):
    """Merged group table (left rows + links + unlinked right
    rows), display-name priority, unnamed rows dropped, dense surrogate ids."""
    l, r = doc_groups(spark, sf)
    links = C.Matcher(l, r, [I.m5()]).independent().select("lid", "rid")
    # the result needs the length of a name only: no text takes part in the joins below
    size = F.length("name")
    lk = (l.select("lid", "block", size.alias("len_fantoir")).join(links, "lid", "left")
          .join(r.select("rid", size.alias("len_ign")), "rid", "left"))
    ru = R.unmatched(r.select("rid", "block", size.alias("len_ign")), links, "rid")
    g = R.append(lk, ru)
    g = g.withColumn("name_len", F.coalesce("len_ign", "len_fantoir")).filter(F.col("name_len") > 0)
    g = g.withColumn("_o1", F.coalesce("lid", F.lit(""))).withColumn("_o2", F.coalesce("rid", F.lit("")))
    g = R.assign_ids(g, ["_o1", "_o2"])
    return g.select("id", "lid", "rid", "block", "name_len", F.col("len_ign").isNotNull().alias("has_ign"))


# ------------------------------------------------------------------ audit
@query("audit", """
WITH lo AS (SELECT DISTINCT l_orderkey FROM lineitem),
lsum AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS s, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT 'R1 orders' AS check_name, '' AS k, count(*) AS n FROM orders
UNION ALL SELECT 'R1 orders in lineitem', '', count(*) FROM lo
UNION ALL SELECT 'R2 lost orders', '', count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lo WHERE lo.l_orderkey = o.o_orderkey)
UNION ALL SELECT 'R3 price mismatch', '', count(*) FROM orders o LEFT JOIN lsum ON o.o_orderkey = lsum.l_orderkey
   WHERE lsum.s IS NULL OR lsum.s <> round(o.o_totalprice, 2)
UNION ALL SELECT 'R4 duplicate lines', '', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'R5 status F without F line', '', count(*) FROM orders o WHERE o.o_orderstatus = 'F'
   AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = 'F')
UNION ALL SELECT 'R6 status', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'R8 flag by status', l_linestatus || '/' || l_returnflag, count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'R11 line count differs', '', count(*) FROM orders o JOIN lsum ON o.o_orderkey = lsum.l_orderkey
   WHERE lsum.n <> (o.o_orderkey % 7) + 1
UNION ALL SELECT 'R12 bad part ids', '', count(*) FROM (SELECT l_partkey FROM lineitem GROUP BY l_partkey) x
   WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = x.l_partkey)
UNION ALL SELECT 'O2 top order', CAST(o_orderkey AS VARCHAR), 1 FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
""")
def audit(spark, sf):
    """Source-versus-result checks as one tidy (check_name, k, n) table.

    Lines are summed per order once; all checks of an order are conditions of one
    aggregate over orders and these sums.
    """
    o, li, part = (read_table(spark, sf, t) for t in ("orders", "lineitem", "part"))
    lines = li.groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("s"), F.count(F.lit(1)).alias("n"),
        F.max(F.col("l_linestatus") == "F").alias("has_f"))
    both = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "full")
    known, lost = F.col("o_orderkey").isNotNull(), F.col("l_orderkey").isNull()
    per_order = A.checks(both, {
        "R1 orders": known, "R1 orders in lineitem": ~lost, "R2 lost orders": known & lost,
        "R3 price mismatch": known & (lost | (F.col("s") != F.round("o_totalprice", 2))),
        "R5 status F without F line": (F.col("o_orderstatus") == "F") & ~F.coalesce("has_f", F.lit(False)),
        "R11 line count differs": known & (F.col("n") != (F.col("o_orderkey") % 7) + 1)})
    flags = A.frequency(li.select(F.concat_ws("/", "l_linestatus", "l_returnflag").alias("flag by status")), "flag by status")
    return A.audit(
        per_order, A.count_rows("R4 duplicate lines", A.duplicate_keys(li, ["l_orderkey", "l_linenumber"])),
        A.frequency(o.withColumnRenamed("o_orderstatus", "status"), "status"),
        flags.withColumn("check_name", F.lit("R8 flag by status")),
        A.count_rows("R12 bad part ids", A.bad_foreign_ids(li, part, "l_partkey", "p_partkey")),
        o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).select(
            F.lit("O2 top order").alias("check_name"), F.col("o_orderkey").cast("string").alias("k"), F.lit(1).cast("long").alias("n")))


_SRC_SQL = """src AS (SELECT o_orderkey AS id, o_custkey AS parent, o_orderstatus AS status, left(o_orderpriority, 1) AS prio,
  o_orderkey % 4 AS number FROM orders),
dst AS (SELECT id, parent, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN 'X' ELSE status END AS status,
  CASE prio WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' ELSE 'low' END AS code, prio,
  CASE WHEN id % 13 = 0 THEN number + 1 ELSE number END AS number, CASE WHEN id % 9 > 0 THEN 'S' || CAST(id AS VARCHAR) END AS ign,
  CASE WHEN id % 8 > 0 THEN 'DGFIP|IGN' ELSE 'DGFIP' END AS source FROM src WHERE id % 10 > 0),
lost AS (SELECT * FROM src WHERE id NOT IN (SELECT id FROM dst)),
m AS (SELECT n_nationkey AS pk FROM nation WHERE n_name LIKE 'NATION_1%'),
g AS (SELECT c_custkey AS pk FROM customer WHERE c_nationkey IN (SELECT pk FROM m)),
h AS (SELECT o_orderkey AS pk FROM orders WHERE o_custkey IN (SELECT pk FROM g)),
far AS (SELECT id, number, 0.00001 * (id % 20) AS dlat FROM src)"""


@query("register_audit", f"""
WITH {_SRC_SQL}
SELECT 'R1 source' AS check_name, '' AS k, count(*) AS n FROM src
UNION ALL SELECT 'R1 result', '', count(*) FROM dst
UNION ALL SELECT 'R2 lost', CAST(id AS VARCHAR), 1 FROM lost
UNION ALL SELECT 'R3 status', '', count(*) FROM src s JOIN dst d USING (id) WHERE s.status IS DISTINCT FROM d.status
UNION ALL SELECT 'R3 number', '', count(*) FROM src s JOIN dst d USING (id) WHERE s.number IS DISTINCT FROM d.number
UNION ALL SELECT 'R5 ign id known', '', count(*) FROM dst WHERE source LIKE '%IGN%' AND ign IS NULL
UNION ALL SELECT 'R7 refound', '', count(*) FROM lost l WHERE EXISTS
  (SELECT 1 FROM dst d WHERE d.parent = l.parent AND d.prio = l.prio AND d.number = l.number)
UNION ALL SELECT 'R8 prio->code', prio, count(*) FROM dst
  WHERE code <> CASE prio WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '4' THEN 'none' ELSE 'low' END GROUP BY prio
UNION ALL SELECT 'R9 municipality', '', count(*) FROM m UNION ALL SELECT 'R9 group', '', count(*) FROM g
UNION ALL SELECT 'R9 housenumber', '', count(*) FROM h
UNION ALL SELECT 'R9 position', '', count(*) FROM lineitem WHERE l_orderkey IN (SELECT pk FROM h)
UNION ALL SELECT 'R10 0.1 m', '', count(*) FROM far WHERE 2 * 6371008.8 * asin(sqrt(sin(radians(dlat) / 2) ^ 2)) > 0.1
UNION ALL SELECT 'R10 10 m', '', count(*) FROM far WHERE 2 * 6371008.8 * asin(sqrt(sin(radians(dlat) / 2) ^ 2)) > 10
UNION ALL SELECT 'R11 number', '', count(*) FROM src s JOIN dst d USING (id) WHERE s.number IS DISTINCT FROM d.number
UNION ALL SELECT 'R12 parent', CAST(parent AS VARCHAR), count(*) FROM dst
  WHERE parent NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 6 > 0) GROUP BY parent
UNION ALL SELECT 'A8 no status', CAST(parent AS VARCHAR), count(*) FROM dst GROUP BY parent
  HAVING max(status) IS NULL AND max(ign) IS NOT NULL
""")
def register_audit(spark, sf):
    """R1-R12 A8 through the audit library: a register (from ``orders``) against a result with lost rows,
    changed values and missing ids."""
    o = read_table(spark, sf, "orders")
    src = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"), F.col("o_orderstatus").alias("status"),
                   F.left("o_orderpriority", F.lit(1)).alias("prio"), (F.col("o_orderkey") % 4).alias("number"))
    i, p = F.col("id"), F.col("prio")
    dst = src.filter(i % 10 > 0).select(
        "id", "parent", F.when(i % 7 == 0, F.lit(None)).when(i % 11 == 0, F.lit("X")).otherwise(F.col("status")).alias("status"),
        F.when(p == "1", "urgent").when(p == "2", "high").when(p == "3", "medium").otherwise("low").alias("code"), "prio",
        F.when(i % 13 == 0, F.col("number") + 1).otherwise(F.col("number")).alias("number"),
        F.when(i % 9 > 0, F.concat(F.lit("S"), i.cast("string"))).alias("ign"),
        F.when(i % 8 > 0, F.lit("DGFIP|IGN")).otherwise(F.lit("DGFIP")).alias("source"))
    lost = A.lost_rows(src, dst, "id")
    tables = {"municipality": read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("pk"), F.col("n_name").alias("insee")),
              "group": read_table(spark, sf, "customer").select(F.col("c_custkey").alias("pk"), F.col("c_nationkey").alias("municipality_id")),
              "housenumber": o.select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("parent_id")),
              "position": read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("housenumber_id"))}
    part = A.restrict_department(tables, "NATION_1")
    far = src.select("id", F.lit(2.0).alias("lon"), F.lit(0.0).alias("lat"), F.lit(2.0).alias("lon2"),
                     (F.lit(0.00001) * (i % 20)).alias("lat2"))
    one = lambda name, df, k, n: df.select(F.lit(name).alias("check_name"), F.col(k).cast("string").alias("k"), n.cast("long").alias("n"))
    register = read_table(spark, sf, "customer").filter(F.col("c_custkey") % 6 > 0)
    without = A.having(dst, ["parent"], {"n": F.count(F.lit(1)), "status": F.max("status"), "ign": F.max("ign")}, ["status"], ["ign"])
    codes = {"1": "urgent", "2": "high", "3": "medium", "4": "none", "5": "low"}
    return A.audit(
        A.count_check("R1", src, dst), one("R2 lost", lost, "id", F.lit(1)),
        A.mismatch(src, dst, "id", {"status": "status", "number": "number"}),
        A.coherence(dst, {"ign id known": ~F.contains("source", F.lit("IGN")) | F.col("ign").isNotNull()}),
        A.count_rows("R7 refound", A.refound(lost, dst, ["parent", "prio", "number"])),
        A.mapping_check(dst, "prio", "code", codes), *[A.count_rows(f"R9 {t}", df) for t, df in part.items()],
        A.count_rows("R10 0.1 m", A.distance_outliers(far, 0.1)), A.count_rows("R10 10 m", A.distance_outliers(far, 10)),
        A.count_rows("R11 number", A.ordinal_mismatch(src, dst, "id", "number")),
        one("R12 parent", A.bad_foreign_ids(dst, register, "parent", "c_custkey"), "parent", F.col("n")),
        one("A8 no status", without, "parent", F.col("n")))


@query("anomaly_reports", f"""
WITH {_SRC_SQL},
lines AS (
  SELECT 'anomalies' AS report, CAST(id AS VARCHAR) || ';' || status AS line FROM dst WHERE status = 'X'
  UNION ALL SELECT 'too_far', CAST(id AS VARCHAR) || ';' || CAST(number AS VARCHAR) FROM far
    WHERE 2 * 6371008.8 * asin(sqrt(sin(radians(dlat) / 2) ^ 2)) > 10
  UNION ALL SELECT 'ordinals', CAST(s.id AS VARCHAR) || ';' || CAST(d.number AS VARCHAR) FROM src s JOIN dst d USING (id) WHERE s.number <> d.number
  UNION ALL SELECT 'postal_links', CAST(l.id AS VARCHAR) || ';' || CAST(d.id AS VARCHAR) FROM lost l JOIN dst d
    ON d.parent = l.parent AND d.prio = l.prio AND d.number = l.number)
SELECT report, line FROM lines
""")
def anomaly_reports(spark, sf):
    """The anomaly export and the three reports, written sorted as CSV and read back."""
    o = read_table(spark, sf, "orders")
    src = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"), F.col("o_orderstatus").alias("status"),
                   F.left("o_orderpriority", F.lit(1)).alias("prio"), (F.col("o_orderkey") % 4).alias("number"))
    i = F.col("id")
    dst = src.filter(i % 10 > 0).withColumns({
        "status": F.when(i % 7 == 0, F.lit(None)).when(i % 11 == 0, F.lit("X")).otherwise(F.col("status")),
        "number": F.when(i % 13 == 0, F.col("number") + 1).otherwise(F.col("number"))})
    far = A.distance_outliers(src.select("id", "number", F.lit(2.0).alias("lon"), F.lit(0.0).alias("lat"), F.lit(2.0).alias("lon2"),
                                         (F.lit(0.00001) * (i % 20)).alias("lat2")), 10)
    ordinals = A.ordinal_mismatch(src, dst, "id", "number").select(F.col("a.id").alias("id"), F.col("b.number").alias("number"))
    keys = ["parent", "prio", "number"]
    links = A.lost_rows(src, dst, "id").join(dst.select(*keys, F.col("id").alias("other")), keys).select("id", "other")
    path = scratch_dir(spark, "reports")
    K.export_anomalies(dst.filter(F.col("status") == "X").select("id", "status"), f"{path}/anomalies", ["id"])
    K.export_reports({"too_far": (far.select("id", "number", "dist_m"), [F.desc("dist_m"), F.col("id")]),
                      "ordinals": (ordinals, [F.col("id")]), "postal_links": (links, [F.col("id"), F.col("other")])}, path)
    back = [SR.read_csv_table(spark, f"{path}/{r}", ["a", "b"]).select(F.lit(r).alias("report"), F.concat_ws(";", "a", "b").alias("line"))
            for r in ("anomalies", "too_far", "ordinals", "postal_links")]
    return R.append(*back)


# ------------------------------------------------------------------ producer files read back
@query("fixed_width", """
SELECT right('00' || CAST(c_nationkey AS VARCHAR), 2) AS code_dept, right('000' || CAST(c_custkey % 1000 AS VARCHAR), 3) AS code_com,
  right('0000' || CAST(c_custkey AS VARCHAR), 4) AS id_voie, trim(left(upper(c_mktsegment), 4)) AS nature_voie,
  trim(left(upper(replace(c_name, '#', ' ')), 26)) AS libelle_voie,
  TRY_CAST(CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS INTEGER) AS pop_a_part, CAST(NULL AS INTEGER) AS pop_fictive,
  right('00' || CAST(c_nationkey AS VARCHAR), 2) || right('000' || CAST(c_custkey % 1000 AS VARCHAR), 3) AS code_insee,
  right('00' || CAST(c_nationkey AS VARCHAR), 2) || right('000' || CAST(c_custkey % 1000 AS VARCHAR), 3) || '_' ||
  right('0000' || CAST(c_custkey AS VARCHAR), 4) || 'K' AS fantoir
FROM customer
""")
def fixed_width(spark, sf):
    """A fixed-width register written from ``customer`` (street records
    interleaved with department / municipality header lines) and read back
    with the layout; headers filtered; integers by ``try_cast``."""
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    dept = F.right(F.concat(F.lit("00"), F.col("c_nationkey").cast("string")), F.lit(2))
    com = F.right(F.concat(F.lit("000"), (k % 1000).cast("string")), F.lit(3))
    street = F.right(F.concat(F.lit("0000"), k.cast("string")), F.lit(4))
    label = F.left(F.upper(F.replace("c_name", F.lit("#"), F.lit(" "))), F.lit(26))
    pop = F.floor("c_acctbal").cast("bigint").cast("string")
    sp = lambda n: F.lit(" " * n)
    line = F.concat(dept, F.lit("0"), com, street, F.lit("K"),                      # 1-11
                    F.rpad(F.left(F.upper("c_mktsegment"), F.lit(4)), 4, " "),      # 12-15
                    F.rpad(label, 26, " "), sp(7), F.lit("3"), sp(3), sp(7),          # 16-59
                    F.lpad(pop, 7, " "), sp(7), sp(1), sp(7), F.lit("0000000"),      # 60-88
                    sp(15), F.lit("00001"), F.lit("1"), sp(1), sp(2), F.lit("LASTWORD"))  # 89-120
    dep_hdr = c.select(F.concat(dept, F.lit("0 DEPARTEMENT")).alias("value")).distinct()
    com_hdr = c.select(F.concat(dept, F.lit("0"), com, F.lit(" COMMUNE")).alias("value")).distinct()
    path = scratch_dir(spark, "fixed")
    dep_hdr.unionByName(com_hdr).unionByName(c.select(line.alias("value"))).write.mode("overwrite").text(path)
    r = SR.read_fixed_width(spark, path)
    return r.select("code_dept", "code_com", "id_voie", "nature_voie", "libelle_voie", "pop_a_part",
                    "pop_fictive", "code_insee", "fantoir")


@query("csv_sources", """
SELECT CAST(c_custkey AS VARCHAR) AS co_insee, c_name AS lb_l5_nn, CAST(c_nationkey AS VARCHAR) AS co_insee_anc,
       c_mktsegment AS co_postal, c_name || ' é' AS lb_l6, 'main' AS part FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment, c_name || ' é', 'errors'
FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT '75056', 'PARIS', NULL, '75000', 'PARIS', 'extra'
""")
def csv_sources(spark, sf):
    """S1 S3 S4 S10 S12: ';' CSV files with header written per department plus
    an ``*_errors*`` file, read back with a fixed schema (ISO-8859-1), the
    error file kept apart by file name, literal reference rows appended."""
    c = read_table(spark, sf, "customer")
    base = c.select(F.col("c_custkey").cast("string").alias("co_insee"), F.col("c_name").alias("lb_l5_nn"),
                    F.col("c_nationkey").cast("string").alias("co_insee_anc"),
                    F.col("c_mktsegment").alias("co_postal"),
                    F.concat(F.col("c_name"), F.lit(" é")).alias("lb_l6"), "c_acctbal")
    path = scratch_dir(spark, "csv")
    w = lambda df, sub: (df.drop("c_acctbal").write.mode("overwrite").option("header", True).option("sep", ";")
                         .option("encoding", "ISO-8859-1").csv(f"{path}/{sub}"))
    w(base.filter(F.col("c_acctbal") >= 0), "poste_cp")
    w(base.filter(F.col("c_acctbal") < 0), "poste_cp_errors")
    cols = ["co_insee", "lb_l5_nn", "co_insee_anc", "co_postal", "lb_l6"]
    main = SR.read_csv_table(spark, f"{path}/*", cols, sep=";", encoding="ISO-8859-1", exclude="%_errors%")
    errs = SR.read_csv_table(spark, f"{path}/*_errors", cols, sep=";", encoding="ISO-8859-1")
    extra = spark.createDataFrame([("75056", "PARIS", "75000", "PARIS")],
                                  "co_insee string, lb_l5_nn string, co_postal string, lb_l6 string")
    return R.append(main.withColumn("part", F.lit("main")), errs.withColumn("part", F.lit("errors")),
                    extra.withColumn("part", F.lit("extra"))).select(*cols, "part")


@query("csv_reports", f"""
WITH {PARITY_SQL.strip()},
k AS ({sql_one_to_one('l', 'r', 'l.court = r.court')})
SELECT r.rid AS id_pseudo_fpb, r.ref AS id_fantoir, length(r.court) AS court_len,
       CASE WHEN CAST(r.rid AS BIGINT) % 3 = 0 THEN '1' END AS app
FROM r WHERE r.rid NOT IN (SELECT rid FROM k)
""")
def csv_reports(spark, sf):
    """Unmatched right groups exported for review (sorted, previous
    decisions joined back), written as ';' CSV and read back."""
    l, r = doc_groups(spark, sf)
    links = C.Matcher(l, r, [I.m5()]).independent().select("lid", "rid")
    un = R.unmatched(r, links, "rid")
    decisions = r.select(F.col("rid").alias("id_pseudo_fpb"),
                         F.when(F.col("rid").cast("bigint") % 3 == 0, F.lit("1")).alias("app"))
    rep = (un.select(F.col("rid").alias("id_pseudo_fpb"), F.col("ref").alias("id_fantoir"),
                     F.length("court").alias("court_len"))
           .join(decisions, "id_pseudo_fpb", "left").orderBy("id_fantoir"))
    path = scratch_dir(spark, "review")
    K.write_csv(rep, path)
    back = SR.read_csv_table(spark, path, "id_pseudo_fpb string, id_fantoir string, court_len int, app string")
    return back.select("id_pseudo_fpb", "id_fantoir", F.col("court_len").cast("long").alias("court_len"), "app")
