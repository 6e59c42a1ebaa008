"""Producer files on driver tables: written in the producers' formats, read back by the library's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import text as T
from ..functions.abbrev import abbreviate_join
from ..operators.relational import append
from ..session import read_table
from ..sources import readers as SR
from .q_exports import scratch_dir


def write_lines(df: DataFrame, path: str) -> None:
    """The column ``value`` as ISO-8859-1 lines, one header line in every file; files and lines keep the order."""
    (df.select(F.col("value").alias("header")).write.option("encoding", "ISO-8859-1").option("sep", "\u0001")
     .option("quote", "").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def fixed(layout: list[tuple[str, int, int]], first: str, **values: Column) -> Column:
    """A fixed-width line: ``first`` and the named fields of ``layout`` at their places."""
    parts, at = [F.lit(first)], 1 + len(first)
    for name, start, n in sorted(layout, key=lambda x: x[1]):
        parts += [F.lit(" " * (start - at)), F.rpad(values.get(name, F.lit("")), n, " ")]
        at = start + n
    return F.concat(*parts)


@query("postal_files", """
WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_name, c_mktsegment AS seg,
             right('00000' || CAST(c_nationkey AS VARCHAR), 6) AS loc, right('0000000' || CAST(c_custkey // 2 AS VARCHAR), 8) AS voie,
             CAST(10000 + c_nationkey AS VARCHAR) AS insee, CAST(20000 + c_custkey % 100 AS VARCHAR) AS cp FROM customer),
l AS (SELECT k, loc, insee, 'CŒUR ' || CAST(k AS VARCHAR) AS l5, CAST(30000 + k % 1000 AS VARCHAR) AS anc, cp, left(seg, 32) AS l6
      FROM c WHERE n % 5 < 4 AND k % 3 = 0),
ll AS (SELECT loc, arg_max(l5, k) AS l5, arg_max(anc, k) AS anc FROM l GROUP BY loc),
v AS (SELECT k, loc, insee, voie, cp, left(seg, 4) AS type, 'RUE ' || replace(c_name, '#', ' ') AS name FROM c),
vl AS (SELECT voie, arg_max(insee, k) AS insee, arg_max(cp, k) AS cp FROM v GROUP BY voie),
o AS (SELECT o_orderkey AS k, right('0000000' || CAST(o_custkey AS VARCHAR), 8) AS voie,
             CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 50 + 1 AS VARCHAR) END AS no,
             CASE WHEN o_orderkey % 3 = 0 THEN 'BIS' ELSE '' END AS ext, right('000000000' || CAST(o_orderkey AS VARCHAR), 10) AS cea FROM orders),
own AS (SELECT voie, arg_max(cea, k) AS cea FROM o WHERE no = '' GROUP BY voie)
SELECT 'poste_cp' AS part, insee AS co_insee, NULL AS co_voie, cp AS co_postal, l5 AS a, anc AS b, l6 AS c, NULL AS d FROM l
UNION ALL SELECT 'ran_group', v.insee, v.voie, v.cp, type, name, own.cea, ll.l5 || '/' || ll.anc
FROM v LEFT JOIN ll USING (loc) LEFT JOIN own ON own.voie = v.voie
UNION ALL SELECT 'ran_housenumber', coalesce(vl.insee, ''), o.voie, coalesce(vl.cp, ''), no, ext, cea, NULL
FROM o LEFT JOIN vl ON vl.voie = o.voie WHERE no <> ''
""")
def postal_files(spark, sf):
    """Locality and street records (from ``customer``) in one set of cp1252 files, house numbers (from ``orders``)
    in another; many files with a header each, the last line of a repeated id wins over all of them."""
    c, o = read_table(spark, sf, "customer"), read_table(spark, sf, "orders")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    loc = F.right(F.concat(F.lit("00000"), n.cast("string")), F.lit(6))
    insee, cp = (10000 + n).cast("string"), (20000 + k % 100).cast("string")
    town = fixed(SR.LOCALITY_LAYOUT, "L", loc_id=loc, co_insee=insee, lb_l5_nn=F.concat(F.lit("C\x8cUR "), k.cast("string")),
                 co_insee_anc=(30000 + k % 1000).cast("string"), co_postal=cp, lb_l6=F.col("c_mktsegment"))
    way = fixed(SR.STREET_LAYOUT, "V", loc_id=loc, co_insee=insee, co_voie=T.pad8(F.expr("c_custkey div 2").cast("string")),
                lb_type_voie=F.left("c_mktsegment", F.lit(4)), lb_voie=F.concat(F.lit("RUE "), F.replace("c_name", F.lit("#"), F.lit(" "))),
                co_postal=cp)
    lines = append(c.filter((n % 5 < 4) & (k % 3 == 0)).select(k.alias("k"), F.lit(0).alias("i"), town.alias("value")),
                   c.select(k.alias("k"), F.lit(1).alias("i"), way.alias("value")))
    key = F.col("o_orderkey")
    number = fixed(SR.NUMBER_LAYOUT, "", co_voie=T.pad8(F.col("o_custkey").cast("string")),
                   no_voie=F.when(key % 7 == 0, F.lit("")).otherwise((key % 50 + 1).cast("string")),
                   lb_ext=F.when(key % 3 == 0, F.lit("BIS")).otherwise(F.lit("")),
                   co_cea=F.right(F.concat(F.lit("000000000"), key.cast("string")), F.lit(10)))
    via, cle = scratch_dir(spark, "via"), scratch_dir(spark, "cle")
    write_lines(lines.repartitionByRange(3, "k").sortWithinPartitions("k", "i"), via)
    write_lines(o.select(key.alias("k"), number.alias("value")).repartitionByRange(3, "k").sortWithinPartitions("k"), cle)
    out = SR.read_postal_file(spark, via, cle)
    none = F.lit(None).cast("string")
    cols = lambda *c: [x if isinstance(x, Column) else F.col(x) for x in c]
    names = ["part", "co_insee", "co_voie", "co_postal", "a", "b", "c", "d"]
    parts = [out["localities"].select(*cols(F.lit("poste_cp"), "co_insee", none, "co_postal", "lb_l5_nn", "co_insee_anc", "lb_l6", none)),
             out["streets"].select(*cols(F.lit("ran_group"), "co_insee", "co_voie", "co_postal", "lb_type_voie", "lb_voie", "cea",
                                         F.concat("lb_l5", F.lit("/"), "co_insee_l5"))),
             out["housenumbers"].select(*cols(F.lit("ran_housenumber"), "co_insee", "co_voie", "co_postal", "no_voie", "lb_ext", "co_cea", none))]
    return append(*[p.toDF(*names) for p in parts])


@query("sql_dump", r"""
WITH t AS (SELECT p_partkey AS k, 'TERM' || CAST(p_partkey AS VARCHAR) AS a,
             CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'T\' || CAST(p_partkey AS VARCHAR)
                  WHEN p_partkey % 5 = 2 THEN 'x' || chr(9) || 'y' ELSE 'T' || CAST(p_partkey AS VARCHAR) END AS b FROM part),
p AS (SELECT *, 'TERM' || CAST(k AS VARCHAR) || ' OF TERM' || CAST(k AS VARCHAR) || 'X' AS label FROM t)
SELECT a AS txt_long, b AS txt_court, CASE WHEN b IS NULL THEN label ELSE replace(label, a || ' ', b || ' ') END AS label FROM p
""")
def sql_dump(spark, sf):
    """A dictionary in the COPY blocks of SQL dumps, among other tables, with NULLs and escapes; used to abbreviate."""
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    term, short = F.concat(F.lit("TERM"), k.cast("string")), F.concat(F.lit("T"), k.cast("string"))
    b = (F.when(k % 5 == 0, F.lit("\\N")).when(k % 5 == 1, F.concat(F.lit("T\\\\"), k.cast("string")))
         .when(k % 5 == 2, F.lit("x\\ty")).otherwise(short))
    data = p.select("p_brand", F.lit(2).alias("i"), F.concat(term, F.lit("\t"), b).alias("value"))
    brands = p.select("p_brand").distinct()
    frame = [(0, "SET client_encoding = 'UTF8';"), (1, "COPY abbrev (txt_long, txt_court) FROM stdin;"), (3, "\\."),
             (4, "COPY other (a, b) FROM stdin;"), (5, "no\tterm"), (6, "\\.")]
    parts = [brands.select("p_brand", F.lit(i).alias("i"), F.lit(text).alias("value")) for i, text in frame]
    path = scratch_dir(spark, "dump")
    # several brands share a file: it holds one block of the table after another
    (append(data, *parts).repartition(4, "p_brand").sortWithinPartitions("p_brand", "i").select("value").write.text(path))
    words = SR.read_copy_block(spark, path, "abbrev", ["txt_long", "txt_court"])
    labels = words.withColumn("label", F.concat("txt_long", F.lit(" OF "), "txt_long", F.lit("X")))
    return abbreviate_join(labels, "label", words.dropna(), rounds=1).select("txt_long", "txt_court", "label")


@query("producer_files", """
SELECT 'gz' AS part, CAST(c_custkey AS VARCHAR) AS a, c_name || ', é' AS b FROM customer
UNION ALL SELECT 'cog', right('0' || CAST(n_regionkey AS VARCHAR), 2) || right('00' || CAST(n_nationkey AS VARCHAR), 3), n_name || ' É' FROM nation
UNION ALL SELECT 'cog', '75056', 'PARIS'
UNION ALL SELECT 'decision', 'I' || CAST(c_custkey AS VARCHAR), CAST(CAST(c_custkey % 2 AS FLOAT) AS VARCHAR) FROM customer WHERE c_custkey % 3 > 0
UNION ALL SELECT 'history', CAST(c_custkey AS VARCHAR), 'fr:insee:' || CAST(c_nationkey AS VARCHAR) FROM customer
""")
def producer_files(spark, sf):
    """Gzip CSV of which two columns are read, the tab-separated ISO-8859-1 municipality list with
    extra rows, human decisions (those without one dropped), the history of municipalities."""
    c, n = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    base = scratch_dir(spark, "files")
    key = F.col("c_custkey").cast("string")
    wide = c.select(key.alias("id"), F.concat("c_name", F.lit(", é")).alias("name"), "c_mktsegment", "c_acctbal", "c_nationkey")
    wide.write.option("header", True).option("compression", "gzip").csv(f"{base}/wide")
    gz = SR.read_csv_table(spark, f"{base}/wide", ["id", "name", "segment", "balance", "nation"], sep=",").select(
        F.lit("gz").alias("part"), F.col("id").alias("a"), F.col("name").alias("b"))

    blank = F.lit("").cast("string")
    dep = F.right(F.concat(F.lit("0"), F.col("n_regionkey").cast("string")), F.lit(2))
    com = F.right(F.concat(F.lit("00"), F.col("n_nationkey").cast("string")), F.lit(3))
    cols = {"CDC": blank, "CHEFLIEU": blank, "REG": blank, "DEP": dep, "COM": com, "AR": blank, "CT": blank, "TNCC": blank,
            "ARTMAJ": blank, "NCC": blank, "ARTMIN": blank, "NCCENR": F.concat("n_name", F.lit(" É"))}
    (n.select(*[v.alias(k) for k, v in cols.items()]).write.option("header", True).option("sep", "\t")
     .option("encoding", "ISO-8859-1").csv(f"{base}/cog"))
    extra = spark.createDataFrame([("75056", "PARIS")], "insee string, NCCENR string")
    cog = SR.read_cog(spark, f"{base}/cog", extra).select(F.lit("cog").alias("part"), F.col("insee").alias("a"), F.col("NCCENR").alias("b"))

    app = F.when(F.col("c_custkey") % 3 > 0, (F.col("c_custkey") % 2).cast("string"))
    (c.select(key.alias("id_fantoir"), F.concat(F.lit("I"), key).alias("id_pseudo_fpb"), blank.alias("nom_maj"),
              blank.alias("nom_maj_fantoir"), blank.alias("court_ign"), blank.alias("court_fantoir"), app.alias("app"), blank.alias("comm"))
     .write.option("header", True).option("sep", ";").csv(f"{base}/decisions"))
    decisions = SR.read_decisions(spark, f"{base}/decisions").select(
        F.lit("decision").alias("part"), F.col("id_pseudo_fpb").alias("a"), F.col("app").cast("string").alias("b"))

    (c.select(key.alias("id"), key.alias("insee_code"), F.concat(F.lit("fr:insee:"), F.col("c_nationkey").cast("string")).alias("successors"),
              blank.alias("start_datetime"), blank.alias("end_datetime"), F.col("c_name").alias("name"))
     .write.option("header", True).csv(f"{base}/history"))
    history = SR.read_history(spark, f"{base}/history").select(F.lit("history").alias("part"), F.col("insee_code").alias("a"),
                                                              F.col("successors").alias("b"))
    return append(gz, cog, decisions, history)
