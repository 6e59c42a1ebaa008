"""Preparation (D*) and audit (R*) operators on small fixtures."""

from pyspark.sql import functions as F

from addrlink.plans import audit as A
from addrlink.plans import prepare as P

TYPES = [("AV", "AVENUE", "avenue", "way", "AV"), ("LOT", "LOTISSEMENT", "lotissement", "area", "LOT"),
         ("RUE", "RUE", "rue", "way", "R")]


def _types(spark):
    return spark.createDataFrame(TYPES, "nom_court string, nom_long string, nom_min string, kind string, code string")


def test_drop_repeated_type_four_forms(spark):
    df = spark.createDataFrame([("AV", "AV DES ACCACIAS"), ("AV", "AVENUE DES ACCACIAS"),
                                ("AVENUE", "AVENUE DES ACCACIAS"), ("AVENUE", "AV DES ACCACIAS"),
                                ("LOT", "CLOS MONTMAJOUR")], "t string, label string")
    out = sorted((r.t, r.label) for r in P.drop_repeated_type(df, "t", "label", _types(spark)).collect())
    assert out == sorted([("", "AV DES ACCACIAS"), ("", "AVENUE DES ACCACIAS"), ("", "AVENUE DES ACCACIAS"),
                          ("", "AV DES ACCACIAS"), ("LOT", "CLOS MONTMAJOUR")])


def test_street_kind(spark):
    df = spark.createDataFrame([("RUE DU PORT",), ("LOTISSEMENT LES PINS",), ("D 12 X",), ("BOIS JOLI",)], "label string")
    got = {r.label: r.kind for r in P.street_kind(df, "label", _types(spark)).collect()}
    assert got == {"RUE DU PORT": "way", "LOTISSEMENT LES PINS": "area", "D 12 X": "way", "BOIS JOLI": "area"}


def test_redirect_and_names(spark):
    df = spark.createDataFrame([("14001",), ("14543",), ("75056",)], "code string")
    fusion = spark.createDataFrame([("14001", "14100", "2016-01-01"), ("14001", "14200", "2017-01-01"),
                                    ("14543", "14543", "2016-01-01")], "insee_old string, insee_new string, date string")
    cur = spark.createDataFrame([("14543",), ("75056",), ("14200",)], "insee string")
    got = {r.code for r in P.redirect_insee(df, "code", fusion, cur).collect()}
    assert got == {"14200", "14543", "75056"}
    m = spark.createDataFrame([("(L')", "Abergement")], "ARTMIN string, NCCENR string")
    assert m.select(P.municipality_name()).first()[0] == "L'Abergement"


def test_redirects_and_unabbreviate(spark):
    f = spark.createDataFrame([
        ("940010001", "94001", "RUE DU MOULIN", "2015001", "0000000", "MOULIN"),
        ("940010002", "94001", "RUE DU VIEUX MOULIN", "0000000", "2015001", "MOULIN"),
        ("940010003", "94001", "RUE BASSE", "0000000", "2010001", "BASSE")],
        "fantoir string, code_insee string, libelle_voie string, date_annul string, date_creation string, dernier_mot string")
    assert [(r.old, r.new) for r in P.street_redirects(f).collect()] == [("940010001", "940010002")]
    h = spark.createDataFrame([("x", "14001", "successors:14200@2016", None, None, "n")],
                              "id string, insee_code string, successors string, start_datetime string, "
                              "end_datetime string, name string")
    assert [(r.old, r.new) for r in P.municipality_redirects(h).collect()] == [("14001", "14200")]
    rules = spark.createDataFrame([(1, "AV", ["AV", "AVENUE"], False, "Avenue"), (2, "GR", ["GDE RUE"], True, "Grande Rue"),
                                   (3, "GR", ["SCO", "SCOLAIRE"], True, "Groupe Scolaire")],
                                  "rank int, lead string, repeats array<string>, required boolean, shown string")
    want = {"AV L ABBE ST PIERRE": "Avenue l'ABBE Saint-PIERRE", "AV AVENUE D HIVER": "Avenue d'HIVER", "GR SCOLAIRE X": "Groupe Scolaire X",
            "GR GDE RUE": "Grande Rue", "GR X": "GR X", "AVAL": "AVAL", "CE QU ON DIT": "CE qu'ON DIT", "AV AVENUES": "Avenue AVENUES"}
    df = spark.createDataFrame([(x,) for x in [*want, None]], "l string")
    assert {r.l: r.display for r in P.unabbreviate(df, "l", rules).collect()} == want | {None: None}


def test_audit_checks(spark):
    src = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, name string, kind string")
    dst = spark.createDataFrame([(1, "a", "x"), (2, "B", None)], "id int, name string, kind string")
    assert [r.id for r in A.lost_rows(src, dst, "id").collect()] == [3]
    mm = {r.check_name: r.n for r in A.mismatch(src, dst, "id", {"name": "name", "kind": "kind"}).collect()}
    assert mm == {"R3 name": 1, "R3 kind": 1}
    out = A.audit(A.count_check("groups", src, dst), A.frequency(dst, "kind"),
                  A.coherence(dst, {"kind set": F.col("kind").isNotNull()}))
    got = {(r.check_name, r.k): r.n for r in out.collect()}
    assert got[("groups source", "")] == 3 and got[("groups result", "")] == 2
    assert got[("R5 kind set", "")] == 1 and got[("R6 kind", "∅")] == 1
    assert [r.id for r in A.refound(src.filter("id = 3"), src, ["kind"]).collect()] == [3]
    assert A.ordinal_mismatch(src, dst, "id", "kind").count() == 1
    assert [r.id for r in A.bad_foreign_ids(src, dst, "id", "id").collect()] == [3]
    t = {"municipality": spark.createDataFrame([(1, "90001"), (2, "75056")], "pk int, insee string"),
         "group": spark.createDataFrame([(10, 1), (20, 2)], "pk int, municipality_id int"),
         "housenumber": spark.createDataFrame([(100, 10), (200, 20)], "pk int, parent_id int"),
         "position": spark.createDataFrame([(1000, 100), (2000, 200)], "pk int, housenumber_id int")}
    r = A.restrict_department(t, "90")
    assert [x.pk for x in r["position"].collect()] == [1000]
