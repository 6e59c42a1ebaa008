"""Worked examples of the reference (FIXTURES.md A.2) as unit fixtures for T*/X*."""

from pyspark.sql import functions as F

from addrlink.functions import text as T
from addrlink.plans.labels import build_labels, with_short_label


def ev(spark, expr, value):
    return spark.range(1).select(expr(F.lit(value)).alias("x")).first()["x"]


def test_punctuation_and_upper(spark):
    assert ev(spark, T.nom_maj, "Rue de l'Église") == "RUE DE L EGLISE"
    assert ev(spark, T.squeeze_punct, "A ' - B--C") == "A B C"
    assert ev(spark, T.unaccent_upper, "cœur straße") == "COEUR STRASSE"
    assert ev(spark, T.glue_apostrophe, "L'  ' EGLISE") == "L'EGLISE"


def test_articles_and_prefixes(spark):
    assert ev(spark, T.drop_articles, "LE CHEMIN DE LA MARE") == "CHEMIN MARE"
    assert ev(spark, T.drop_place_prefix, "LIEU DIT LES CHAMPS") == "LES CHAMPS"
    assert ev(spark, T.keep_alnum, "RUE-DU  8 MAI*") == "RUE DU 8 MAI "


def test_repeat_digits_zero(spark):
    assert ev(spark, T.halve_repeat, "AB AB") == "AB"
    assert ev(spark, T.halve_repeat, "AB/AB") == "AB"
    assert ev(spark, T.halve_repeat, "AB AC") == "AB AC"
    assert ev(spark, T.split_digits, "RUE12B") == "RUE 12 B"
    assert ev(spark, T.split_digits, "A1B2C3") == "A 1 B2C3"  # first match only, each direction
    assert ev(spark, T.zero_to_o, "C0L0NNE") == "COLONNE"  # 0N fires before L0
    assert ev(spark, T.zero_to_o, "VAL0T") == "VAL T"


def test_roman_dates_ordinals(spark):
    assert ev(spark, T.roman_to_arabic, "RUE LOUIS XIV") == "RUE LOUIS 14"
    assert ev(spark, T.roman_to_arabic, "RUE HENRI V") == "RUE HENRI 5"
    assert ev(spark, T.roman_to_arabic, "RUE X") == "RUE X"
    assert ev(spark, T.normalise_dates, "RUE PREMIER MAI") == "RUE 1 MAI"
    assert ev(spark, T.normalise_dates, "RUE DU 11 NOVEMBRE 1918") == "RUE DU 11 NOV"
    assert ev(spark, T.ordinal_1_2, "RUE 2 EME DB") == "RUE 2E DB"
    assert ev(spark, T.apply_ordinals, "RUE VINGT QUATRIEME") == "RUE 24E"
    assert ev(spark, T.apply_ordinals, "RUE 12 EME") == "RUE 12E"
    assert ev(spark, T.singular_numbers, "RUE QUATRES CHEMINS") == "RUE QUATRE CHEMINS"
    assert len(T.ordinal_words()) == 1600


def test_hamlet_scraps_roads(spark):
    df = spark.createDataFrame([("JEAN HAMEAU", "JEAN HAMEAU"), ("BOIS HAMEAU", "BOIS HAMEAU")], "c string, l string")
    got = [r[0] for r in df.select(T.drop_hamlet("c", "l")).collect()]
    assert got == ["JEAN HAMEAU", "BOIS"]
    assert ev(spark, T.fix_scraps, "GD RUE") == "GR"
    assert ev(spark, T.fix_scraps, "ZA ZA") == "ZA"
    assert ev(spark, T.fix_scraps, "R VERDUN") == "RUE VERDUN"
    assert ev(spark, T.dept_road, "CHEMIN DEPARTEMENTAL N 12") == "CD 12"
    assert ev(spark, T.breton_ch, "KERC H") == "KERCH"


def test_keys(spark):
    row = spark.range(1).select(*T.split_number(F.lit("12 bis")), *T.split_number(F.lit("12")),
                                T.cia(F.lit("940011234"), F.lit("12"), F.lit("bis")),
                                T.pad8(F.lit("4377322")), T.strip_zeros(F.lit("0012")),
                                T.source_list((F.lit(True), "DGFIP"), (F.lit(False), "IGN"),
                                              (F.lit(True), "LAPOSTE"))).first()
    assert tuple(row) == ("12", "BIS", "12", "", "94001_1234_12_BIS", "04377322", "12", "DGFIP|LAPOSTE")


def test_similarity_float32(spark):
    d = ev(spark, lambda c: T.trigram_distance(c, F.lit("PL ROBERT SCHUMAN")), "PL ROBERT SCHUMANN")
    assert abs(d - 0.14999998) < 1e-7 and d < 0.15
    assert ev(spark, lambda c: T.trigram_distance(c, F.lit("RUE BAS VERCRAZ")), "RUE VERCRAZ BAS") == 0.0
    assert ev(spark, lambda c: F.levenshtein(c, F.lit("BREDEVENT")), "BREDEVANT") == 1
    assert ev(spark, lambda c: F.levenshtein(c, F.lit("CLOSEL CLARITIERE")), "CLOSAL CLARITIERES") == 2
    assert ev(spark, lambda c: T.edit_within(c, F.lit("BREDEVENT"), 2), "BREDEVANT") is True


def test_title_case_and_paren(spark):
    assert ev(spark, T.title_case, "rue de l'église") == "Rue De L'Église"
    assert ev(spark, lambda c: T.upper_romans(T.title_case(c)), "rue louis xiv") == "Rue Louis XIV"
    assert ev(spark, T.paren_name, "SAINT JEAN (LE BOURG)") == "LE BOURG"
    assert ev(spark, T.without_paren, "SAINT JEAN (LE BOURG)") == "SAINT JEAN"
    assert ev(spark, T.last_word, "RUE DU MOULIN") == "MOULIN"


def test_rename_rules_first_match(spark):
    rules = [("RUE ", "R "), ("R", "X")]
    assert ev(spark, lambda c: T.first_rule(c, rules), "RUE DU RUISSEAU ") == "R DU RUISSEAU"
    assert ev(spark, lambda c: T.first_rule(c, rules), "ROUTE") == "XOUTE"
    assert ev(spark, lambda c: T.first_rule(c, rules), "AVENUE") == "AVENUE"


def test_label_chain(spark):
    df = spark.createDataFrame([("AVENUE DU GENERAL DE GAULLE",), ("ROUTE DEPARTEMENTALE 12",),
                                ("LIEU DIT LES CHAMPS",), ("RUE DU 11 NOVEMBRE 1918",)], "long string")
    got = {r.long: r.court for r in with_short_label(df).collect()}
    assert got["AVENUE DU GENERAL DE GAULLE"] == "AV GAL GAULLE"
    assert got["ROUTE DEPARTEMENTALE 12"] == "CD 12"
    assert got["LIEU DIT LES CHAMPS"] == "CHAMPS"
    assert got["RUE DU 11 NOVEMBRE 1918"] == "RUE 11 NOV"
    labels = build_labels(df.select("long"), df.select(F.lit("").alias("long")))
    assert labels.count() == 4 and "tri" in labels.columns
