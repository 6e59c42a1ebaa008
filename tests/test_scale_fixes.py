"""Surrogate ids over many partitions, dictionary tables, merged streets and their cadastre names."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from addrlink.functions import abbrev as A
from addrlink.operators import relational as R
from addrlink.plans.cascade_postal import cadastre_diagnostics, finish_groups, postal_sides
from addrlink.session import ensure_checkpoint_dir


def test_assign_ids_over_a_million_rows(spark):
    df = (spark.range(1_000_000, numPartitions=16).select(F.xxhash64("id").alias("k"), F.md5(F.col("id").cast("string")).alias("p"))
          .unionByName(spark.range(1000).select(F.lit(5).cast("long").alias("k"), F.lit("tie").alias("p"))))
    out = R.assign_ids(df, ["k"], "id").persist()
    r = out.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (1_001_000, 1_001_000, 1, 1_001_000)
    # ids follow the order: ranks of a sample agree with a count of smaller keys
    some = out.where("id % 250000 = 7").select("k", "id").collect()
    for x in some:
        below = out.where(F.col("k") < x["k"]).count()
        assert below < x["id"] <= below + 1001
    out.unpersist()


def test_join_leading_term(spark):
    df = spark.createDataFrame([(1, "RUE DE LA PAIX"), (2, "RUE"), (3, None), (4, "GRANDE RUE X"), (5, "GRANDE RUE X"), (6, "PLACE Y")],
                               "id long, label string")
    terms = spark.createDataFrame([("RUE",), ("GRANDE RUE",), ("RUE DE",), (None,), ("RUE",)], "t string")
    got = {r["id"]: r["t"] for r in R.join_leading_term(df, "label", terms, "t", how="left").collect()}
    assert got == {1: "RUE DE", 2: None, 3: None, 4: "GRANDE RUE", 5: "GRANDE RUE", 6: None}
    every = R.join_leading_term(df, "label", terms, "t", longest=False).collect()
    assert sorted((r["id"], r["t"]) for r in every) == [(1, "RUE"), (1, "RUE DE"), (4, "GRANDE RUE"), (5, "GRANDE RUE")]


@pytest.mark.parametrize("rounds", [1, 4])
def test_dictionary_table_gives_the_same_as_the_compiled_one(spark, rounds):
    rng = random.Random(3)
    words = [w for a, _ in A.SAMPLE_ABBREV for w in a.split()] + ["X1", "DE", "LA", "SAINTS", "ZONE", "É"]
    labels = ["".join(rng.choice(words) + rng.choice([" ", " ", "-", "'", ""]) for _ in range(rng.randint(0, 7))).strip()
              for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "id long, label string")
    table = spark.createDataFrame(A.SAMPLE_ABBREV + [(None, "Z"), ("", "Z")], "txt_long string, txt_court string")
    want = {r["id"]: r["o"] for r in df.select("id", A.abbreviate("label", A.sample_dictionary(), rounds).alias("o")).collect()}
    got = {r["id"]: r["label"] for r in A.abbreviate_join(df, "label", table, rounds=rounds).collect()}
    assert got == want


def _longest_first(label, rounds):
    for _ in range(rounds):
        hits = [(-len(a), m.start(), a, b) for a, b in A.SAMPLE_ABBREV for m in re.finditer(rf"\b{a}\b", label)]
        if hits:
            n, at, _, b = min(hits)
            label = label[:at] + b + label[at - n:]
    return label


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_the_longest_term_comes_first_wherever_it_stands(spark, rounds):
    rng = random.Random(8)
    words = [w for a, _ in A.SAMPLE_ABBREV for w in a.split()] + ["DE", "LA", "SAINTS", "ZONE", "ARTISANALE"]
    labels = [" ".join(rng.choices(words, k=rng.randint(0, 8))) for _ in range(300)] + ["GRAND CHEMIN RURAL", "RUE DU GRAND PLACE"]
    df = spark.createDataFrame(list(enumerate(labels)), "id long, label string")
    got = {r["id"]: r["o"] for r in df.select("id", A.abbreviate("label", A.sample_dictionary(), rounds).alias("o")).collect()}
    assert got == {i: _longest_first(x, rounds) for i, x in enumerate(labels)}
    table = spark.createDataFrame(A.SAMPLE_ABBREV, "txt_long string, txt_court string")
    assert got == {r["id"]: r["label"] for r in A.abbreviate_join(df, "label", table, rounds=rounds).collect()}


def test_a_large_dictionary_runs(spark):
    table = spark.range(30_000).select(F.concat(F.lit("TERM"), "id").alias("txt_long"), F.concat(F.lit("T"), "id").alias("txt_court"))
    df = spark.createDataFrame([(1, "A TERM29999 B TERM5")], "id long, label string")
    assert A.abbreviate_join(df, "label", table).first()["label"] == "A T29999 B T5"


GROUPS = ("gid string, id_fantoir string, id_pseudo_fpb string, code_insee string, nom_ign string, nom_maj_ign string,"
          " nom_maj_fantoir string, rule_ign string, id_poste string, nom_maj_ign_fantoir string")


def test_final_streets_and_cadastre(spark):
    g = spark.createDataFrame([
        ("F1", "940010001", "I1", "94001", "Enceinte Été", "EN ETE", "EN ETE", "M6", None, "EN ETE"),
        ("F2", "940010002", "I2", "94001", None, None, "RUE B", "M1", None, "RUE B"),    # IGN group without a name: dropped
        ("F3", "940010003", None, "94001", None, None, "RUE C", None, None, "RUE C"),
        ("F4", "940010004", None, "94001", None, None, "RUE D", None, None, "RUE D"),
        ("F5", "940010005", "I5", "94001", "", "", "RUE E", "M1", None, "RUE E")], GROUPS)  # blank name: dropped
    links = spark.createDataFrame([("00000009", "F4")], "lid string, rid string")
    ran = spark.createDataFrame([("00000009", "94001", "RUE DU D"), ("00000010", "94001", "RUE Z")],
                                "co_voie string, co_insee string, lb_voie string")
    cad = spark.createDataFrame([("9400100011", "En Été"), ("9400100031", "R C"), ("9400100041", "Rue du D"), ("9400100042", "Rue D"),
                                 ("9400100099", "Rue Q")], "fantoir string, libelle_voie string")
    fin = finish_groups(g, links, ran, cad)
    rows = {r["gid"]: r for r in fin.collect() if r["gid"]}
    assert set(rows) == {"F1", "F3", "F4"}
    assert rows["F1"]["nom_ign_retenu"] == "EN ETE" and rows["F3"]["nom_ign_retenu"] is None
    # the cadastre name is compared with the final name, which is the postal one for F4
    assert (rows["F4"]["nom_maj_fnal"], rows["F4"]["nom_cadastre"]) == ("RUE DU D", "Rue du D")
    assert rows["F1"]["nom_cadastre"] == "En Été" and rows["F3"]["nom_cadastre"] is None
    labels = spark.createDataFrame([("R C", "R C"), ("RUE C", "R C"), ("RUE D", "R D"), ("RUE DU D", "R D"), ("RUE Q", "R Q")],
                                   "long string, court string")
    d = {k: sorted(r["fantoir"] for r in v.collect()) for k, v in cadastre_diagnostics(cad, fin, labels).items()}
    assert d == {"same_short": ["9400100031", "9400100042"], "tax_only": ["9400100031"],
                 "unmatched": ["9400100031", "9400100042", "9400100099"]}


def test_postal_labels_come_from_the_tax_name_where_the_ign_has_none(spark):
    g = spark.createDataFrame([("F1", "940010001", None, "94001", None, None, "RUE C", None, None, "RUE C"),
                               ("F2", "940010002", "I2", "94001", "Rue B", "RUE B", "RUE BB", "M1", "9", "RUE B")], GROUPS)
    ran = spark.createDataFrame([("9", "94001", "RUE B")], "co_voie string, co_insee string, lb_voie string")
    labels = spark.createDataFrame([("RUE C", "RUE C"), ("RUE B", "RUE B")], "long string, court string")
    types = spark.createDataFrame([("RUE",)], "nom_court string")
    g = g.withColumn("nom_maj_ign_source", F.col("nom_maj_ign"))
    _, right = postal_sides(g, ran, labels, types)
    got = {r["rid"]: (r["court"], r["court_if"], r["t_if"], r["rest_if"]) for r in right.collect()}
    assert got == {"F1": (None, "RUE C", "RUE", "C"), "F2": ("RUE B", "RUE B", "RUE", "B")}


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
