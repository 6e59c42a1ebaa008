"""Relational operators and similarity joins (J*, A*, W*), incl. brute-force checks."""

import itertools
import random

from pyspark.sql import functions as F

from addrlink.functions import text as T
from addrlink.operators import relational as R
from addrlink.operators.fuzzy import levenshtein_join, trigram_join


def test_one_to_one_rule(spark):
    # one/one linked, two/one and one/two not (the reference's comment example)
    pairs = spark.createDataFrame([("A", "EGLISE", "f1", "i1"), ("A", "MAIRIE", "f2", "i2"),
                                   ("A", "MAIRIE", "f3", "i2"), ("A", "PORT", "f4", "i4"),
                                   ("A", "PORT", "f4", "i5")], "b string, k string, f string, i string")
    out = R.one_to_one(pairs, ["b", "k"], {"f": F.max("f"), "i": F.max("i")})
    assert sorted(tuple(r) for r in out.collect()) == [("A", "EGLISE", "f1", "i1")]


def test_drop_ambiguous_and_multi_key(spark):
    df = spark.createDataFrame([("f1", "i1"), ("f1", "i2"), ("f2", "i3")], "f string, i string")
    assert [r.f for r in R.drop_ambiguous(df, "f").collect()] == ["f2"]
    assert sorted(r.i for r in R.multi_key_rows(df, "f").collect()) == ["i1", "i2"]


def test_first_per_key_multi_postcode(spark):
    df = spark.createDataFrame([("04377322", "66100"), ("04377322", "66000")], "co_voie string, cp string")
    got = R.one_per_key(df, "co_voie", [F.col("cp")]).collect()
    assert [(r.co_voie, r.cp) for r in got] == [("04377322", "66000")]


def test_update_from_and_unmatched(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    s = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (3, "z", 5)], "k int, v string, o int")
    out = {r.k: r.v for r in R.update_from(t, s, "k", {"v": "v"}, order=[F.col("o")]).collect()}
    assert out == {1: "y", 2: "b", 3: "z"}
    links = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r.k for r in R.unmatched(t, links, "k").collect()) == [2, 3]


def test_leading_term_join(spark):
    labels = spark.createDataFrame([("AV DES ACCACIAS",), ("AVENUE DES ACCACIAS",), ("LOT LES PINS",),
                                    ("CLOS MONTMAJOUR",)], "label string")
    terms = spark.createDataFrame([("AV",), ("AVENUE",), ("LOT",), ("AVENUE DES",)], "t string")
    got = {r.label: r.t for r in R.join_leading_term(labels, "label", terms, "t", how="left").collect()}
    assert got == {"AV DES ACCACIAS": "AV", "AVENUE DES ACCACIAS": "AVENUE DES", "LOT LES PINS": "LOT",
                   "CLOS MONTMAJOUR": None}


def test_stack_heads(spark):
    df = spark.createDataFrame([("a", "1", "", "s"), ("b", "1", "", "s"), ("c", "1", "", "s"),
                                ("d", "2", "", "s"), ("e", None, "", "s"), ("f", None, "", "s")],
                               "id string, n string, rep string, st string")
    out = {r.id: (r.id_hn, r.is_head) for r in R.stack_heads(df, ["n", "rep", "st"], ["id"]).collect()}
    assert out["a"] == ("a", True) and out["b"] == ("a", False) and out["c"] == ("a", False)
    assert out["d"] == ("d", True)
    # NULL stack key: the head points to itself, the other member gets no head
    assert out["e"] == ("e", True) and out["f"] == (None, False)


def test_assign_ids_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    ids = R.assign_ids(df, ["k"]).orderBy("k").collect()
    assert [r.id for r in ids] == list(range(1, 1001))


def _rand_labels(rng, n, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def _brute_trigram(L, R_, t, spark):
    rows = []
    for (b1, l), (b2, r) in itertools.product(L, R_):
        if b1 == b2:
            rows.append((b1, l, r))
    df = spark.createDataFrame(rows, "b string, l string, r string")
    d = T.trigram_distance("l", "r")
    return {(x.b, x.l, x.r) for x in df.filter(d < t).collect()}


def test_trigram_join_matches_brute_force(spark):
    rng = random.Random(7)
    words = ["RUE", "CHEMIN", "MOULIN", "MOULINS", "EGLISE", "PLACE", "SCHUMAN", "SCHUMANN", "ROBERT", "PL", "BAS"]
    L = [(rng.choice("AB"), s) for s in _rand_labels(rng, 60, words)]
    Rr = [(rng.choice("AB"), s) for s in _rand_labels(rng, 60, words)]
    L, Rr = sorted(set(L)), sorted(set(Rr))
    ldf = spark.createDataFrame(L, "b string, l string").withColumn("tri", T.trigrams("l"))
    rdf = spark.createDataFrame(Rr, "b string, r string").withColumn("tri", T.trigrams("r"))
    for t in (0.15, 0.4):
        got = {(x.b, x.l, x.r) for x in trigram_join(ldf, rdf, "b", "l", "r", "tri", "tri", t).collect()}
        assert got == _brute_trigram(L, Rr, t, spark)


def test_levenshtein_join_matches_brute_force(spark):
    rng = random.Random(11)
    alphabet = "ABCE "
    def word():
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))).strip() or "A"
    L = sorted({(rng.choice("XY"), word()) for _ in range(150)})
    Rr = sorted({(rng.choice("XY"), word()) for _ in range(150)})
    ldf = spark.createDataFrame(L, "b string, l string")
    rdf = spark.createDataFrame(Rr, "b string, r string")
    for k in (2, 3):
        got = {(x.b, x.l, x.r) for x in levenshtein_join(ldf, rdf, "b", "l", "r", "l", "r", k).collect()}
        rows = [(b1, l, r) for (b1, l), (b2, r) in itertools.product(L, Rr) if b1 == b2]
        bf = spark.createDataFrame(rows, "b string, l string, r string")
        want = {(x.b, x.l, x.r) for x in bf.filter(F.levenshtein("l", "r") < k).collect()}
        assert got == want


def test_hot_block_is_not_all_pairs(spark):
    """One block holding every row: candidates stay far below the block product."""
    rng = random.Random(3)
    words = [f"W{i:03d}" for i in range(300)]
    L = sorted({("HOT", " ".join(rng.sample(words, 3))) for _ in range(400)})
    ldf = spark.createDataFrame(L, "b string, l string").withColumn("tri", T.trigrams("l"))
    rdf = ldf.withColumnRenamed("l", "r")
    out = trigram_join(ldf, rdf, "b", "l", "r", "tri", "tri", 0.15)
    got = {(x.l, x.r) for x in out.collect()}
    assert {(s, s) for _, s in L} <= got
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_queries_register_without_a_session():
    """The entry's dictionaries are made before there is a Spark session."""
    import subprocess
    import sys
    from pathlib import Path
    root = str(Path(__file__).parents[1])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
