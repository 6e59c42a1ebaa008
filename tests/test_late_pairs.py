"""Groups of one pair, lists of ids by name, dictionaries that are sent to the rows."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from addrlink.functions import text as T
from addrlink.operators import fuzzy as Z
from addrlink.operators import relational as R
from addrlink.plans import q_relational as Q


def _distance(a, b):
    """As T31: in float32."""
    return float(np.float32(1) - np.float32(len(a & b) / len(a | b))) if a | b else 1.0


def test_near_sets_leaves_one_pair_only_where_there_is_one(monkeypatch):
    rng = random.Random(4)
    sets = [{rng.randint(0, 30) for _ in range(rng.randint(0, 12))} for _ in range(160)]
    others, groups = sets[:90], sets[60:]
    monkeypatch.setattr(Z, "ROWS", 16)
    monkeypatch.setattr(Z, "TERMS", 7)
    for limit in (0.4, 0.6, 0.8):
        got: dict[int, list] = {}
        for o, g, d in Z.near_sets([list(x) for x in others], [list(x) for x in groups], limit):
            assert abs(d - _distance(others[o], groups[g])) < 1e-6
            got.setdefault(g, []).append(o)
        for g, x in enumerate(groups):
            want = [o for o, y in enumerate(others) if _distance(x, y) < limit]
            found = got.get(g, [])
            assert len(set(found)) == len(found) >= min(len(want), 2) and set(found) <= set(want)


def test_trigram_groups_over_tiles(spark, monkeypatch):
    rng = random.Random(5)
    sets = [{rng.randint(0, 25) for _ in range(rng.randint(1, 10))} for _ in range(120)]
    rows = [(["a", "b"][i % 2], i, i, sorted(x)) for i, x in enumerate(sets)]
    l = spark.createDataFrame(rows, "block string, l1 long, l2 int, tri array<int>")
    r = spark.createDataFrame(rows[30:], "block string, r1 long, r2 int, tri array<int>")
    monkeypatch.setattr(Z, "TILE", 16)
    for side, mine, theirs in (("r", range(30, 120), range(120)), ("l", range(120), range(30, 120))):
        got: dict[int, set] = {}
        for x in Z.trigram_groups(l, r, 0.5, side).collect():
            g, o = (x["r1"], x["l1"]) if side == "r" else (x["l1"], x["r1"])
            got.setdefault(g, set()).add(o)
        for g in mine:
            want = {o for o in theirs if o % 2 == g % 2 and _distance(sets[o], sets[g]) < 0.5}
            assert got.get(g, set()) == want if len(want) < 2 else len(got[g]) >= 2 and got[g] <= want


def test_names_that_share_their_words_are_no_candidates_of_one_edit(spark):
    """1,500 names of one block with the same words: before, every pair of them met on the first half."""
    n = 1500
    df = spark.range(n).select(F.lit("b").alias("_b"), F.concat(F.lit("GRANDE RUE DE LA "), F.md5(F.col("id").cast("string")).substr(1, 8)).alias("_s"))
    rests = df.select("_b", F.explode(Z._rests(F.col("_s"))).alias("h"))
    assert rests.groupBy("_b", "h").count().agg(F.max("count")).first()[0] < 20
    pairs = Z.edit_id_pairs(df, df, 1)
    assert pairs.filter("levenshtein = 0").count() == n


def test_a_dictionary_made_of_rows_is_sent_to_the_labels(spark):
    df = spark.range(1000).select(F.concat(F.lit("RUE DE LA PAIX "), "id").alias("label"))
    terms = spark.createDataFrame([("RUE",), ("RUE DE",)], "t string")
    out = R.join_leading_term(df, "label", terms, "t", how="left")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert {r["t"] for r in out.collect()} == {"RUE DE"}


def test_linker_lists_ids_once_a_name(spark, tmp_path):
    rows = [(i, ["RED bolt", "bolt", "RED RED bolt", "old gear"][i % 4], "B1") for i in range(200)]
    rows += [(2, "bolt", "B1"), (2, "old gear", "B1"), (None, "bolt", "B1"), (4, None, "B1"), (6, "bolt", None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    out = Q.linker_2016(spark, str(tmp_path))
    want: dict = {}
    for pa, a, x in rows:
        for pb, b, y in rows:
            if None in (pa, pb, a, b, x, y) or pa % 2 or not pb % 2 or x != y:
                continue
            short = a.upper()[4:] if a.upper().startswith(("RED ", "BLUE ")) else a.upper()
            if b.upper() in (a.upper(), short) and a.upper().split()[-1] == b.upper().split()[-1]:
                want.setdefault(pa, set()).add(pb)
    assert {r["pa"]: (r["pb_max"], r["pb_list"]) for r in out.collect()} == {
        k: (max(v), ",".join(sorted(map(str, v)))) for k, v in want.items()}
    left = [op for op in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode(array_distinct" in op]
    assert len(left) == 1


def test_roman_rules_and_codes_on_odd_labels(spark):
    df = spark.createDataFrame([(" LOUIS XIV HENRI V XX",), ("XIV",), (" II II III",), (None,), ("",), (" CHARLES X GEORGES VI X",)], "s string")
    got = [r[0] for r in df.select(T.roman_to_arabic("s")).collect()]
    assert got == [" LOUIS 14 HENRI 5 20", "XIV", " 2 II 3", None, "", " CHARLES 10 GEORGES 6 X"]
    words = spark.createDataFrame([("rue de la paix rue",), ("A-b 9z",), ("",)], "s string")
    for r in words.select(F.size(T.trigrams("s")), F.size(T.trigram_codes("s"))).collect():
        assert r[0] == r[1]
