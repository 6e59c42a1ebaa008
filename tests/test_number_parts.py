"""House numbers by parts: the same table, and no join of a source reads the product of tax numbers and streets."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from addrlink.operators import relational as R
from addrlink.plans import housenumbers as H


def _rows(rng):
    some = lambda xs: rng.choice(xs)
    groups = [(some(["940010001", "940010002"]), some([f"I{i % 9}", None]), some([f"{i % 11:08d}", None]), some(["94001", "94002"]))
              for i in range(40)]
    tax = [(some(["940010001", "940010002", "940010009", None]), some(["1", "2", "3", None]), some(["", "BIS"]), some(["94100", None]),
            some(["a", "b", None])) for _ in range(60)]
    ign = [(some([f"E{i}", "E1", None]), some(["I1", "I2", "I3", "I8", "I99"]), some(["1", "2", "4"]), some(["", "BIS"]), "94001", "94300")
           for i in range(25)]
    postal = [(f"{rng.randint(0, 12):08d}", some(["1", "2", "5"]), some(["", "BIS"]), some([f"P{i}", "P1", None]), some(["94200", ""]),
               None) for i in range(25)]
    return groups, tax, ign, postal


def _expected(groups, tax, ign, postal):
    """The merge as the reference writes it: left joins one after the other, then what is missing."""
    best = {}
    for f, n, o, cp, d in tax:
        for g in set(groups):
            if f is not None and g[0] == f:
                k = (*g, n, o, cp)
                best[k] = max((x for x in (best.get(k), d) if x is not None), default=None)
    h = []
    for (f, i, v, c, n, o, cp) in best:
        hits = [x for x in ign if i is not None and x[1] == i and x[2] == n and x[3] == o]
        h += [(f, i, v, c, n, o, cp, x[0], x[5]) for x in hits] or [(f, i, v, c, n, o, cp, None, None)]
    seen = {r[7] for r in h}
    h += [(g[0], x[1], g[2], g[3], x[2], x[3], None, x[0], x[5]) for x in ign if x[0] is None or x[0] not in seen
          for g in groups if g[1] == x[1]]
    out = []
    for r in h:
        hits = [p for p in postal if r[2] is not None and (p[0], p[1], p[2]) == (r[2], r[4], r[5])]
        out += [(*r, p[3], p[4]) for p in hits] or [(*r, None, None)]
    seen = {r[9] for r in out}
    out += [(g[0], g[1], p[0], g[3], p[1], p[2], None, None, None, p[3], p[4]) for p in postal if p[3] is None or p[3] not in seen
            for g in groups if g[2] == p[0]]
    blank = lambda x: x in (None, "")
    pick = lambda *xs: next((x for x in xs if not blank(x)), xs[0])
    return Counter((*r[:6], r[7], r[9], pick(r[10], r[8], r[6])) for r in out)


def test_parts_give_the_reference_table(spark):
    for seed in range(3):
        groups, tax, ign, postal = _rows(random.Random(seed))
        g = spark.createDataFrame(groups, "id_fantoir string, id_pseudo_fpb string, co_voie string, code_insee string")
        t = spark.createDataFrame(tax, "fantoir string, number string, ordinal string, code_postal string, destination string")
        i = spark.createDataFrame(ign, "id string, id_pseudo_fpb string, numero string, rep string, code_insee string, code_post string")
        p = spark.createDataFrame(postal, "co_voie string, no_voie string, lb_ext string, co_cea string, co_postal string, lb_l5 string")
        hn = H.build_housenumbers(t, i, p, g).select("group_fantoir", "group_ign", "group_laposte", "code_insee", "number", "ordinal",
                                                     "ign", "laposte", "co_postal")
        assert Counter(map(tuple, hn.collect())) == _expected(groups, tax, ign, postal)
        n = H.number_parts(t, i, p, g)
        whole = R.append(n.found, n.bare)
        for got, key, name in zip(H.known_numbers(n), ("cia", "ign"), ("insee1", "insee2")):
            want = whole.filter(F.col(key) != "").groupBy(key).agg(F.max("code_insee").alias(name))
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_streets_of_one_tax_id_stay_out_of_the_joins(spark):
    """300 streets share a tax id of 50 numbers: the part that is joined holds the three rows of the sources only."""
    g = spark.range(300).select(F.lit("940010001").alias("id_fantoir"), F.concat(F.lit("I"), "id").alias("id_pseudo_fpb"),
                                F.lpad(F.col("id").cast("string"), 8, "0").alias("co_voie"), F.lit("94001").alias("code_insee"))
    t = spark.range(50).select(F.lit("940010001").alias("fantoir"), F.col("id").cast("string").alias("number"), F.lit("").alias("ordinal"),
                               F.lit("94100").alias("code_postal"), F.lit("a").alias("destination"))
    i = spark.createDataFrame([("E1", "I7", "3", "", "94001", "94300"), ("E2", "I8", "77", "", "94001", "94300")],
                              "id string, id_pseudo_fpb string, numero string, rep string, code_insee string, code_post string")
    p = spark.createDataFrame([("00000009", "4", "", "P1", "94200", None)],
                              "co_voie string, no_voie string, lb_ext string, co_cea string, co_postal string, lb_l5 string")
    n = H.number_parts(t, i, p, g)
    assert n.found.count() == 3 and n.bare.count() == 300 * 50 - 2


def test_join_known_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "b"), (5, "a")], "n int, k string")
    src = spark.createDataFrame([("a", 7)], "k string, v int")
    got = sorted((r["n"], r["v"]) for r in R.join_known(df, src, "k").collect())
    assert got == [(1, 7), (2, None), (3, None), (4, None), (5, 7)]
