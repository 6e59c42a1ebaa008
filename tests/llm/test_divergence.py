import random
import re
from collections import Counter, defaultdict

from addrlink.llm import divergence as d

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=3, top=200):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    count, docs, out = defaultdict(Counter), defaultdict(Counter), []
    groups = {(lang, source) for _, lang, source in rows}
    for text, lang, source in rows:
        terms = [t.translate(UPPER) for t in TERM.findall(text)]
        count[lang, source].update(terms)
        count[lang, None].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in docs.items()}

    def shares(key):
        terms = kept.get(key[0], set())
        n = sum(count[key][t] for t in terms)
        return {t: 1 + 10**9 * (count[key][t] + 1) // (n + len(terms)) for t in terms}

    for lang, source in groups:
        p, q = shares((lang, source)), shares((lang, None))
        pair = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                r = shares((lang, other))
                pair.append((sum((p[t] - r[t]) ** 2 // r[t] for t in p), other))
        term = [((p[t] - q[t]) ** 2 // q[t], t) for t in p if count[lang, source][t] and p[t] > q[t]]
        for part, items, n in (("pair", pair, None), ("term", term, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(items[:n])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")


def test_same_as_brute_force(spark):
    rng = random.Random(3)
    words = [w + rng.choice(["", "é", "ß", "Ω", "𝒳"]) for w in "A b Cc dd EE f gg H ii j kk ll mm NN o".split()]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "S2", "é", "", None])
        ws = rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 30))
        rows.append((rng.choice([" ", "-", "\n", "_1 "]).join(ws), lang, source))
    assert got(d.audit(frame(spark, rows))) == brute(rows)


def test_ties_rank_in_utf8_order_and_stop_at_the_top(spark):
    """Far more terms of one value than ranks: the first by their bytes are chosen."""
    many = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)) + " ﬀ 𐀀"
    rows = [(many, "en", "a")] * 3 + [("other words here", "en", "b")] * 3
    out = got(d.audit(frame(spark, rows)))
    assert out == brute(rows) and sum(r[2] == "term" and r[1] == "a" for r in out) == 200
    assert got(d.audit(frame(spark, rows), top=3)) == brute(rows, top=3)


def test_counts_handed_on_early_are_the_same(spark):
    rows = [("a b c d e f g a a", "en", "x"), ("a b c", "en", "y"), ("a d e", "en", "x"), ("g g", "en", "y")] * 3
    sums = [sorted(tuple(r) for r in d.kept_terms(d.count_terms(frame(spark, rows).coalesce(1), held), 1).collect())
            for held in (1, 5, 1000)]
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) == 7 and ("en", "a", 15, [("x", 12), ("y", 3)]) in sums[0]


def test_odd_rows(spark, odd_docs, no_docs, odd_rows):
    rows = [(r[1], r[2], r[3]) for r in odd_rows]
    assert got(d.audit(odd_docs)) == brute(rows)
    assert d.audit(no_docs).collect() == []
    # no kept terms: pairs of value 0, in UTF-8 order
    rows = [("rare", "en", "b"), ("", "en", "a"), (None, "en", None)]
    assert got(d.audit(frame(spark, rows))) == [
        ("en", "", "pair", "a", 0, 1), ("en", "", "pair", "b", 0, 2), ("en", "a", "pair", "", 0, 1),
        ("en", "a", "pair", "b", 0, 2), ("en", "b", "pair", "", 0, 1), ("en", "b", "pair", "a", 0, 2)]


def test_sums_beyond_64_bits(spark):
    df = spark.range(1).selectExpr("cast(9000000000000 as bigint) as c", "cast(9000000000001 as bigint) as n", "7L as v")
    want = 1 + d.SCALE * (9000000000000 + 1) // (9000000000001 + 7)
    assert df.select(d.share(df.c, df.n, df.v)).first()[0] == want
