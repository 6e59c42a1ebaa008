import random
from collections import Counter

from addrlink.llm import langid

SYLLABLES = {"aa": "ba be bi bo ma me".split(), "bb": "stra kro gru pfe sch".split(), "cc": "xi xo yu zu qua".split()}


def texts(n, seed, syllables=SYLLABLES):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(12)]
        out.append((i, " ".join(words).capitalize() + ".", lang))
    return out


def test_held_out_accuracy(spark):
    rows = texts(600, 1)
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    got = langid.identify(docs).collect()
    held = [r for r in got if r["held_out"]]
    assert 60 < len(held) < 200
    want = {i: lang for i, _, lang in rows}
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_word_counts_match_brute_force(spark, monkeypatch):
    rows = texts(100, 2) + [(0, None, "aa"), (0, "x", None), (0, "It's 3 été́ x_y", "dd")]
    want = Counter()
    for _, t, lang in rows:
        if t is not None and lang is not None:
            for w in langid.LETTERS.findall(t.lower()):
                want[lang, w] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {(r["lang"], r["word"]): r["n"] for r in langid.word_counts(docs).collect()}
    assert got == want


def test_known_words_come_first_and_unseen_ones_back_off(spark):
    docs = spark.createDataFrame([(1, "abc abc", "x"), (2, "abd", "y"), (3, "zzz", "y")],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.langs == ["x", "y"]
    known, unseen, nothing = model.predict(["abc", "abdd", "qqq"])
    assert known[0] == "x"
    assert unseen[0] == "y"  # by its n-grams
    assert model.rows_of("qqq") == [] and nothing == ("x", 0.5)  # a tie: the first by name


def test_a_text_s_score_does_not_depend_on_its_batch(spark, monkeypatch):
    rows = texts(200, 4)
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    batch = [t + " neverseen été 5" for _, t, _ in rows] + ["", "7", "x-y z"]
    together = model.predict(batch)
    monkeypatch.setattr(langid, "KNOWN", 0)
    for t, (lang, score) in zip(batch, together):
        (own, s), = model.predict([t])
        assert own == lang and abs(s - score) < 1e-9


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3, 13, 12):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[4]["lang_pred"] in ("en", "fr")
    assert langid.identify(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", odd_docs["lang"].substr(1, 0)).where("doc_id = 13")
    assert [r["lang_pred"] for r in langid.identify(unlabelled).collect()] == ["und"]


def test_predict_keeps_other_columns(spark, odd_docs):
    model = langid.train(odd_docs)
    out = langid.predict(odd_docs, model)
    assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]


def test_scores_do_not_depend_on_how_much_is_broadcast(spark):
    rows = texts(300, 5) + [(None, None, "aa"), (1000, "", "aa"), (1001, "7 -", None), (1002, "qqq", None),
                            (1002, "Neverseen bababa x-y", None), (1003, "xixi\u0439\u0439 " + "xo" * 3000, None),
                            (1003, "a", None), (1004, "ß wwwww", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    trained = docs.where("doc_id % 5 > 0")
    whole = langid.train(trained)
    want = sorted(map(str, langid.predict(docs, whole).collect()))
    for n_words, n_ngrams in ((0, 0), (60, 40_000), (10 ** 6, 3)):
        part = langid.train(trained, n_words, n_ngrams)
        assert whole.whole and not part.whole and part.langs == whole.langs
        assert len(part.words) * 3 <= n_words
        got = langid.predict(docs, part)
        assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
        assert sorted(str(r) for r in got.collect()) == want


def test_a_rare_language_beside_a_hot_one_is_learned(spark):
    rng = random.Random(6)
    word = lambda syllables, n: "".join(rng.choice(syllables) for _ in range(n))
    hot = [(i, " ".join([word(SYLLABLES["aa"], 3)] * 3), "aa") for i in range(200)]
    rare = [(1000 + i, word(SYLLABLES["cc"], 4), "cc") for i in range(40)]
    docs = spark.createDataFrame(hot + rare, "doc_id long, text string, lang string")
    model = langid.train(docs, n_words=20)  # no word of the rare language is among the most frequent
    assert model.langs == ["aa", "cc"]
    assert not any(w in model.words for _, t, _ in rare for w in t.split())
    asked = rare + [(2000, word(SYLLABLES["cc"], 5), None)]
    got = langid.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string"), model).collect()
    assert {r["lang_pred"] for r in got} == {"cc"}


def test_ngrams_of_all_words_are_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    for word in ("a", "abcdefgh", "abcabcabcabcabcabcabc"):
        for k in range(1, 6):
            assert [g for p in langid.pieces(word, k) for g in p] == langid.ngrams(word, k)
    rows = spark.createDataFrame([("x", "abcab", 3), ("x", "bca", 2), ("y", "ab", 1)], "lang string, word string, n long")
    want = Counter()
    for lang, w, n in (("x", "abcab", 3), ("x", "bca", 2), ("y", "ab", 1)):
        for k in range(1, 6):
            for g in langid.ngrams(w, k):
                want[k, g, lang] += n
    assert {(r["k"], r["gram"], r["lang"]): r["n"] for r in langid.ngram_counts(rows).collect()} == want


def test_signs_that_are_no_letters(spark):
    """Fractions, raised and Roman numerals, circled numbers and bare marks: no letter, so no language."""
    rows = [(i, "the cat sat on the mat", "en") for i in range(20)] + [(100 + i, "le chat dort ici", "fr") for i in range(20)]
    signs = ["½", "²", "Ⅷ", "①", "\u0301", "½ ² Ⅷ ① 7 _ -", "٣"]
    docs = spark.createDataFrame(rows + [(1000 + i, t, "en") for i, t in enumerate(signs)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert {got[1000 + i] for i in range(len(signs))} == {"und"} and got[0] == "en" and got[100] == "fr"
    assert {r["word"] for r in langid.word_counts(docs).collect()} == set("the cat sat on mat le chat dort ici".split())
