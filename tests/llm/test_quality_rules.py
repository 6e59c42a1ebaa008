import re
from collections import Counter

from addrlink.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    twice = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(twice))


def test_counts_match_brute_force(odd_docs):
    for r in q.judge(odd_docs).join(odd_docs.select("doc_id", "text"), "doc_id").collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == brute(r["text"]), r["doc_id"]
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["kept"] and r["base_failed"])


def test_all_rows_come_back_and_keep_drops_the_rejected(odd_docs, odd_rows):
    judged = q.judge(odd_docs).collect()
    assert len(judged) == len(odd_rows)
    kept = Counter(r["doc_id"] for r in judged if r["kept"])
    out = q.keep(odd_docs)
    assert out.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == kept
    assert kept[4] == 2


def test_empty_table(no_docs):
    assert q.judge(no_docs).count() == 0
    assert q.keep(no_docs).count() == 0


def test_thresholds_follow_the_group(spark):
    """One source writes with many symbols; its own threshold lets it pass, an outlier elsewhere goes."""
    words = [f"w{i}" for i in range(100)]
    plain = [(i, " ".join(words) + f" {i}", "en", "plain") for i in range(300)]
    noisy = [(1000 + i, " ".join(w + "$" * (k % 3) for k, w in enumerate(words)) + f" {i}", "en", "code")
             for i in range(300)]
    odd = [(5000, " ".join(w + "$" for w in words), "en", "plain")]
    docs = spark.createDataFrame(plain + noisy + odd, "doc_id long, text string, lang string, source string")
    rejected = {r["doc_id"]: r["broken"] for r in q.judge(docs).where("not kept").collect()}
    assert rejected == {5000: ["symbol_share"]}


def test_small_groups_take_the_limits_of_their_language(spark):
    words = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(i, f"{words} {i}", "en", f"s{i % 50}") for i in range(300)]
                                 + [(900, words.replace("w", "$w"), "en", "new")],
                                 "doc_id long, text string, lang string, source string")
    assert [r["doc_id"] for r in q.judge(docs).where("not kept").collect()] == [900]
    measured = q.add_measures(q.add_counts(docs))
    limits = q.thresholds(q.sketch(measured)).where("source = 'new'").first()
    assert limits["max_symbol_share"] == 200  # of the language: q75 0, spread 50, fence 4


def test_no_python_in_the_plan(odd_docs):
    plan = q.judge(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
