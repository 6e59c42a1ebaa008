import random

import numpy as np
import pytest

from addrlink.llm import quality_classifier as c


def sample(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))]
        kind = rng.randrange(8)
        if kind == 0:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        elif kind == 1:
            words = [w.upper() + "!!" for w in words]
        elif kind == 2:
            words = [w for w in words[:5] for _ in range(12)]
        out.append((i, " ".join(words), int(kind > 2)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = sample(900, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_held_out_accuracy(tables):
    docs, labels, want = tables
    held = [r for r in c.classify(docs, labels).collect() if r["held_out"]]
    assert len(held) > 200
    assert np.mean([r["predicted"] == want[r["doc_id"]] for r in held]) >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in held)


def test_held_out_labels_are_not_learned_from(spark, tables):
    docs, labels, _ = tables
    scores = {r["doc_id"]: r["score"] for r in c.classify(docs, labels).collect()}
    held = c.fold_of(labels["doc_id"], 3) == 1
    turned = labels.withColumn("quality", c.F.when(held, 1 - labels["quality"]).otherwise(labels["quality"]))
    assert {r["doc_id"]: r["score"] for r in c.classify(docs, turned).collect()} == scores


def test_a_score_is_the_mean_of_the_words():
    rows = sample(300, 5)
    model = c.fit([(t, y) for _, t, y in rows])
    text = rows[0][1]
    total = []
    for w in c.words_of(text):
        (_, buckets), = c.subwords([w])
        total.append(model.push[buckets[0]].mean())
    want = 1 / (1 + np.exp(-(model.bias + np.mean(total))))
    assert model.score([text, ""]) == pytest.approx([want, 1 / (1 + np.exp(-model.bias))])


def test_subwords_do_not_depend_on_company():
    words = ["a", "été", "x" * 40, "the", "", c.SAME, "🙂🙂"]
    together = {w: b.tolist() for ws, m in c.subwords(words) for w, b in zip(ws, m)}
    for w in words:
        (_, m), = c.subwords([w])
        assert m[0].tolist() == together[w]


def test_odd_rows(spark, tables, odd_docs, odd_rows, no_docs):
    docs, labels, _ = tables
    rows = c.classify(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 13)}
    assert len(empty) == 1
    assert c.classify(no_docs, labels).count() == 0
    none = labels.where("doc_id < 0")
    assert {r["score"] for r in c.classify(odd_docs, none).collect()} == {0.5}
    one_label = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1)], "doc_id long, quality int")
    assert c.classify(odd_docs, one_label).count() == len(odd_rows)


def test_keep(tables):
    docs, labels, _ = tables
    model = c.train(docs, labels)
    scored = {r["doc_id"] for r in c.classify(docs, labels).where("predicted = 1").collect()}
    out = c.keep(docs.selectExpr("*", "1 as score"), model)
    assert out.columns == ["doc_id", "text", "score"] and {r["doc_id"] for r in out.collect()} == scored
