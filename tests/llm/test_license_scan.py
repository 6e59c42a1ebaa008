import random

import pytest

from addrlink.llm import license_scan as s

CORPUS = ["some plain words of a text that says nothing", "the work is under the table and all of us are here"] * 20
LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "licensed under the APACHE license version 2.0": "apache", "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY 4.0": "cc-by", "All rights reserved.": "proprietary",
    "Copyright 2020 Me. All rights reserved.": "proprietary",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met:": "bsd",
    "He got his driving licence under the rules of public office.": None, "general public version source": None,
    "I reserved a table and all rights were wrong.": None, "": None,
}


@pytest.fixture(scope="module")
def model():
    return s.Model(CORPUS)


def test_families(spark, model):
    docs = spark.createDataFrame([(i, f"first line\n{x}\nlast line") for i, x in enumerate(LINES)], "doc_id long, text string")
    got = {r["doc_id"]: (r["family"], r["paragraph"], r["text"]) for r in s.scan(docs, model).where("confirmed").collect()}
    assert got == {i: (f, 1, x) for i, (x, f) in enumerate(LINES.items()) if f}


def test_anchors_lose_nothing(spark, model):
    """Whatever lacks every anchor keeps too few 2-grams of every template."""
    for corpus in (CORPUS, []):
        chosen = set(s.anchors(corpus))
        for _, _, two in s.templates():
            assert sum(not chosen & set(p.split()) for p in two) < s.CONFIRM * len(two)


def test_scores_match_brute_force(spark, model):
    rng = random.Random(1)
    loose = [w for ss in s.STATEMENTS.values() for x in ss for w in x.split()]
    texts = [" ".join(rng.choices(loose, k=rng.randint(1, 12))) for _ in range(150)] + [x for ss in s.STATEMENTS.values() for x in ss]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in s.scan(docs, model).collect()}
    at = {t: k for k, t in enumerate(model.terms)}
    for i, text in enumerate(texts):
        ws = s.words(text)
        if not set(ws) & set(model.anchors):
            assert i not in got
            continue
        z = model.bias + sum(model.weights[at[g]] for g in s.grams(ws) if g in at)
        p = s.np.exp(z - z.max())
        p /= p.sum()
        k = int(p[:-1].argmax())
        similar = max(len(two & s.pairs(ws)) / len(two) for f, _, two in s.templates() if f == s.FAMILIES[k])
        assert got[i]["probability"] == pytest.approx(p[k], abs=1e-6)
        assert (got[i]["similarity"] or 0) == pytest.approx(similar)
        assert got[i]["confirmed"] == (p[k] >= model.threshold and similar >= s.CONFIRM)


def test_odd_rows(spark, odd_docs, no_docs, odd_rows):
    assert s.scan(odd_docs).where("confirmed").count() == 0
    assert s.scan(no_docs).count() == 0
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(None, line), (1, line), (1, line), (2, ("x " * 20_000) + "\n" + line + "\n" + line)],
                                 "doc_id long, text string")
    rows = s.scan(docs).where("confirmed").collect()
    assert sorted((r["doc_id"] or 0, r["paragraph"]) for r in rows) == [(0, 0), (1, 0), (1, 0), (2, 1), (2, 2)]


def test_no_python_in_the_plan(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pattern = r"(?<![a-z0-9])(?:" + "|".join(model.anchors) + r")(?![a-z0-9])"
    for df in (s.lines_and_runs(docs, model.anchors, pattern), s.scan(docs, model)):  # before and behind the written lines
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


MIT = ["Permission is hereby granted, free of charge, to any person obtaining a copy",
       "of this software and associated documentation files, to deal in the",
       "Software without restriction, including without limitation the rights to use"]
BSD = ["Redistribution and use in source and binary forms, with or without",
       "modification, are permitted provided that the following conditions are met:"]


def test_statements_wrapped_over_lines(spark, model):
    texts = ["\n".join(["a title", "", *MIT, "", "some words"]), "\n".join(["before it", *BSD]),
             "\n".join(f" * {x}" for x in [*MIT, "", *BSD]), "\n".join(" ".join(BSD).split()),
             "\n\n".join(" ".join(BSD).split()), "Released under the MIT License.\n" + "\n".join(MIT)]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    rows = s.scan(docs, model).where("confirmed").collect()
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in rows)
    assert got == [(0, 2, "mit"), (0, 2, "mit"), (1, 1, "bsd"), (2, 0, "mit"), (2, 4, "bsd"), (3, 0, "bsd"),
                   (5, 0, "mit"), (5, 1, "mit")]
    assert {r["text"] for r in rows if r["doc_id"] == 0} == {"\n".join(MIT)}


def test_a_line_with_two_licences_gives_both(spark, model):
    lines = ["Licensed under the MIT license or the Apache License, Version 2.0", "Licensed under CC BY-NC 4.0",
             "Licensed under CC BY-SA 4.0", "Released under the MIT License. Licensed under CC BY-NC 4.0."]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["family"]) for r in s.scan(docs, model).where("confirmed").collect())
    assert got == [(0, "apache"), (0, "mit"), (1, "cc-by-nc"), (2, "cc-by"), (3, "cc-by-nc"), (3, "mit")]


def brute_runs(text, anchors):
    """Lines and runs with an anchor, from the text alone."""
    longest = max(len(s.words(x)) for ss in s.STATEMENTS.values() for x in ss)
    lines = text.split("\n")
    ws = [[w for w in s.re.split("[^a-z0-9]+", x.lower()) if w] for x in lines]
    out = []
    for i, first in enumerate(ws):
        if not first:
            continue
        end, more = i, []
        while end + 1 < len(ws) and ws[end + 1] and len(more) < longest:
            end += 1
            more += ws[end]
        for last, w in {(i, tuple(first)), (end, tuple(first + more))}:
            if set(w) & set(anchors):
                out.append((i, last, "\n".join(lines[i:last + 1]), " ".join(w)))
    return sorted(out)


def test_runs_match_brute_force(spark, model):
    rng = random.Random(6)
    some = [*MIT, *BSD, "", "", "x", "a b c", "All rights reserved.", "plain words of a text", " * licence", "Ünder the Lizenz"]
    texts = ["\n".join(rng.choices(some, k=rng.randint(1, 90))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pattern = r"(?<![a-z0-9])(?:" + "|".join(model.anchors) + r")(?![a-z0-9])"
    got = [(r["doc_id"], r["paragraph"], r["end"], r["text"], r["norm"])
           for r in s.lines_and_runs(docs, model.anchors, pattern).collect()]
    assert sorted(got) == sorted((i, *x) for i, t in enumerate(texts) for x in brute_runs(t, model.anchors)) and len(got) > 500


def test_a_text_of_many_lines(spark, model):
    lines = [f"line {i} of plain words that go on and on" for i in range(50_000)]
    text = "\n".join([*lines, "", *MIT, "", "Released under the MIT License."])
    docs = spark.createDataFrame([(1, text), (2, "\n".join(["Released under the MIT License."] * 3000))], "doc_id long, text string")
    got = sorted((r["doc_id"], r["paragraph"]) for r in s.scan(docs, model).where("confirmed").collect())
    assert got == [(1, 50_001), (1, 50_005), *[(2, i) for i in range(3000)]]
