"""Operator 8: licence scans with a trained paragraph classifier [native].

Paragraphs are the lines of a text and, for statements wrapped over lines, runs
of lines: from every line to the end of its block, or until the longest template
would fit behind the first line.  Of overlapping runs that state the same family
the one that begins where the statement does is returned, and none that holds a
line which states the family alone.  A sparse multinomial logistic regression
over word 1-grams and 2-grams of the known licence statements says which family
a paragraph states, or none: the class ``unknown`` is trained on paragraphs of
the corpus and on loose words of the statements, and the probability from which
a family counts is calibrated on held-out examples.  A prediction is confirmed
when the paragraph holds enough of the word 2-grams of one of the family's
templates.

A paragraph can only be confirmed if it holds one of the ``anchors``: words
chosen so that a template without them keeps too few 2-grams.  Texts and lines
without an anchor are left out by one pattern, which loses nothing.  Equal
paragraphs are scored once; the join back to the documents is an equi-join.

The model is trained on the driver, on ``SAMPLE`` corpus paragraphs at most;
scoring is DataFrame operations only.

A paragraph that states several licences gives a row for each: beside the
likeliest every family with a confirmed template that is likelier than none and
holds a 2-gram foreign to the better ones (CC BY is no part of CC BY-NC).

Cases: null and empty texts have no paragraphs; a text of any number of lines is
a row per line, of which the lines near an anchor are kept; of equal templates the first by name; repeated
rows are all returned; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

from .common import literal_rows

#: Corpus paragraphs that train the unknown class (first ones of the texts with the smallest hashes).
SAMPLE = 1500
#: Share of a template's word 2-grams that confirms it.
CONFIRM = 0.6
UNKNOWN = "unknown"

# fixed values: common statements of licences, by family
STATEMENTS = {
    "apache": ["Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License",
               "Unless required by applicable law or agreed to in writing, software distributed under the License"
               " is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "mit": ["Released under the MIT License", "Licensed under the MIT license", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files, to deal in the Software without restriction"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3",
            "GNU General Public License as published by the Free Software Foundation",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
            " General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met",
            "Use of this source code is governed by a BSD-style license", "Released under the BSD License"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
            "Licensed under the Mozilla Public License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                 "Licensed under CC BY-NC-SA 4.0"],
    "cc-by": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License",
              "Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "public-domain": ["This work is in the public domain", "Released into the public domain", "CC0 1.0 Universal"],
    "proprietary": ["All rights reserved", "Unauthorized copying of this file is strictly prohibited",
                    "Proprietary and confidential"],
}
FAMILIES = [*STATEMENTS, UNKNOWN]


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def grams(ws: list[str]) -> set[str]:
    return {*ws, *map(" ".join, zip(ws, ws[1:]))}


def pairs(ws: list[str]) -> set[str]:
    return {*map(" ".join, zip(ws, ws[1:]))}


def templates() -> list[tuple[str, str, set[str]]]:
    """Family, name and word 2-grams of every statement."""
    return [(f, f"{f}-{i}", pairs(words(s))) for f, ss in STATEMENTS.items() for i, s in enumerate(ss)]


def anchors(corpus: list[str], confirm: float = CONFIRM) -> list[str]:
    """Words without any of which no template keeps the share ``confirm`` of its 2-grams.

    That holds whatever is chosen; words that are rare in ``corpus`` are chosen first.
    """
    seen = Counter(w for p in corpus for w in set(words(p)))
    chosen: set[str] = set()
    for _, name, two in sorted(templates(), key=lambda t: (len(t[2]), t[1])):
        free = {p for p in two if not chosen & set(p.split())}
        while len(free) >= confirm * len(two):
            left = sorted({w for p in free for w in p.split()})
            word = min(left, key=lambda w: (seen[w], len(w) < 4, -sum(w in p.split() for p in free), w))
            chosen.add(word)
            free = {p for p in free if word not in p.split()}
    return sorted(chosen)


class Model:
    """Weights of the grams, biases and the calibrated threshold."""

    def __init__(self, corpus: list[str], seed: int = 5):
        rng = random.Random(seed)
        self.anchors = anchors(corpus)
        self.terms = sorted({g for ss in STATEMENTS.values() for s in ss for g in grams(words(s))})
        at = {t: i for i, t in enumerate(self.terms)}
        plain = [words(p) for p in corpus]
        filler = [w for ws in plain for w in ws[:50]] or ["lorem", "ipsum", "dolor", "sit"]
        known = templates()
        examples: list[tuple[list[str], int]] = []
        for k, (family, statements) in enumerate(STATEMENTS.items()):
            for s in statements:
                for n in range(24):
                    ws = words(s)
                    if n % 4 == 1:  # one word gone
                        ws.pop(rng.randrange(len(ws)))
                    if n % 4 == 2:  # two statements of one family
                        ws = ws + words(rng.choice(statements))
                    if n % 2:
                        ws = rng.choices(filler, k=rng.randint(0, 12)) + ws + rng.choices(filler, k=rng.randint(0, 12))
                    examples.append((ws, k))
        loose = [w for ss in STATEMENTS.values() for s in ss for w in words(s)]
        for ws in plain:  # corpus paragraphs that state no licence
            if not any(len(two & pairs(ws)) >= CONFIRM / 2 * len(two) for _, _, two in known):
                examples.append((ws, len(STATEMENTS)))
        for _ in range(600):  # words of statements without their order
            ws = rng.choices(loose, k=rng.randint(1, 6)) + rng.choices(filler, k=rng.randint(0, 30))
            rng.shuffle(ws)
            examples.append((ws, len(STATEMENTS)))
        x = np.zeros((len(examples), len(at)), np.float32)
        for i, (ws, _) in enumerate(examples):
            x[i, [at[g] for g in grams(ws) if g in at]] = 1
        y = np.array([k for _, k in examples])
        held = np.arange(len(y)) % 4 == 0
        self.weights, self.bias = self._fit(x[~held], np.eye(len(FAMILIES), dtype=np.float32)[y[~held]])
        z = x[held] @ self.weights + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best, right = p[:, :-1].max(axis=1), p[:, :-1].argmax(axis=1) == y[held]
        # the lowest probability from which at least 99 of 100 predictions are right
        order = np.argsort(-best)
        exact = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(exact >= 0.99)
        self.threshold = float(best[order][good[-1]]) if len(good) else 0.5

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 1.0, decay: float = 1e-4):
        w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        weight = (1 / np.maximum(y.sum(axis=0), 1)) @ y.T  # families count alike
        weight = (weight / weight.sum())[:, None]
        for _ in range(rounds):
            z = x @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - y) * weight
            w -= rate * (x.T @ error + decay * w)
            b -= rate * error.sum(axis=0)
        return w.astype(np.float64), b.astype(np.float64)


def has_anchor(text, anchored: str):
    return F.lower(text).rlike(anchored)


def words_column(text):
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def lines_and_runs(docs: DataFrame, anchored: list[str], pattern: str) -> DataFrame:
    """Lines, and runs of two lines or more, with an anchor: id, doc_id, paragraph (first line), end (last one), text, norm."""
    longest = max(len(words(s)) for ss in STATEMENTS.values() for s in ss)
    known = F.array(*map(F.lit, anchored))
    df = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("id"))
    df = df.where(has_anchor(F.col("text"), pattern))
    # one row per line from here on: a long text is many rows, never an array in each of them
    df = df.select("id", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line"))
    df = df.withColumn("w", words_column(F.col("line")))
    # every line of a block has a word, so a run has no more lines than words are needed
    of = Window.partitionBy("id").orderBy("paragraph")
    near = F.max(F.arrays_overlap("w", known)).over(of.rowsBetween(-longest, longest))
    df = df.withColumn("near", near).where("near")
    behind = F.collect_list(F.struct("paragraph", "w", "line")).over(of.rangeBetween(1, longest))
    df = df.withColumn("behind", behind).where("size(w) > 0")
    taken = F.expr(f"""aggregate(behind, named_struct('w', cast(array() as array<string>), 'n', 0, 'open', true),
        (a, x) -> case when a.open and x.paragraph = paragraph + a.n + 1 and size(x.w) > 0 and size(a.w) < {longest}
                  then named_struct('w', concat(a.w, x.w), 'n', a.n + 1, 'open', true)
                  else named_struct('w', a.w, 'n', a.n, 'open', false) end)""")
    df = df.withColumn("more", taken)
    one = F.struct(F.col("paragraph").alias("end"), F.col("w"), F.col("line").alias("text"))
    rest = F.array_join(F.expr("slice(behind.line, 1, more.n)"), "\n")
    run = F.struct(F.expr("paragraph + more.n").alias("end"), F.concat("w", "more.w").alias("w"),
                   F.concat("line", F.lit("\n"), rest).alias("text"))
    both = F.when(F.col("more.n") > 0, F.array(one, run)).otherwise(F.array(one))
    df = df.select("id", "doc_id", "paragraph", F.explode(both).alias("x")).where(F.arrays_overlap("x.w", known))
    return df.select("id", "doc_id", "paragraph", "x.end", "x.text", F.array_join("x.w", " ").alias("norm"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Lines with an anchor and confirmed runs: doc_id, paragraph, text, family, probability, template, similarity, confirmed."""
    spark = docs.sparkSession
    if model is None:
        hashed = docs.select("text", F.xxhash64("text").alias("h")).where("length(text) > 0")
        # hashes alone are ranked; only the chosen texts' first lines come to the driver
        last = hashed.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
        sample = sorted(hashed.where(F.col("h") <= F.lit(last)).select(
            F.slice(F.split("text", "\n", -1), 1, 2).alias("p")).distinct().collect())
        model = Model([p for r in sample for p in r["p"]][:SAMPLE])
    pattern = r"(?<![a-z0-9])(?:" + "|".join(model.anchors) + r")(?![a-z0-9])"
    # read twice below: written, so that every text is scanned once
    found = cut_lineage(lines_and_runs(docs, model.anchors, pattern))
    one = found.select("norm").distinct().withColumn("w", F.split("norm", " "))
    two = F.expr("zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (a, b) -> concat(a, ' ', b))")
    terms = one.select("norm", F.explode(F.array_distinct(F.concat("w", two))).alias("term"))
    # both tables are written into the plan: as long as the statements above
    weights = literal_rows(spark, [(t, [round(float(v), 9) for v in row]) for t, row in zip(model.terms, model.weights)],
                           "term:string,weights:array<double>")
    shapes = literal_rows(spark, [(p, f, name, len(ps)) for f, name, ps in templates() for p in sorted(ps)],
                          "term:string,family:string,template:string,pairs:int")
    n = len(FAMILIES)
    scored = (terms.join(F.broadcast(weights), "term").groupBy("norm")
              .agg(*[F.sum(F.col("weights")[k]).alias(f"z{k}") for k in range(n)]))
    z = F.array(*[F.col(f"z{k}") + float(model.bias[k]) for k in range(n)])
    scored = scored.select("norm", z.alias("z")).withColumn("top", F.array_max("z"))
    scored = scored.select("norm", F.transform("z", lambda v: F.exp(v - F.col("top"))).alias("e"))
    scored = scored.withColumn("e", F.transform("e", lambda v: v / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)))
    likely = F.slice("e", 1, n - 1)
    families = F.array(*map(F.lit, FAMILIES[:-1]))
    scored = scored.select("norm", "e", F.element_at(
        families, F.array_position(likely, F.array_max(likely)).cast("int")).alias("top"))
    alike = (terms.join(F.broadcast(shapes), "term").groupBy("norm", "family", "template")
             .agg((F.count("*") / F.max("pairs")).alias("similarity"), F.collect_list("term").alias("has"))
             .groupBy("norm", "family").agg(F.min_by(
                 F.struct("family", "similarity", "template", "has"), F.struct(-F.col("similarity"), "template")).alias("x"))
             .groupBy("norm").agg(F.collect_list("x").alias("all")))
    owned = F.create_map(*[x for f in STATEMENTS for x in (F.lit(f), F.array(*[
        F.lit(p) for p in sorted(set().union(*[ps for g, _, ps in templates() if g == f]))]))])
    better = lambda x, h: (h.family != x.family) & (
        (h.family == F.col("top")) | (h.similarity > x.similarity)
        | ((h.similarity == x.similarity) & (h.family < x.family)))
    judged = scored.join(alike, "norm", "left").withColumn("owned", owned)
    good = F.filter("all", lambda x: x.similarity >= CONFIRM)
    judged = judged.withColumn("good", F.coalesce(good, F.array().cast("array<struct<family:string,similarity:double,"
                                                                     "template:string,has:array<string>>>")))
    others = F.filter("good", lambda x: (x.family != F.col("top")) & (F.size(F.aggregate(
        F.filter("good", lambda h: better(x, h)), x.has,
        lambda left, h: F.array_except(left, F.col("owned")[h.family]))) > 0))
    judged = judged.withColumn("family", F.explode(F.concat(F.array("top"), F.transform(others, lambda x: x.family))))
    judged = judged.withColumn("probability", F.col("e")[F.array_position(families, F.col("family")).cast("int") - 1])
    mine = F.filter("all", lambda x: x.family == F.col("family"))
    judged = judged.select("norm", "family", "probability", F.get(mine, F.lit(0)).alias("x"), F.when(
        F.col("family") == F.col("top"), F.col("probability")).otherwise(  # of one family or none
            F.col("probability") / (F.col("probability") + F.col("e")[n - 1])).alias("sure"),
        (F.col("family") == F.col("top")).alias("likeliest"))
    judged = judged.select("norm", "family", "probability", "x.similarity", "x.template", "likeliest", (
        (F.col("sure") >= model.threshold) & (F.coalesce("x.similarity", F.lit(0.0)) >= CONFIRM)).alias("confirmed"))
    df = found.join(judged, "norm", "left").withColumn("line", F.col("end") == F.col("paragraph"))
    df = df.where(F.col("confirmed") | (F.col("line") & F.coalesce("likeliest", F.lit(True))))
    # runs: without a line that states the family alone, and of overlapping ones the best
    of = Window.partitionBy("id", "family").orderBy("paragraph")
    alone = F.min(F.when(F.col("line") & F.col("confirmed"), F.col("paragraph"))).over(of.rangeBetween(0, Window.unboundedFollowing))
    df = df.withColumn("alone", alone).where("line or alone is null or alone > end")
    of = Window.partitionBy("id", "family", "line").orderBy("paragraph")
    for name, step in (("before", F.lag), ("after", F.lead)):
        df = df.withColumn(name, F.when(step("paragraph").over(of) == F.col("paragraph") + (1 if name == "after" else -1),
                                        step("similarity").over(of)))
    df = df.where("line or (coalesce(before, 0) <= similarity and coalesce(after, 0) < similarity)")
    return df.select(
        "doc_id", "paragraph", "text",
        F.when(F.col("confirmed"), F.col("family")).otherwise(F.lit(UNKNOWN)).alias("family"),
        "probability", "template", "similarity", F.coalesce("confirmed", F.lit(False)).alias("confirmed"))
