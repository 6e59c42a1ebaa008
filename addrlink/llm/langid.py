"""Operator 10: language identification, words first, then shorter n-grams.

Training counts the words of every language over all training rows: each task
counts its own rows, then counts are added by (language, word).  All of these
words are the dictionary; the n-gram tables count the character n-grams of all
of them.  A known word scores by its log frequency in every language; an unseen
word by the mean log frequency of its longest n-grams that are known, trying
shorter and shorter ones.

The tables grow with the corpus and stay in Spark.  The most frequent words are
broadcast with the scores that the whole tables give them; the other words of
the texts are joined with the whole tables.  How many are broadcast decides
nothing: scores are whole numbers (``SCALE`` to the unit), so sums are equal.

Words are runs of letters, lower-cased.  Texts are cut at white space and the
scores of a cut are kept in a dictionary of bounded size, which saves time and
decides nothing.

Cases: null texts and texts without a letter are ``und`` with score 0, and so
is every text if no training row has a language; rows with a null language or
text are not learned from; of equally likely languages the first by name wins;
repeated rows are all returned; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from addrlink.session import cut_lineage

from .common import fold_of, spare, text_parts

#: Scores (words times languages) that are broadcast at most; n-grams, if a length has no more.
WORDS = 800_000
NGRAMS = 40_000
#: The longest n-gram, and the steps of a score to the unit.
LONGEST = 5
SCALE = 1 << 24
FOLDS, HELD_OUT = 5, 0
#: Different words that a task counts before it hands them on; cuts whose scores are kept.
COUNTED = 300_000
KNOWN = 300_000
#: Characters of a word whose n-grams are taken at a time.
PIECE = 100_000
#: Letters alone: no digits, fractions, numerals in circles or combining marks.
LETTERS = regex.compile(r"\p{L}+")


def word_counts(rows: DataFrame) -> DataFrame:
    """``n`` per (``lang``, ``word``) over all ``rows`` (text, lang)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = defaultdict(Counter)

        def out():
            for lang, cuts in held.items():
                words = Counter()
                for cut, n in cuts.items():
                    if cut.isalpha():
                        words[cut] += n
                    else:
                        for w in LETTERS.findall(cut):
                            words[w] += n
                if words:  # else the texts so far have no letter
                    yield pd.DataFrame({"lang": lang, "word": list(words), "n": list(words.values())})
            held.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                held[lang].update(text.lower().split())
                if sum(map(len, held.values())) > COUNTED:
                    yield from out()
        yield from out()

    counted = rows.select("text", "lang").where("text is not null and lang is not null").mapInPandas(
        count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def ngrams(word: str, n: int) -> list[str]:
    """Runs of n characters; but for single characters the word's two ends count as spaces."""
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def ngram_counts(rows: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``n`` per (``k``, ``gram``, ``lang``) over all ``rows`` (lang, word, n): every word counts n times."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], dict[str, int]] = defaultdict(dict)

        def out():
            for (lang, k), grams in filter(lambda x: x[1], held.items()):
                yield pd.DataFrame({"k": k, "gram": list(grams), "lang": lang, "n": list(grams.values())})
            held.clear()

        for batch in batches:
            for lang, word, n in zip(batch["lang"], batch["word"], batch["n"].tolist()):
                for k in range(1, longest + 1):
                    for piece in pieces(word, k):
                        grams = held[lang, k]
                        for g in piece:
                            grams[g] = grams.get(g, 0) + n
                        if len(piece) == PIECE and sum(map(len, held.values())) > COUNTED:
                            yield from out()
                if len(held[lang, longest]) > COUNTED // 4 and sum(map(len, held.values())) > COUNTED:
                    yield from out()
        yield from out()

    return (rows.mapInPandas(count, "k int, gram string, lang string, n long")
            .groupBy("k", "gram", "lang").agg(F.sum("n").alias("n")))


def pieces(word: str, k: int) -> Iterator[list[str]]:
    """The word's n-grams of length k, ``PIECE`` at a time."""
    if len(word) < PIECE:
        yield ngrams(word, k)
        return
    padded = f" {word} " if k > 1 else word
    for a in range(0, len(padded) - k + 1, PIECE):
        yield [padded[i:i + k] for i in range(a, min(a + PIECE, len(padded) - k + 1))]


def logs_of(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Log frequencies in whole steps."""
    return np.rint(np.log((counts + 0.5) / total) * SCALE).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    #: Log frequencies per language, one row for each word and n-gram of the tables below.
    logs: np.ndarray
    #: Rows of the most frequent words, and (if all are here) of the n-grams of each length from 1.
    words: dict[str, int]
    ngrams: list[dict[str, int]]
    #: Where the tables above are not whole: scores s0, s1, ... per ``word`` and per (``k``, ``gram``).
    all_words: DataFrame | None = None
    all_ngrams: DataFrame | None = None
    whole: bool = True
    cuts: dict[str, int] = field(default_factory=dict)
    cut_scores: np.ndarray | None = None  # added scores of a cut's words, and their number
    cut_rest: dict[int, list[str]] = field(default_factory=dict)  # words of a cut that are looked up elsewhere

    def rows_of(self, word: str) -> list[int]:
        """Rows whose mean is the word's score: its own, or those of its longest known n-grams."""
        if word in self.words:
            return [self.words[word]]
        for n in range(len(self.ngrams), 0, -1):
            table = self.ngrams[n - 1]
            found = [table[g] for g in ngrams(word, n) if g in table]
            if found:
                return found
        return []

    def scores_of(self, cuts: list[str]) -> tuple[np.ndarray, dict[int, list[str]]]:
        """Added scores of the words of every cut with their number in the last column; words not in the tables."""
        at, ends, of, counts, rest = [], [], [], [], {}
        for i, c in enumerate(cuts):
            words = [c] if c.isalpha() else LETTERS.findall(c)
            for w in words:
                if not self.whole and w not in self.words:
                    rest.setdefault(i, []).append(w)
                    continue
                rows = self.rows_of(w)
                if rows:
                    at += rows
                    ends.append(len(at))
                    of.append(i)
            counts.append(len(words))
        out = np.zeros((len(cuts), len(self.langs) + 1), np.int64)
        out[:, -1] = counts
        if at:
            ends = np.array(ends, np.int64)
            starts = np.r_[0, ends[:-1]]
            means = np.add.reduceat(self.logs[at], starts) / (ends - starts)[:, None]
            first = np.flatnonzero(np.r_[True, np.diff(of) > 0])
            out[np.array(of)[first], :-1] = np.add.reduceat(np.rint(means).astype(np.int64), first)
        return out, rest

    def totals(self, batch: list[str]) -> tuple[np.ndarray, list[list[str]]]:
        """Added scores of every text with its number of words in the last column; its words not in the tables."""
        width = len(self.langs) + 1
        if self.cut_scores is None or len(self.cuts) > KNOWN:
            self.cuts, self.cut_scores, self.cut_rest = {}, np.zeros((0, width), np.int64), {}
        held = [t.lower().split() for t in batch]
        new = list(set().union(*held).difference(self.cuts))
        scores, rest = self.scores_of(new)
        self.cut_rest.update((len(self.cuts) + i, ws) for i, ws in rest.items())
        self.cuts.update(zip(new, range(len(self.cuts), len(self.cuts) + len(new))))
        self.cut_scores = np.concatenate([self.cut_scores, scores])
        sizes = np.array([len(h) for h in held], np.int64)
        rows = np.fromiter(map(self.cuts.__getitem__, chain.from_iterable(held)), np.int64, int(sizes.sum()))
        total = np.zeros((len(batch), width), np.int64)
        some = sizes > 0
        if some.any():
            total[some] = np.add.reduceat(self.cut_scores[rows], (np.cumsum(sizes) - sizes)[some])
        found: list[list[str]] = [[] for _ in batch]
        if self.cut_rest:
            has = np.zeros(len(self.cuts), bool)
            has[list(self.cut_rest)] = True
            places = np.flatnonzero(has[rows])
            for i, row in zip(np.repeat(np.arange(len(batch)), sizes)[places].tolist(), rows[places].tolist()):
                found[i] += self.cut_rest[row]
        return total, found

    def predict(self, batch: list[str]) -> list[tuple[str, float]]:
        """Language and score of every text; for a model whose tables are whole."""
        return self.decide(self.totals(batch)[0])

    def decide(self, total: np.ndarray) -> list[tuple[str, float]]:
        """Language and score from added scores."""
        out = []
        for s in total:
            if not self.langs or not s[-1]:
                out.append(("und", 0.0))
                continue
            best = int(s[:-1].argmax())
            out.append((self.langs[best], float(1 / np.exp(np.maximum((s[:-1] - s[best]) / SCALE, -700)).sum())))
        return out


def train(rows: DataFrame, n_words: int = WORDS, n_ngrams: int = NGRAMS, longest: int = LONGEST) -> Model:
    """Model from ``rows`` (text, lang): all words and n-grams; as many as ``n_words`` scores are broadcast."""
    per_word = cut_lineage(word_counts(rows).groupBy("word").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("of")))
    langs = sorted(r[0] for r in per_word.select(F.explode("of.lang")).distinct().collect())
    if not langs:
        return Model([], np.zeros((0, 0), np.int64), {}, [])
    sums = [f"n{i}" for i in range(len(langs))]
    by_lang = F.map_from_entries("of")
    words = per_word.select("word", "total", *[
        F.coalesce(by_lang[lang], F.lit(0)).alias(c) for lang, c in zip(langs, sums)])
    grams = cut_lineage(ngram_counts(per_word.select("word", F.explode("of").alias("x")).select("x.lang", "word", "x.n"),
                                     longest)
                        .groupBy("k", "gram").agg(*[
                            F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(c)
                            for lang, c in zip(langs, sums)]))
    # of words (k = 0) and of the n-grams of each length: different ones, and occurrences per language
    added = [F.count("*").alias("size"), *[F.sum(c).alias(c) for c in sums]]
    facts = {r["k"]: r for r in [words.agg(*added).select(F.lit(0).alias("k"), "*").first(),
                                 *grams.groupBy("k").agg(*added).collect()]}
    totals = {k: np.array([r[c] for c in sums]) + 0.5 * r["size"] for k, r in facts.items()}

    def scored(df: DataFrame, k: int) -> list:
        return [F.rint(F.log((F.col(c) + 0.5) / float(t)) * SCALE).cast("long").alias(f"s{i}")
                for i, (c, t) in enumerate(zip(sums, totals[k]))]

    n_words //= len(langs)
    whole = facts[0]["size"] <= n_words and all(r["size"] <= n_ngrams for k, r in facts.items() if k)
    top = words
    if facts[0]["size"] > n_words:  # the most frequent ones: buckets of totals, cut to their 10 leading bits
        drop_bits = "greatest(length(bin(total)) - 10, 0)"
        bucket = F.expr(f"shiftleft(shiftright(total, {drop_bits}), {drop_bits})")
        held, least = 0, None
        for r in sorted(words.groupBy(bucket.alias("least")).count().collect(), reverse=True):
            held += r["count"]
            if held > n_words:
                break
            least = r["least"]
        top = words.where(F.col("total") >= F.lit(least)) if least is not None else words.limit(0)

    def local(df: DataFrame, key: str) -> tuple[list[str], np.ndarray]:
        got = df.select(key, *sums).toArrow().sort_by(key)
        return got[key].to_pylist(), np.stack([got[c].to_numpy() for c in sums], axis=1)

    places, logs, size = [], [], 0
    for k in range(longest + 1 if whole else 1):
        if k and k not in facts:
            places.append({})
            continue
        keys, counts = local(grams.where(F.col("k") == k), "gram") if k else local(top, "word")
        places.append(dict(zip(keys, range(size, size + len(keys)))))
        size += len(keys)
        logs.append(logs_of(counts, totals[k]))
    model = Model(langs, np.concatenate(logs), places[0], places[1:])
    if not whole:
        model.whole = False
        model.all_words = words.select("word", *scored(words, 0))
        per_k = [grams.where(F.col("k") == k).select("k", "gram", *scored(grams, k)) for k in facts if k]
        model.all_ngrams = reduce(DataFrame.unionAll, per_k)
    return model


def unseen_scores(words: DataFrame, model: Model) -> DataFrame:
    """Scores of each different ``word`` that was not in training, from its longest known n-grams; others are left out."""
    cols = [f"s{i}" for i in range(len(model.langs))]
    words = cut_lineage(words.withColumn("id", F.monotonically_increasing_id()))
    todo, found = words, []
    for k in range(LONGEST, 0, -1):
        def take(batches: Iterator[pd.DataFrame], k=k) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, grams, times = [], [], []
                for i, word in zip(batch["id"].tolist(), batch["word"]):
                    n = Counter()
                    for piece in pieces(word, k):
                        n.update(piece)
                    n = n or {None: 0}
                    ids += [i] * len(n)
                    grams += n.keys()
                    times += n.values()
                    if len(ids) > COUNTED:
                        yield pd.DataFrame({"id": ids, "gram": pd.Series(grams, dtype=object), "times": times})
                        ids, grams, times = [], [], []
                if ids:
                    yield pd.DataFrame({"id": ids, "gram": pd.Series(grams, dtype=object), "times": times})

        known = model.all_ngrams.where(F.col("k") == k).drop("k")
        state = cut_lineage(
            todo.select("id", "word").mapInPandas(take, "id long, gram string, times long").join(known, "gram", "left")
            .groupBy("id").agg(F.sum(F.when(F.col("s0").isNotNull(), F.col("times"))).alias("of"),
                               *[F.sum(F.col("times") * F.col(c)).alias(c) for c in cols]))
        found.append(state.where("of > 0").select("id", *[F.rint(F.col(c) / F.col("of")).cast("long").alias(c)
                                                          for c in cols]))
        todo = words.join(state.where("of is null").select("id"), "id", "left_semi")
    return words.join(reduce(DataFrame.unionAll, found), "id").drop("id")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (in place of columns of these names)."""
    return _predict(docs, model, docs.columns)


def _predict(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``lang_pred`` and ``score``."""
    # bounded by WORDS and NGRAMS
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, all_words=None, all_ngrams=None))
    name, row, new = spare(docs, "of"), spare(docs, "row"), ("lang_pred", "score")
    kept = [c for c in columns if c not in new]

    if model.whole:
        @pandas_udf("lang_pred string, score double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            m = shared.value
            for part in text_parts(batches):
                yield pd.DataFrame(m.predict(part), columns=["lang_pred", "score"])

        return docs.withColumn(name, of("text")).select(*kept, *[F.col(name)[c].alias(c) for c in new])

    @pandas_udf("total array<long>, rest array<string>")
    def added(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for part in text_parts(batches):
            total, rest = m.totals(part)
            yield pd.DataFrame({"total": list(total), "rest": rest})

    n = len(model.langs)
    cols = [f"s{i}" for i in range(n)]
    # written once: the numbers of the rows are then fixed
    held = cut_lineage(docs.withColumn(name, added("text")).select(*kept, name)
                       .withColumn(row, F.monotonically_increasing_id()))
    rest = held.select(F.col(row).alias("row"), F.explode(F.col(name)["rest"]).alias("word"))
    known = rest.join(model.all_words, "word", "left")
    unseen = known.where("s0 is null").select("row", "word")
    by_ngrams = unseen_scores(unseen.select("word").distinct(), model)
    sums = (known.where("s0 is not null").select("row", *cols)
            .unionAll(unseen.join(by_ngrams, "word").select("row", *cols))
            .groupBy("row").agg(*[F.sum(c).alias(c) for c in cols]))
    sums = sums.select(F.col("row").alias(row), F.array(*cols).alias(spare(held, "sums")))
    more = sums.columns[1]
    df = held.join(sums, row, "left")
    total = F.col(name)["total"]
    likely = F.when(F.col(more).isNull(), F.slice(total, 1, n)).otherwise(
        F.zip_with(F.slice(total, 1, n), more, lambda a, b: a + b))
    df = df.select(*kept, F.element_at(total, n + 1).alias(name), likely.alias(more))
    best = F.array_max(more)
    some = F.col(name) > 0
    share = F.aggregate(more, F.lit(0.0), lambda a, s: a + F.exp(F.greatest((s - best) / SCALE, F.lit(-700.0))))
    lang = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position(more, best).cast("int"))
    return df.select(*kept, F.when(some, lang).otherwise("und").alias("lang_pred"),
                     F.when(some, 1 / share).otherwise(0.0).alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    model = train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return _predict(rows, model, ["doc_id", "held_out"])
