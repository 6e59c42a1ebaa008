"""Operator 5: quality classifier of supervised subword embeddings.

Every word is the mean of learned vectors: one for the word and one for each of
its character n-grams, found by hashing.  A text is the mean of its words, and a
softmax layer reads it.  Pairs of one word following itself count as one more
word of their own (``SAME``), the only word 2-gram.  Vectors and layer are
trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows.

All layers are linear up to the softmax, so a word comes down to one number,
its push towards label 1, and a text's score is the logistic of the mean.  The
numbers of words met before are kept in a dictionary of bounded size, which
saves time and decides nothing.

Cases: null texts count as empty; an empty text has the score of the layer's
bias; without labelled rows of both labels the score is the smoothed share of
label 1 (0.5 without any row); null labels and ids are not learned from, null
ids are scored; repeated rows are all scored; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import fold_of, text_parts

#: Labelled rows that are learned from at most (those with the smallest hash of doc_id).
TRAIN_ROWS = 4000
BUCKETS = 1 << 16
#: Type of bucket numbers while training: those of all texts are what the driver holds most of.
SMALL = np.min_scalar_type(BUCKETS - 1)
DIM = 8
NGRAM_SIZES = (2, 3, 4)
EPOCHS = 8
RATE = 4.0
BATCH = 16
FOLDS, HELD_OUT = 3, 1
KNOWN = 300_000
#: Longer words are seen through windows of this many characters.
LONG = 40
SAME = "\x00same"


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ h >> np.uint64(32)) % np.uint64(BUCKETS)


def subwords(words: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of one length and the matrix of their buckets: the word, then its n-grams."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for length, group in groups.items():
        for i in range(0, len(group), 20_000):
            part = group[i:i + 20_000]
            raw = "".join(f"<{w}>" for w in part).encode("utf-32-le", "surrogatepass")
            chars = np.frombuffer(raw, "<u4").reshape(len(part), length + 2).astype(np.uint64)
            power = np.uint64(1_000_003) ** np.arange(length + 2, dtype=np.uint64)
            columns = [_mix((chars * power).sum(axis=1, dtype=np.uint64) + np.uint64(1))[:, None]]
            for n in NGRAM_SIZES:
                if n <= length + 2:
                    h = sum(chars[:, k:length + 3 - n + k] * power[k] for k in range(n))
                    columns.append(_mix(h * np.uint64(31) + np.uint64(n + 1)))
            yield part, np.concatenate(columns, axis=1).astype(np.int64)


def words_of(text: str) -> list[str]:
    """Words of a whole text; a word equal to the one before adds ``SAME``."""
    words = text.split()
    repeats = sum(map(eq, words, words[1:]))
    if any(len(w) > LONG for w in words):
        words = [w[i:i + LONG] for w in words for i in range(0, len(w), LONG)]
    return words + [SAME] * repeats


@dataclass
class Model:
    push: np.ndarray  # of every bucket towards label 1
    bias: float
    known: dict[str, float] = field(default_factory=dict)

    def score(self, batch: list[str]) -> list[float]:
        if len(self.known) > KNOWN:
            self.known = {}
        known, out = self.known, []
        held = [words_of(t) for t in batch]
        for words, buckets in subwords(set().union(*held).difference(known)):
            known.update(zip(words, self.push[buckets].mean(axis=1).tolist()))
        for words in held:
            x = self.bias + (sum(map(known.__getitem__, words)) / len(words) if words else 0.0)
            out.append(float(1 / (1 + np.exp(-np.clip(x, -500, 500)))))
        return out


def fit(samples: list[tuple[str, int]], seed: int = 7) -> Model:
    """Train on (text, label) pairs."""
    labels = np.array([y for _, y in samples], np.int64)
    if len(samples) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(samples) + 2)
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    # every text as its buckets with weights that add up to 1
    held = [words_of(t) for t, _ in samples]
    buckets_of: dict[str, np.ndarray] = {}
    for words, buckets in subwords(set().union(*held)):
        buckets_of.update(zip(words, buckets.astype(SMALL)))
    rows = []
    for words in held:
        if words:
            n, at = {}, []
            for w in words:
                n[w] = n.get(w, 0) + 1
            at = np.concatenate([buckets_of[w] for w in n])
            weight = np.concatenate([np.full(len(buckets_of[w]), c / len(words) / len(buckets_of[w]))
                                     for w, c in n.items()])
            b, inverse = np.unique(at, return_inverse=True)
            rows.append((b, np.bincount(inverse, weight).astype(np.float32)))
        else:
            rows.append((np.empty(0, SMALL), np.empty(0, np.float32)))
    del held, buckets_of
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    steps, done = EPOCHS * -(-len(rows) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            rate = RATE * (1 - done / steps)
            done += 1
            part = order[i:i + BATCH]
            of = np.repeat(np.arange(len(part)), [len(rows[r][0]) for r in part])
            at = np.concatenate([rows[r][0] for r in part])
            weight = np.concatenate([rows[r][1] for r in part])[:, None]
            text = np.zeros((len(part), DIM), np.float32)
            np.add.at(text, of, vectors[at] * weight)
            z = text @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - target[part]) / len(part)
            back = error @ layer.T
            layer -= rate * (text.T @ error)
            bias -= rate * error.sum(axis=0)
            np.add.at(vectors, at, -rate * len(part) * weight * back[of])
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from at most ``rows`` labelled rows that are not held out."""
    eligible = labels.where("doc_id is not null and quality is not null").where(
        fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    chosen = eligible.groupBy("doc_id").agg(F.max("quality").alias("_y")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` ids are broadcast, and only their texts come to the driver
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    sample = sorted((r["doc_id"], r["text"] or "", int(r["_y"] > 0)) for r in found.collect())
    return fit([(t, y) for _, t, y in sample])


def score_of(text: Column, model: Model) -> Column:
    """Score of a text column."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(Model(model.push, model.bias))

    @pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for part in text_parts(batches):
            yield pd.Series(m.score(part), dtype="float64")

    return of(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    df = docs.select("doc_id", held_out.alias("held_out"),
                     score_of(F.col("text"), train(docs, labels)).alias("score"))
    return df.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows predicted to be of low quality, same columns."""
    return docs.where(score_of(F.col("text"), model) >= 0.5)
