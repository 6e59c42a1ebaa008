import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from addrlink.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.shared(spark, PATH)


def check_sequences(rows, capacity):
    """Every sequence is filled from 0 without a gap and within the capacity; returns their number."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_pieces_are_the_library_s(spark, odd_docs, odd_rows, vocabulary):
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for r in odd_rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 2048):
            part = ids[p:p + 2048]
            want[(r[0], p // 2048, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    rows = packing.pack_documents(odd_docs, vocabulary).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows, 2048) <= -(-total // 2048) + 1


def test_empty_table(no_docs, vocabulary):
    assert packing.pack_documents(no_docs, vocabulary).count() == 0


def test_ties_and_a_hot_length(spark):
    rows = [(i, 300, "x") for i in range(4000)] + [(i, 1 + i % 700, "y") for i in range(3000)]
    pieces = spark.createDataFrame(rows, "id long, length long, rank string").repartition(7)
    out = packing.pack(pieces.drop("rank"), 1000).collect()
    assert Counter((r["id"], r["length"]) for r in out) == Counter((a, b) for a, b, _ in rows)
    assert check_sequences(out, 1000) <= best_fit_decreasing([b for _, b, _ in rows], 1000)


def test_lengths_out_of_range(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 11)], "id long, length long"), 10)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            i = min(fits, key=gaps.__getitem__)
            gaps[i] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_plan_is_about_as_tight_as_sequential_best_fit():
    rng = random.Random(3)
    for _ in range(30):
        capacity = rng.choice([10, 100, 2048])
        lengths = [rng.randint(1, rng.randint(1, capacity)) for _ in range(rng.randint(1, 400))]
        plan = packing.plan(Counter(lengths), capacity)
        placed, rows = Counter(), []
        for length, lo, hi, sequence, offset in plan:
            placed[length] += hi - lo
            rows += [{"sequence_id": sequence + k, "offset": offset, "length": length} for k in range(hi - lo)]
        assert placed == Counter(lengths)
        n, best = check_sequences(rows, capacity), best_fit_decreasing(lengths, capacity)
        assert n <= best * 1.02 + 1
    assert packing.plan({}, 10) == []
