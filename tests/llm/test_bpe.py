import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from addrlink.llm import bpe

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    with open(path, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read()), Tokenizer.from_file(path)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def random_texts(n):
    rng = random.Random(9)
    parts = list("abcXYZ  \n\t'sdlv019.,!é ñÑßΣσςİıǅ中文🙂́​\x1c\x1f\x85\xa0᠎  　٣²½_-#") + [
        "'s", "'ll", "<|endoftext|>", "<|startoftext|>", " the", "  ", "word", " Word."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_same_ids_and_text_as_the_library(both, odd_rows):
    own, library = both
    texts = [r[1] or "" for r in odd_rows] + random_texts(3000) + [" " * 400, "ab" * 4000, "\n\n x \n y"]
    for text, raw, want in zip(texts, own.encode_texts(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids(raw) == want.ids, text
        if not own.drops_space:
            assert own.decode(raw) == library.decode(want.ids, skip_special_tokens=False) == text


def test_short_and_long_words_agree(both):
    own, _ = both
    rng = random.Random(2)
    for n in (1, 2, 3, 10, 48):
        words = ["".join(rng.choice("abcdeéß,1") for _ in range(n))[:n] for _ in range(200)]
        for w in words:
            b = w.encode()
            if len(b) <= bpe.SHORT:
                assert own.merge_short(np.frombuffer(b, np.uint8)[None])[0] == own.merge_long(b)


def test_known_pieces_are_forgotten_without_effect(both, monkeypatch):
    own, _ = both
    texts = random_texts(50)
    want = own.encode_texts(texts)
    monkeypatch.setattr(bpe, "KNOWN", 0)
    assert [own.encode_texts([t])[0] for t in texts] == want


def test_columns(spark, odd_docs, odd_rows, no_docs):
    path = public_tokenizers.path(FILES[0])
    library, vocabulary = Tokenizer.from_file(path), bpe.shared(spark, path)
    rows = odd_docs.select("doc_id", "text", bpe.encode_decode(F.col("text"), vocabulary).alias("x")).select(
        "text", "x.ids", "x.decoded", bpe.id_array(F.col("x.ids")).alias("array"),
        bpe.decode(F.col("x.ids"), vocabulary).alias("again"), F.sha2("x.ids", 256).alias("sha")).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["array"] == want == ids(r["ids"])
        assert r["decoded"] == r["again"] == (r["text"] or "")
        assert r["sha"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert no_docs.select(bpe.encode(F.col("text"), vocabulary)).count() == 0
