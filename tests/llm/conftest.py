import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept string,"
          " row_key string, fp string, component_id string, length string, piece string, of string, word string")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def doc(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), 0.1, "k", "r", "f", "c", "l", "p", "o", "w")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    rng = random.Random(1)
    long = "\n".join(sentence(rng, 12) for _ in range(2500))
    copy = sentence(rng, 80)
    return [doc(1, None), doc(2, ""), doc(3, " \n\t\x0b\x0c\r "), doc(4, long), doc(4, long), doc(5, "x" * 6000),
            doc(None, copy), doc(6, sentence(rng, 70), None, None), doc(7, copy), doc(8, copy),
            doc(9, copy + " end"), doc(10, "a b c a b c a b c " * 20), doc(11, "Été à l'école <|endoftext|> don't\n\nZ."),
            doc(12, "### $$ % & | < > " * 30), (13,) + (None,) * 13, doc(14, sentence(rng, 60), "fr", None)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
