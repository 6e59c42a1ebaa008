"""Registered queries of the corpus operators: ``opN_<name>(spark, sf_dir)``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, divergence, embedding_dedup, hard_negatives, html_extract, langid, license_scan, packing,
               quality_classifier, quality_rules, simhash, url_filter)
from .common import literal_rows, table
from .oracles import ORACLES  # noqa: F401


def tokenizer(spark: SparkSession, name: str):
    """A public tokenizer file, sent to the executors."""
    import public_tokenizers

    return bpe.shared(spark, public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and adaptive thresholds for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


#: The rules of the url query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.classes(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    vocabulary = tokenizer(spark, "byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", bpe.encode_decode(F.col("text"), vocabulary).alias("x"))
    return docs.select(
        "doc_id", F.expr("cast(octet_length(x.ids) as bigint) div 4").alias("n_tokens"),
        F.sha2("x.ids", 256).alias("ids_sha256"), F.sha2("x.decoded", 256).alias("decoded_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of a document that states a licence."""
    return license_scan.scan(table(spark, sf_dir, "documents")).where("confirmed").drop("confirmed")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer(spark, "word_bpe_49k.json"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the other sources of its language and, by term, against the language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (ids divisible by 100) and each of its positives."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


#: A conversation whose turns hold the template's own control strings.
CONTROL_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation written as examples of one trainable reply each, and read back."""
    more = literal_rows(spark, CONTROL_TURNS, "conv_id:bigint,turn:bigint,role:string,text:string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.examples(turns.unionByName(more)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_html_extract": op3_html_extract,
    "op4_url_filter": op4_url_filter,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_license_scan": op8_license_scan,
    "op9_packing": op9_packing,
    "op10_langid": op10_langid,
    "op11_source_divergence": op11_source_divergence,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_chat_format": op13_chat_format,
}
