"""Operator 1: quality rules with adaptive thresholds [native].

Every document gets its counts in one row-local pass (no word is shuffled).
The counts that can go wrong in both directions of a corpus (symbols, capitals,
repeated lines, repeated words, word length) are judged against thresholds
learned per (language, source): mergeable quantile sketches (bucket counts with
10 leading bits) are built per group with map-side partial aggregation and
merged per language and over the whole corpus; a group with too few rows takes
the thresholds of its language, or of the corpus.  All arithmetic is on whole
numbers, so a repeated task gives the same thresholds.  The thresholds are joined back to the counts.

Cases: null text counts as empty (0 words, ``base_failed``); null language or
source is a group of its own; an empty table gives an empty result; repeated
rows are judged one by one and all returned; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

from .common import row_key, spare, words_of

#: Fixed cutoffs of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows that a (language, source) group or a language needs for thresholds of its own.
MIN_GROUP_ROWS = 200
#: A value is an outlier beyond q75 + FENCE * (q75 - q25) ...
FENCE = 4
#: ... where the spread counts as this much at least.  Measures are whole numbers:
#: per mille of words, characters or lines, and hundredths of a character per word.
MEASURES = {"symbol_share": 50, "upper_share": 50, "dup_line_share": 100,
            "repeat_share": 120, "word_length": 100}


def add_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, a row key and the counts of every whole text."""
    df = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("_t"),
                     row_key(docs, ["doc_id", "text", "lang", "source"]).alias("row_key"))
    df = df.withColumns({
        "_w": words_of(F.col("_t")),
        "_l": F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": (F.char_length("_t")
                      - F.char_length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long"),
        "n_upper": (F.char_length("_t")
                    - F.char_length(F.regexp_replace("_t", r"\p{Lu}+", ""))).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        # one hash per 3-word window, in place order
        "_h": F.expr("slice(transform(_w, (w, i) -> xxhash64(w, get(_w, i + 1), get(_w, i + 2))),"
                     " 1, greatest(size(_w) - 2, 0))")})
    df = df.drop("_t", "_l", "_w").withColumn("_twice", F.size(F.array_distinct("_h")) < F.size("_h"))
    # only for texts with a repeated window: hash in the high bits, place in the low
    # ones, sorted as plain longs; equal windows are then neighbours
    df = df.withColumn("_bits", F.length(F.bin(F.size("_h"))))
    df = df.withColumn("_p", F.expr(
        "case when _twice then sort_array(transform(_h, (h, i) ->"
        " shiftleft(shiftright(h, _bits), _bits) | cast(i as bigint))) end"))
    df = df.withColumn("_i", F.expr(
        "case when _twice then sort_array(transform(filter(_p, (p, j) ->"
        " shiftright(p, _bits) <=> shiftright(get(_p, j - 1), _bits)"
        " or shiftright(p, _bits) <=> shiftright(get(_p, j + 1), _bits)),"
        " p -> p & (shiftleft(1L, _bits) - 1))) end"))
    # windows cover the words i, i + 1, i + 2: count the union of these spans
    df = df.withColumn("n_repeat_words", F.expr(
        "case when _twice then aggregate(transform(_i, (x, j) ->"
        " least(3L, coalesce(get(_i, j + 1) - x, 3L))), 0L, (a, x) -> a + x) else 0L end"))
    return df.drop("_h", "_p", "_i", "_bits", "_twice")


def add_measures(counts: DataFrame) -> DataFrame:
    """base_failed and the whole-number measures that the adaptive thresholds judge."""
    per = lambda n, a, b: F.expr(f"({n} * {a}) div greatest({b}, 1)")
    return counts.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbol_share": per(1000, "n_symbols", "n_words"),
        "upper_share": per(1000, "n_upper", "word_chars"),
        "dup_line_share": per(1000, "n_dup_lines", "n_lines"),
        "repeat_share": per(1000, "n_repeat_words", "n_words"),
        "word_length": per(100, "word_chars", "n_words")})


def sketch(measured: DataFrame) -> DataFrame:
    """Quantile sketch per (lang, source) and measure: rows (bucket, n).

    A bucket is a value cut to its 10 leading bits (exact below 1024, else
    within 1/512), so a group has at most a few thousand buckets whatever its
    size.  Sketches merge by adding ``n``; the groups that hold a third of the
    rows are pre-aggregated in every map task.
    """
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v"))
                              for m in MEASURES])).alias("x")
    drop_bits = "greatest(length(bin(x.v)) - 10, 0)"
    return (measured.where("not base_failed").select("lang", "source", one)
            .select("lang", "source", "x.measure",
                    F.expr(f"shiftleft(shiftright(x.v, {drop_bits}), {drop_bits})").alias("bucket"))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def limits(sketched: DataFrame, fence: int) -> DataFrame:
    """Per level, group and measure: q75 + fence * max(q75 - q25, least), and the group's rows.

    Level 2 is (lang, source), level 1 the language, level 0 the corpus.
    """
    levels = F.explode(F.array(*[F.lit(x) for x in (0, 1, 2)])).alias("level")
    merged = (sketched.select("*", levels)
              .withColumns({"lang": F.when(F.col("level") > 0, F.col("lang")),
                            "source": F.when(F.col("level") > 1, F.col("source"))})
              .groupBy("level", "lang", "source", "measure", "bucket").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("level", "lang", "source", "measure")
    df = merged.withColumns({"_all": F.sum("n").over(w),
                             "_to": F.sum("n").over(w.orderBy("bucket"))})
    at = lambda quarter: F.min(F.when(4 * F.col("_to") >= quarter * F.col("_all"), F.col("bucket")))
    df = df.groupBy("level", "lang", "source", "measure").agg(
        at(1).alias("q25"), at(3).alias("q75"), F.max("_all").alias("n"))
    least = F.create_map(*[F.lit(x) for pair in MEASURES.items() for x in pair])[F.col("measure")]
    return df.withColumn("limit", F.col("q75") + fence * F.greatest(F.col("q75") - F.col("q25"), least))


def thresholds(sketched: DataFrame, min_rows: int = MIN_GROUP_ROWS, fence: int = FENCE) -> DataFrame:
    """Upper limits per (lang, source): its own, its language's or the corpus's."""
    limit = limits(sketched, fence).withColumnsRenamed({"lang": "l", "source": "s"})
    groups = sketched.select("lang", "source").distinct().select(
        "lang", "source", F.explode(F.array(*[F.lit(x) for x in (0, 1, 2)])).alias("k"))
    df = groups.join(limit, (F.col("k") == F.col("level"))
                     & F.when(F.col("k") > 0, F.col("lang")).eqNullSafe(F.col("l"))
                     & F.when(F.col("k") > 1, F.col("source")).eqNullSafe(F.col("s")))
    # the finest level with enough rows; the corpus always counts
    fits = F.when((F.col("level") == 0) | (F.col("n") >= min_rows), F.col("level"))
    return df.groupBy("lang", "source").agg(*[
        F.max_by("limit", F.when(F.col("measure") == m, fits)).alias("max_" + m) for m in MEASURES])


def judge(docs: DataFrame, min_rows: int = MIN_GROUP_ROWS, fence: int = FENCE) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document, with its limits and ``broken`` rules.

    The counts are written once to the shared checkpoint folder: they are far
    smaller than the texts, and both the sketches and the join read them.
    """
    measured = cut_lineage(add_measures(add_counts(docs)))
    limit = thresholds(sketch(measured), min_rows, fence).withColumnsRenamed(
        {"lang": "lang_", "source": "source_"})
    df = measured.join(limit, measured["lang"].eqNullSafe(limit["lang_"])
                       & measured["source"].eqNullSafe(limit["source_"]), "left").drop("lang_", "source_")
    over = [F.when(F.col(m) > F.col("max_" + m), F.lit(m)) for m in MEASURES]
    df = df.withColumn("broken", F.array_compact(F.array(*over)))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, same columns."""
    name = spare(docs, "row_key")
    rejected = judge(docs).where("not kept").select(F.col("row_key").alias(name)).distinct()
    key = row_key(docs, ["doc_id", "text", "lang", "source"])
    return docs.withColumn(name, key).join(rejected, name, "left_anti").select(*docs.columns)
