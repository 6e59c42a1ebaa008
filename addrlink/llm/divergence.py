"""Operator 11: source divergence audit by ranked count cells.

Every (lang, source) group is compared with the other sources of its language
(part ``pair``) and, term by term, with the language as a whole (part
``term``).  A term counts for a language if at least ``MIN_DOCUMENTS`` of its
documents hold it.  With count ``c`` among ``N`` occurrences of ``V`` terms, a
side gives a term ``p = 1 + SCALE * (c + 1) div (N + V)``, and
``f = (p - q) * (p - q) div q``; all numbers are whole.

``f`` depends on the two counts of a term only, so terms are grouped into cells
of equal counts and ``f`` is evaluated once per cell:

* ``term``: cells (group count, language count) with their multiplicity; cells
  of equal value are merged, the values of a group are ranked and the number of
  terms above each gives the values that can reach rank ``TOP``; only their
  cells are expanded to terms, equal values in UTF-8 order.
* ``pair``: cells (count here, count there) of the terms that both sources
  have.  The terms that only one of them has, and those that neither has, follow
  from the sources' own cells by inclusion and exclusion, so a term that few
  sources have costs nothing for the others.

Text is cut and counted in Arrow batches: a task keeps counts per (lang,
source, term) and hands them on, all sources of a term in one row, whenever it
holds ``HELD`` of them, so its memory is bounded and a hot group is added up
before the shuffle.

Cases: null text, lang and source count as ''; a text without terms makes its
group occur all the same; a language without kept terms gives the value 0 for
every pair and no ``term`` rows; a language with one source has no ``pair``
rows; repeated rows are documents of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrlink.session import cut_lineage

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP = 200
#: Terms of sources that a task holds before it hands their counts on.
HELD = 500_000
#: Rows (groups, count cells) that are broadcast at most; beyond it the joins shuffle.
BROADCAST_ROWS = 100_000

#: UTF-8 bytes: A-Z become a-z, all other ASCII but letters a space; bytes of longer characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def count_terms(docs: DataFrame, held: int = HELD) -> DataFrame:
    """Partial sums lang, term, docs, has: array of (source, n)."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()),
                        ("has", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))])

    def batches_of(counts: dict, docs_: dict) -> Iterator[pa.RecordBatch]:
        for lang, of in docs_.items():
            has: dict[bytes, list] = {t: [] for t in of}
            for source, n in counts[lang].items():
                for term, k in n.items():
                    has[term].append((source, k))
            sizes = np.fromiter(map(len, has.values()), np.int32, len(has))
            sources, n = zip(*chain.from_iterable(has.values())) if has else ((), ())
            pairs = pa.StructArray.from_arrays([pa.array(sources, pa.string()), pa.array(n, pa.int64())], ["source", "n"])
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), pairs)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(has), pa.string()), pa.array(list(has), pa.binary()).cast(pa.string()),
                pa.array(of.values(), pa.int64()), lists], schema=schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs_, left = defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter), held
        for batch in batches:
            for lang, source, text in zip(*[batch.column(c).to_pylist() for c in (0, 1)], batch.column(2)):
                n, words = counts[lang][source], terms_of(text.as_py())
                before = len(n)
                n.update(words)
                docs_[lang].update(set(words))
                left -= len(n) - before
                if left <= 0:
                    yield from batches_of(counts, docs_)
                    counts.clear()
                    docs_.clear()
                    left = held
        yield from batches_of(counts, docs_)

    df = keyed(docs).withColumn("text", F.col("text").cast("binary"))
    return df.mapInArrow(counted, "lang string, term string, docs long, has array<struct<source:string,n:bigint>>")


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count: exact, also beyond 64 bits in between."""
    big = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)"))
    of = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)")
    return F.call_function("div", big, of).cast("long") + F.lit(1)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q).cast("long")


def kept_terms(partial: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, term, lang_n, has: array of (source, n); kept terms only.

    Everything follows one shuffle by (lang, term); a term's array is as long as
    the language has sources (before its sums: times the partial sums).
    """
    one = (partial.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.flatten(F.collect_list("has")).alias("has"))
           .where(F.col("docs") >= min_documents).select("lang", "term", F.explode("has").alias("h"))
           .groupBy("lang", "term", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("n")))
    return one.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("has"))


def small(df: DataFrame) -> DataFrame:
    """``df``, written; marked for broadcast if it has few rows."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def term_part(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group has more than its language."""
    rows = terms.select("lang", "term", "lang_n", F.explode("has").alias("h")).select(
        "lang", "h.source", "term", "h.n", "lang_n")
    cells = rows.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("many"))
    cells = (cells.join(groups, ["lang", "source"])
             .withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
             .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("p > q")
             .select("lang", "source", "n", "lang_n", "many", gap(F.col("p"), F.col("q")).alias("value")))
    cells = cut_lineage(cells)
    # the largest values of a group, each standing for all cells that have it
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (cells.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
              .withColumn("k", F.row_number().over(best)).where(F.col("k") <= top)
              .withColumn("before", F.sum("many").over(best) - F.col("many")).where(F.col("before") < top))
    wanted = cells.join(values.select("lang", "source", "value"), ["lang", "source", "value"])
    named = rows.join(small(wanted.drop("many")), ["lang", "source", "n", "lang_n"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return (named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", "source", F.col("term").alias("item"), "value", "rank"))


def pair_part(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank of every other source of the language."""
    zero = F.lit(0).cast("long")
    both = (terms.select("has", "lang", F.posexplode("has").alias("at", "a"))
            .select("lang", "a", F.explode(F.expr("slice(has, at + 2, size(has))")).alias("b"))
            .groupBy("lang", F.col("a.source").alias("x"), F.col("b.source").alias("y"),
                     F.col("a.n").alias("nx"), F.col("b.n").alias("ny")).agg(F.count("*").alias("many")))
    own = cut_lineage(terms.select("lang", F.explode("has").alias("h")).groupBy(
        "lang", F.col("h.source").alias("source"), F.col("h.n").alias("n")).agg(F.count("*").alias("many")))
    size = own.groupBy("lang", "source").agg(F.sum("many").alias("has"))
    sized = cut_lineage(groups.join(size, ["lang", "source"], "left").withColumn("has", F.coalesce("has", F.lit(0))))

    def f(n, total, m, other) -> Column:
        return gap(share(n, F.col(total), F.col("v")), share(m, F.col(other), F.col("v"))).cast("decimal(38,0)")

    def side(name: str, total: str) -> DataFrame:
        return sized.select("lang", F.col("source").alias(name), F.col("total").alias(total))

    # a term of both is no term of one alone: + f(n, m) - f(n, 0) - f(0, m) + f(0, 0)
    shared = both.join(small(sized.select("lang", F.col("source").alias("x"), F.col("total").alias("tx"), "v")), ["lang", "x"])
    shared = shared.join(small(side("y", "ty")), ["lang", "y"])
    sums = []
    for a, b in (("x", "y"), ("y", "x")):
        n, m, t, u = F.col(f"n{a}"), F.col(f"n{b}"), f"t{a}", f"t{b}"
        sums.append(F.sum(F.col("many") * (f(n, t, m, u) - f(n, t, zero, u) - f(zero, t, m, u) + f(zero, t, zero, u))))
    shared = shared.groupBy("lang", "x", "y").agg(sums[0].alias("xy"), sums[1].alias("yx"))
    shared = shared.select("lang", F.explode(F.array(
        F.struct(F.col("x").alias("source"), F.col("y").alias("item"), F.col("xy").alias("value")),
        F.struct(F.col("y").alias("source"), F.col("x").alias("item"), F.col("yx").alias("value")))).alias("s")).select("lang", "s.*")

    a, b = sized.alias("a"), sized.alias("b")
    pairs = cut_lineage(a.join(b, F.expr("a.lang = b.lang and a.source <> b.source")).select(
        "a.lang", "a.source", F.col("b.source").alias("item"), "a.v", "a.total", F.col("b.total").alias("item_total"),
        (F.col("a.v") - F.col("a.has") - F.col("b.has")).alias("neither")))
    known = pairs.where("v > 0")
    here = own.join(known, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("many") * f(F.col("n"), "total", zero, "item_total")).alias("value"))
    there = own.withColumnRenamed("source", "item").join(known, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("many") * f(zero, "total", F.col("n"), "item_total")).alias("value"))
    neither = known.select("lang", "source", "item", (F.col("neither") * f(zero, "total", zero, "item_total")).alias("value"))
    value = F.coalesce(F.sum(F.col("value").cast("decimal(38,0)")), F.lit(0)).cast("long")
    parts = [df.select("lang", "source", "item", F.col("value").cast("decimal(38,0)")) for df in (shared, here, there, neither)]
    parts.append(pairs.select("lang", "source", "item", F.lit(0).cast("decimal(38,0)").alias("value")))
    rows = reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "item").agg(value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank."""
    terms = cut_lineage(kept_terms(count_terms(docs), min_documents))
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = (terms.select("lang", F.explode("has").alias("h"))
              .groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("total")))
    none = F.lit(0).cast("long")
    groups = cut_lineage(
        keyed(docs).select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "v", "lang_total")]))
    parts = {"pair": pair_part(terms, groups), "term": term_part(terms, groups, top)}
    one, two = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
                for name, df in parts.items()]
    return one.unionByName(two)
