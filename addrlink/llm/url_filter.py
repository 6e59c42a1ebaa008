"""Operator 4: URL filters by hash lists [native].

A url is expanded into expressions: every suffix of its host with every prefix
of its path that has the length of some rule's path.  The SHA-256 digests of
the expressions meet those of the rules in an equi-join on a short prefix of
the digest; the full digests confirm, and the longest rule decides.

Every distinct (host, path) is expanded once, so a url or host that holds a
third of all rows is expanded once as well; the decision goes back to the rows
by an equi-join that AQE can split.

Cases: a null url, or one without ``://``, has an empty host and path; rules
with a null host are no rules, a null path is the empty path; of rules that are
equally long the one with the longer host wins, then ``block`` over ``allow``;
repeated rows are all returned; empty tables of pages or of rules are fine;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the digest that the join uses.
SHORT = 8
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path`` of ``url``."""
    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def listed(rules: DataFrame) -> DataFrame:
    """The rules with their digests, one row per expression."""
    df = rules.where("host is not null").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
    # of two verdicts for one expression ``block`` holds
    df = df.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    return df.withColumns({"digest": digest, "short": F.substring(digest, 1, SHORT)})


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per host suffix and path prefix of the distinct (host, path) rows."""
    suffixes = F.expr(
        "transform(sequence(1, size(split(host, '[.]', -1))), i ->"
        " array_join(slice(split(host, '[.]', -1), i, size(split(host, '[.]', -1))), '.'))")
    prefixes = F.array_compact(F.array(*[
        F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths]))
    df = urls.select("host", "path", F.explode(suffixes).alias("_s"), prefixes.alias("_p"))
    df = df.select("host", "path", F.explode(F.transform("_p", lambda p: F.concat("_s", p))).alias("expr"))
    digest = F.sha2("expr", 256)
    return df.select("host", "path", digest.alias("digest"), F.substring(digest, 1, SHORT).alias("short"))


def decisions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, ``rule`` and ``verdict`` of the (host, path) rows that a rule fits."""
    known = listed(rules)
    # as many numbers as rules have different path lengths
    lengths = sorted(r[0] for r in known.select(F.char_length("rule_path")).distinct().collect())
    if not lengths:
        lengths = [0]
    found = (expressions(urls, lengths).alias("u").join(known.alias("k"), "short")
             .where("u.digest = k.digest"))
    order = F.struct(F.char_length("rule_host") + F.char_length("rule_path"), F.char_length("rule_host"))
    return found.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("r")
    ).select("host", "path", "r.rule", "r.verdict")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null: none fits) and ``verdict`` of every row.

    ``rules``: columns host, path, verdict.
    """
    df = with_parts(pages.select("page_id", "url")).drop("url")
    made = decisions(df.select("host", "path").distinct(), rules)
    return (df.join(made, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
