"""Ordered matching cascade.

State is one links table ``(lid, rid, rule, ref, trigram, levenshtein,
step)``.  Each pass sees only the rows of both sides not yet linked (U1/U3),
finds pairs, and appends them with its rule label (U2).

Two pass shapes cover the reference:

* ``SameIdPass`` - the right row already carries the left id (``ref``):
  a name predicate on the pairs of that id; no blocking needed.
* ``OneToOnePass`` - blocked by municipality, keep a pair only when it is
  the only pair for its (block, key) (A4), optionally check the carried id
  and drop ids seen twice (A5).

The costly work does not depend on what is linked already, so a ``Matcher``
does it once, whatever the number of passes:

* the pairs of all same-id passes are one join on the carried id, with the
  steps whose predicate holds as an array per pair.  Consecutive same-id
  passes are then one fold: a right row has one carried id, so a left id is
  decided by the first step that any of its free pairs has, and its pairs of
  that step are linked;
* the key pairs of a one-to-one measure (equal keys, rewritten keys, one edit)
  are generated once between the distinct keys of both sides; passes that
  differ in thresholds filter one set (``accept``);
* key pairs that can be many (a trigram distance, two edits) are looked for
  when the pass is due, between keys with a free row, and for groups that can
  still pass: with an id check only those whose own carried pair does;
* the sides shrink to ids, 96-bit key ids and one flag per pass.  A pass
  counts its free rows per (block, key) (map-side combine) and joins them to
  the key pairs; the pair count of a group is ``sum(n_left * n_right)``,
  exactly ``count(*)`` of the reference's row join, without ever emitting the
  row product of a hot key.  Only late key pairs read a text or trigram array.

The links table is checkpointed after every step (reliable checkpoint in
``spark.checkpoint.dir``) so the lineage stays short and a lost executor
recomputes one pass, not the whole cascade.

``lid`` and ``rid`` are keys of their sides (one row each).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut_lineage, persist_scratch, scratch
from .fuzzy import edit_id_pairs, edits, trigram_groups
from .relational import drop_ambiguous, unmatched

LINK_SCHEMA = "lid string, rid string, rule string, ref string, trigram float, levenshtein float, step int"

# (block, lk, ...), (block, rk, ...) of both sides -> distinct (block, l1, l2, r1, r2, llen, rlen[, levenshtein])
PairFinder = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class TrigramGroups:
    """Late finder: keys nearer than ``max_dist`` by trigrams, of every group all pairs or two of them."""
    max_dist: float

    def value(self, side: DataFrame, key: str) -> Column:
        return F.col("tri") if key == "court" and "tri" in side.columns else T.trigram_codes(key)

    def pairs(self, left: DataFrame, right: DataFrame, group_side: str) -> DataFrame:
        out = trigram_groups(left.withColumnRenamed("value", "tri"), right.withColumnRenamed("value", "tri"), self.max_dist, group_side)
        return out.withColumn("levenshtein", F.lit(None).cast("float"))

    def holds(self, l: Column, r: Column) -> Column:
        return T.trigram_distance_arrays(l, r) < self.max_dist


@dataclass(frozen=True)
class EditGroups:
    """Late finder: keys within ``d`` edits."""
    d: int

    def value(self, side: DataFrame, key: str) -> Column:
        return F.col(key)

    def pairs(self, left: DataFrame, right: DataFrame, group_side: str) -> DataFrame:
        texts = [persist_scratch(df.filter(F.col("block").isNotNull()).select(F.col("block").alias("_b"), F.col("value").alias("_s")))
                 for df in (left, right)]
        return _edit_columns(edit_id_pairs(*texts, self.d)).withColumn("trigram", F.lit(None).cast("float"))

    def holds(self, l: Column, r: Column) -> Column:
        return edits(l, r, self.d) >= 0


LATE = (TrigramGroups, EditGroups)


@dataclass
class SameIdPass:
    """Right rows carrying the left id, kept when ``predicate(l, r)`` holds (columns ``l.*``, ``r.*``).

    ``free``: which side must be without a link, ``both``, ``left`` or ``right``.
    Where only the left row must be, a link replaces an earlier one of its right row.
    """
    rule: str
    predicate: Callable[[DataFrame, DataFrame], Column]
    left_filter: Callable[[DataFrame], Column] | None = None
    right_filter: Callable[[DataFrame], Column] | None = None
    trigram: Callable[[DataFrame, DataFrame], Column] | None = None
    free: str = "both"


@dataclass
class OneToOnePass:
    """Blocked pass keeping (block, group key) groups with exactly one pair.

    ``lkey``/``rkey`` name the key column of each side (e.g. ``court`` or
    ``name``); ``finder`` returns candidate key pairs between the distinct keys
    (passes with the same finder object and keys share its result) and
    ``accept`` says which of them this pass takes, from ``trigram``,
    ``levenshtein``, ``llen`` and ``rlen`` (key lengths); ``group_side`` says
    whose key the reference grouped by.  ``extra_*`` are columns that follow
    from the key and that the finder needs.  ``left_weight`` names a column of
    how many times a left row counts (0: not at all).  ``with_previous``: the
    pass sees the same free rows as the one before it (two directions of a rule).
    A late finder's keys are longer than ``lmin`` and ``rmin``; it accepts by itself.
    """
    rule: str
    lkey: str
    rkey: str
    finder: PairFinder | TrigramGroups | EditGroups
    group_side: str = "r"
    id_check: bool = False
    drop_doubles: bool = False
    left_filter: Callable[[DataFrame], Column] | None = None
    right_filter: Callable[[DataFrame], Column] | None = None
    extra_left: list[str] = field(default_factory=list)
    extra_right: list[str] = field(default_factory=list)
    accept: Column | None = None
    left_weight: str | None = None
    with_previous: bool = False
    lmin: int = 0
    rmin: int = 0


Pass = SameIdPass | OneToOnePass


def _key_id(key: str, prefix: str) -> list[Column]:
    """Two independent hashes (96 bits) that stand for a key value."""
    return [F.xxhash64(key).alias(f"{prefix}1"), F.hash(key).alias(f"{prefix}2")]


def keyed(side: DataFrame, key: str, prefix: str, on: Column, *more: Column) -> DataFrame:
    """Distinct ids and lengths of the keys of a side, with the id of what they are joined on: no text is moved."""
    rows = side.filter(F.col(key).isNotNull()).select("block", F.col(key).alias("_key"), on.alias("_on"), *more)
    more = [c for c in rows.columns if c not in ("block", "_key", "_on")]
    return rows.filter(F.col("_on").isNotNull()).select(
        "block", *_key_id("_key", prefix), F.length("_key").alias(f"{prefix}len"), *_key_id("_on", "_j"), *more).distinct()


def equal_keys(la: DataFrame, ra: DataFrame) -> DataFrame:
    """Finder: equal keys in the block."""
    return keyed(la, "lk", "l", F.col("lk")).join(keyed(ra, "rk", "r", F.col("rk")), ["block", "_j1", "_j2"]).drop("_j1", "_j2")


def rewritten_keys(lexpr: Callable[[Column], Column], rexpr: Callable[[Column], Column],
                   lcond: Callable[[Column], Column] | None = None,
                   rcond: Callable[[Column], Column] | None = None) -> PairFinder:
    """Finder: ``lexpr(lk) = rexpr(rk)`` inside the block (computed-key equi-join)."""
    def find(la: DataFrame, ra: DataFrame) -> DataFrame:
        if lcond is not None:
            la = la.filter(lcond(F.col("lk")))
        if rcond is not None:
            ra = ra.filter(rcond(F.col("rk")))
        l, r = keyed(la, "lk", "l", lexpr(F.col("lk"))), keyed(ra, "rk", "r", rexpr(F.col("rk")))
        return l.join(r, ["block", "_j1", "_j2"]).drop("_j1", "_j2")
    return find


def one_edit_keys(longer: int) -> PairFinder:
    """Finder: keys of the block longer than ``longer`` with at most one edit between them."""
    def find(la: DataFrame, ra: DataFrame) -> DataFrame:
        texts = [persist_scratch(df.filter(F.col("block").isNotNull() & (F.length(k) > longer)).select(
            F.col("block").alias("_b"), F.col(k).alias("_s")).distinct()) for df, k in ((la, "lk"), (ra, "rk"))]
        return _edit_columns(edit_id_pairs(*texts, 1))
    return find


def _edit_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("_b").alias("block"), *[F.col(f"_{c}").alias(c) for c in ("l1", "l2", "r1", "r2")],
                        F.col("_ln").alias("llen"), F.col("_rn").alias("rlen"), "levenshtein")


class Matcher:
    """What all passes read, computed once: same-id pairs, key pairs per measure, narrow sides."""

    def __init__(self, left: DataFrame, right: DataFrame, passes: list[Pass]):
        self.passes = passes
        with scratch():
            left, right = persist_scratch(left), persist_scratch(right)
            left, right = self._flagged(left, "left_filter"), self._flagged(right, "right_filter")
            self.left = self._narrow(left, "lid", "lkey")
            self.right = self._narrow(right, "rid", "rkey")
            self.pairs = self._same_id_pairs(left, right)
            # the key pairs of all measures are one job and one table
            measures = {self._measure(p): p for p in passes if isinstance(p, OneToOnePass) and not isinstance(p.finder, LATE)}
            self.number = {m: i for i, m in enumerate(measures)}
            self.found = cut_lineage(reduce(DataFrame.unionByName, [
                self._key_pairs(left, right, p).withColumn("measure", F.lit(i))
                for i, p in enumerate(measures.values())])) if measures else None
            self.late = {i: p for i, p in enumerate(passes, 1) if isinstance(p, OneToOnePass) and isinstance(p.finder, LATE)}
            self.values: dict[tuple, DataFrame] = {}
            for p in self.late.values():
                for side, key, prefix in ((left, p.lkey, "l"), (right, p.rkey, "r")):
                    of = (prefix, key, type(p.finder))
                    if of not in self.values:
                        self.values[of] = self._key_values(side, key, prefix, p.finder.value(side, key))
            self.own = self._own_pairs(left, right)

    def _flagged(self, side: DataFrame, name: str) -> DataFrame:
        """The side with a flag ``_f<step>`` for every pass that filters it."""
        flags = {f"_f{i}": F.coalesce(getattr(p, name)(side), F.lit(False))
                 for i, p in enumerate(self.passes, 1) if getattr(p, name) is not None}
        return side.withColumns(flags) if flags else side

    def _narrow(self, side: DataFrame, row_id: str, key: str) -> DataFrame:
        ones = [(i, p) for i, p in enumerate(self.passes, 1) if isinstance(p, OneToOnePass)]
        keys = sorted({getattr(p, key) for _, p in ones})
        # blank keys are values like any other; a NULL key meets nothing
        ids = [h for k in keys for h in _key_id(k, k)] + [F.col(k).isNotNull().alias(f"{k}_known") for k in keys]
        flags = [f"_f{i}" for i, _ in ones if f"_f{i}" in side.columns]
        extra = ["ref"] if row_id == "rid" else sorted({p.left_weight for _, p in ones if p.left_weight})
        return cut_lineage(side.select(row_id, "block", *extra, *ids, *flags))

    def _same_id_pairs(self, left: DataFrame, right: DataFrame) -> DataFrame | None:
        """lid, rid, ref, steps (passes whose predicate holds) and the trigram distance some of them ask for."""
        same = [(i, p) for i, p in enumerate(self.passes, 1) if isinstance(p, SameIdPass)]
        if not same:
            return None
        l, r = left.alias("l"), right.alias("r")
        flag = lambda side, df, i: F.col(f"{side}._f{i}") if f"_f{i}" in df.columns else F.lit(True)
        steps = F.array_compact(F.array(*[
            F.when(flag("l", left, i) & flag("r", right, i) & p.predicate(l, r), F.lit(i)) for i, p in same]))
        scored = [p.trigram(l, r) for _, p in same if p.trigram is not None]
        score = scored[0] if scored else F.lit(None)
        j = r.join(l, F.col("r.ref") == F.col("l.lid")).select(
            F.col("l.lid").alias("lid"), F.col("r.rid").alias("rid"), F.col("r.ref").alias("ref"),
            steps.alias("steps"), score.cast("float").alias("trigram"))
        return cut_lineage(j).filter(F.size("steps") > 0)

    @staticmethod
    def _key_values(side: DataFrame, key: str, prefix: str, value: Column) -> DataFrame:
        """What a late finder reads of every distinct key: block, ids, length, value."""
        rows = side.filter(F.col(key).isNotNull()).select("block", *_key_id(key, prefix), F.length(key).alias("n"), value.alias("value"))
        return cut_lineage(rows.dropDuplicates(["block", f"{prefix}1", f"{prefix}2"]))

    def _own_pairs(self, left: DataFrame, right: DataFrame) -> DataFrame | None:
        """Carried pairs that late passes with an id check accept: lid, rid, block, steps, ids of the group keys."""
        late = {i: p for i, p in self.late.items() if p.id_check}
        if not late:
            return None
        l, r = left.alias("l"), right.alias("r")

        def value(p: OneToOnePass, side: DataFrame, key: str, name: str) -> Column:
            if isinstance(p.finder, EditGroups):
                return F.col(f"{name}.{key}")
            return F.col(f"{name}.tri") if key == "court" and "tri" in side.columns else T.trigram_codes(f"{name}.{key}")

        def holds(p: OneToOnePass) -> Column:
            lv, rv = value(p, left, p.lkey, "l"), value(p, right, p.rkey, "r")
            return F.when((F.length(f"l.{p.lkey}") > p.lmin) & (F.length(f"r.{p.rkey}") > p.rmin), p.finder.holds(lv, rv))

        steps = F.array_compact(F.array(*[F.when(holds(p), F.lit(i)) for i, p in late.items()]))
        ids = [c for i, p in late.items() for c in _key_id(
            f"{p.group_side}.{p.lkey if p.group_side == 'l' else p.rkey}", f"g{i}_")]
        j = r.join(l, (F.col("r.ref") == F.col("l.lid")) & (F.col("r.block") == F.col("l.block")))
        return cut_lineage(j.select(F.col("l.lid").alias("lid"), F.col("r.rid").alias("rid"), F.col("l.block").alias("block"),
                                    steps.alias("steps"), *ids)).filter(F.size("steps") > 0)

    def _late_pairs(self, i: int, links: DataFrame | None, free_left: DataFrame, free_right: DataFrame) -> DataFrame:
        """Key pairs of the late pass ``i`` between keys with a free row."""
        p, sides = self.passes[i - 1], {}
        for prefix, key, least, free in (("l", p.lkey, p.lmin, free_left), ("r", p.rkey, p.rmin, free_right)):
            ids = ["block", f"{prefix}1", f"{prefix}2"]
            rows = self.values[prefix, key, type(p.finder)].filter(F.col("n") > least).join(free.select(*ids), ids, "left_semi")
            if p.id_check and prefix == p.group_side:
                own = self.own.filter(F.array_contains("steps", i))
                for row_id in ("lid", "rid") if links is not None else ():
                    own = unmatched(own, links, row_id)
                own = own.select("block", F.col(f"g{i}_1").alias(ids[1]), F.col(f"g{i}_2").alias(ids[2]))
                rows = rows.join(own, ids, "left_semi")
            sides[prefix] = persist_scratch(rows.drop("n"))
        return p.finder.pairs(sides["l"], sides["r"], p.group_side)

    @staticmethod
    def _measure(p: OneToOnePass) -> tuple:
        return (p.finder, p.lkey, p.rkey)

    @staticmethod
    def _key_pairs(left: DataFrame, right: DataFrame, p: OneToOnePass) -> DataFrame:
        """block, key ids of both sides (l1, l2, r1, r2), key lengths and scores."""
        pairs = p.finder(left.select("block", F.col(p.lkey).alias("lk"), *p.extra_left),
                         right.select("block", F.col(p.rkey).alias("rk"), *p.extra_right))
        scores = [F.col(c).cast("float").alias(c) if c in pairs.columns else F.lit(None).cast("float").alias(c)
                  for c in ("trigram", "levenshtein")]
        return pairs.select("block", "l1", "l2", "r1", "r2", "llen", "rlen", *scores)

    def same_id(self, first: int, last: int, links: DataFrame | None) -> DataFrame:
        """Links of the same-id passes ``first`` to ``last``, among free rows."""
        free = self.pairs.withColumn("steps", F.filter("steps", lambda s: s.between(first, last)))
        free = free.filter(F.size("steps") > 0)
        sides = {"both": ["lid", "rid"], "left": ["lid"], "right": ["rid"]}[self.passes[first - 1].free]
        if links is not None:
            for row_id in sides:
                free = unmatched(free, links, row_id)
        if "lid" in sides and last > first:  # the first step of any free pair of the left id decides
            step = free.groupBy("lid").agg(F.min(F.array_min("steps")).alias("step"))
            free = free.join(step, "lid").filter(F.array_contains("steps", F.col("step")))
        else:  # a right row has one pair
            free = free.withColumn("step", F.array_min("steps"))
        return self._links(free.withColumn("levenshtein", F.lit(None)))

    def one_to_one(self, i: int, links: DataFrame | None) -> DataFrame:
        """Links of the one-to-one pass ``i``, among rows without a link."""
        p = self.passes[i - 1]

        def free(side: DataFrame, row_id: str, key: str, to: str) -> DataFrame:
            rows = side.filter(F.col(f"{key}_known"))
            if f"_f{i}" in side.columns:
                rows = rows.filter(F.col(f"_f{i}"))
            if links is not None:
                rows = unmatched(rows, links, row_id)
            more, count = [F.max("ref").alias("ref")] if row_id == "rid" else [], F.count(F.lit(1))
            if row_id == "lid" and p.left_weight:
                rows, count = rows.filter(F.col(p.left_weight) > 0), F.sum(p.left_weight)
            return rows.groupBy("block", F.col(f"{key}1").alias(f"{to}1"), F.col(f"{key}2").alias(f"{to}2")).agg(
                count.alias(f"n{to}"), F.max(row_id).alias(row_id), *more)

        free_left, free_right = free(self.left, "lid", p.lkey, "l"), free(self.right, "rid", p.rkey, "r")
        if i in self.late:  # read twice
            free_left, free_right = persist_scratch(free_left), persist_scratch(free_right)
            pairs = self._late_pairs(i, links, free_left, free_right)
        else:
            pairs = self.found.filter(F.col("measure") == self.number[self._measure(p)])
        if p.accept is not None:
            pairs = pairs.filter(p.accept)
        pairs = pairs.join(free_left, ["block", "l1", "l2"]).join(free_right, ["block", "r1", "r2"])
        of = [f"{p.group_side}1", f"{p.group_side}2"]
        g = pairs.groupBy("block", *of).agg(F.sum(F.col("nl") * F.col("nr")).alias("_n"), *[
            F.max(c).alias(c) for c in ("lid", "rid", "ref", "trigram", "levenshtein")]).filter(F.col("_n") == 1)
        if p.id_check:
            g = g.filter(F.col("ref").isNotNull() & (F.col("ref") == F.col("lid")))
        if p.drop_doubles:
            # the A5 anti-joins read the pass result twice each: keep it once
            g = persist_scratch(g)
            g = drop_ambiguous(persist_scratch(drop_ambiguous(g, "lid")), "rid")
        return self._links(g.withColumn("step", F.lit(i)))

    def _links(self, df: DataFrame) -> DataFrame:
        """``df`` (lid, rid, ref, step and scores) as rows of the links table."""
        rules = F.array(*[F.lit(p.rule) for p in self.passes])
        scored = [i for i, p in enumerate(self.passes, 1) if isinstance(p, OneToOnePass) or p.trigram is not None]
        return df.select(
            F.col("lid").cast("string"), F.col("rid").cast("string"), F.element_at(rules, F.col("step")).alias("rule"),
            F.col("ref").cast("string"),
            (F.when(F.col("step").isin(scored), F.col("trigram")) if scored else F.lit(None)).cast("float").alias("trigram"),
            F.col("levenshtein").cast("float"), F.col("step").cast("int"))

    def segments(self) -> list[list[int]]:
        """Steps that are evaluated at once: runs of same-id passes, directions of a one-to-one rule, single others."""
        out: list[list[int]] = []
        for i, p in enumerate(self.passes, 1):
            before = self.passes[i - 2] if i > 1 else None
            if isinstance(p, SameIdPass):
                # a pass that replaces links frees left rows for the next one, unless nothing is linked yet
                together = isinstance(before, SameIdPass) and before.free == p.free and (
                    p.free != "left" or out[-1][0] == 1)
            else:
                together = isinstance(before, OneToOnePass) and p.with_previous
            if together:
                out[-1].append(i)
            else:
                out.append([i])
        return out

    def step(self, steps: list[int], links: DataFrame | None) -> DataFrame:
        """Links that the passes ``steps`` (a segment) add to ``links``."""
        if isinstance(self.passes[steps[0] - 1], SameIdPass):
            return self.same_id(steps[0], steps[-1], links)
        return reduce(DataFrame.unionByName, [self.one_to_one(i, links) for i in steps])

    def independent(self) -> DataFrame:
        """Links that every pass would make on the whole sides, stacked."""
        out = None
        with scratch():
            for i in range(1, len(self.passes) + 1):
                new = self.step([i], None)
                out = new if out is None else out.unionByName(new)
            return cut_lineage(out)


@dataclass
class CascadeResult:
    links: DataFrame
    left_unmatched: DataFrame
    right_unmatched: DataFrame


def run_cascade(left: DataFrame, right: DataFrame, passes: list[Pass], purge_doubles: bool = True) -> CascadeResult:
    """Run ``passes`` in order; M31 purge; M33 unmatched sets.

    ``left``: lid, block, ... ; ``right``: rid, block, ref, ...  Keys are cast
    to string in the links table.
    """
    m = Matcher(left, right, passes)
    links = None
    for steps in m.segments():
        with scratch():
            new = m.step(steps, links)
            if links is not None:
                p = passes[steps[0] - 1]
                if isinstance(p, SameIdPass) and p.free == "left":
                    new = persist_scratch(new)
                    links = unmatched(links, new, "rid")
                new = links.unionByName(new)
            links = cut_lineage(new)  # eager: materialised here
    if links is None:
        links = left.sparkSession.createDataFrame([], LINK_SCHEMA)
    if purge_doubles:
        links = drop_ambiguous(links, "lid")
    return CascadeResult(links, unmatched(left, links, "lid"), unmatched(right, links, "rid"))
