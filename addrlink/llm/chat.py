"""Operator 13: chat formatting by prefix-target expansion [native].

A conversation becomes one training example for each assistant turn: all turns
before it are context, and the text of that reply alone is trainable.  A turn
is written as

    ### <role>: <text></turn>

and a line feed.  The control strings of this template cannot occur in a
written text: ``### `` and ``</turn>`` get a backslash (``##\\# ``,
``<\\/turn>``), and where the text itself has backslashes at that place one more
is added, so reading takes exactly one away.  Roles have ``\\``, ``:``, ``#``
and ``<`` spelled out (``\\\\``, ``\\c``, ``\\h``, ``\\l``).

As every example is a beginning of the written conversation, a conversation is
written once and its examples are cut from it; the cut rows stay where they are,
so nothing but the turns themselves is shuffled.  Turns behind the last reply
are context of no example; a conversation that ends with them (or has no reply)
gives one more row, without a trainable part, so that every turn is written.

A conversation is the unit of the output and is gathered in one row (2 GB at
most, as any Spark string); it is never spread over groups or cut.

Cases: null texts and roles count as ''; rows with a null conv_id make up one
conversation; turns are ordered by (turn, role, text), nulls first, so ties and
repeated rows have a fixed order and are all written; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
START, MIDDLE, END = "### ", ": ", "</turn>"
#: Characters of a role that the template uses, and how they are spelled out.
SPELLED = {"\\": "\\\\", ":": "\\c", "#": "\\h", "<": "\\l"}


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"##(\\*)# ", r"##\\$1# ")
    return F.regexp_replace(text, r"<(\\*)/turn>", r"<\\$1/turn>")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"##\\(\\*)# ", r"##$1# ")
    return F.regexp_replace(text, r"<\\(\\*)/turn>", r"<$1/turn>")


def escape_role(role: Column) -> Column:
    for c, spelled in SPELLED.items():
        role = F.replace(role, F.lit(c), F.lit(spelled))
    return role


def unescape_role(role: Column) -> Column:
    # a doubled backslash opens no other spelling: read between them
    def read(part: Column) -> Column:
        for c, spelled in SPELLED.items():
            if c != "\\":
                part = F.replace(part, F.lit(spelled), F.lit(c))
        return part

    return F.array_join(F.transform(F.split(role, r"\\\\", -1), read), "\\")


def written(turns: DataFrame) -> DataFrame:
    """conv_id, whole (the written conversation) and turns: role, text start, text end, turn end and number of each.

    Places are characters of ``whole`` from 0, ends exclusive.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    rows = turns.select("conv_id", "turn", text("role"), text("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit(MIDDLE))
    rows = rows.select("*", F.length(head).cast("long").alias("head"),
                       F.concat(head, escape(F.col("text")), F.lit(END + "\n")).alias("piece"))
    rows = rows.withColumn("n", F.length("piece").cast("long"))
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"end": F.sum("n").over(so_far), "number": F.count("*").over(so_far)})
    turn = F.struct((F.col("end") - F.col("n") + F.col("head")).alias("start"), F.col("end"), F.col("number"),
                    F.col("role"), F.col("piece"))
    df = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return df.select("conv_id", F.array_join("turns.piece", "").alias("whole"), F.transform("turns", lambda t: F.struct(
        t.role.alias("role"), t.start.alias("start"), (t.end - len(END + "\n")).alias("stop"),
        t.end.alias("end"), t.number.alias("number"))).alias("turns"))


def examples(turns: DataFrame, trained: str = ASSISTANT) -> DataFrame:
    """One row per reply of role ``trained``, and one for the turns behind the last reply.

    conv_id, example (from 0), n_turns, complete (the row has all turns), text,
    loss_start and loss_end (the trainable characters of ``text``, from 0, end
    exclusive; null in a row without a reply).
    """
    df = written(turns)
    none = F.lit(None).cast("long")

    def cut(t: Column, start: Column, stop: Column) -> Column:
        return F.struct(t.number.alias("n_turns"), t.end.alias("end"), start.alias("loss_start"), stop.alias("loss_end"))

    replies = F.transform(F.filter("turns", lambda t: t.role == trained), lambda t: cut(t, t.start, t.stop))
    last = F.element_at("turns", -1)
    rest = F.when(last.role != trained, F.array(cut(last, none, none))).otherwise(F.slice(replies, 1, 0))
    df = df.select("conv_id", "whole", F.size("turns").cast("long").alias("all"),
                   F.posexplode(F.concat(replies, rest)).alias("example", "c"))
    return df.select("conv_id", "example", "c.n_turns", (F.col("c.n_turns") == F.col("all")).alias("complete"),
                     F.expr("substring(whole, 1, cast(c.end as int))").alias("text"), "c.loss_start", "c.loss_end")


def loss_text(rows: DataFrame) -> Column:
    """The trainable text of an example as the reply said it; null without one."""
    return unescape(F.expr("substring(text, cast(loss_start + 1 as int), cast(loss_end - loss_start as int))"))


def read_turns(text: Column) -> Column:
    """The turns written in ``text``: an array of role and text."""
    parts = F.split(text, END + "\n", -1)

    def read(part: Column) -> Column:
        at = F.instr(part, MIDDLE)
        return F.struct(unescape_role(F.substring(part, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
                        unescape(F.substring(part, at + len(MIDDLE), F.length(part))).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), read)


def read_back(rows: DataFrame) -> DataFrame:
    """Per conversation what its examples say: n_turns, digests of all turns and of all trainable text, sizes."""
    turns = F.when(F.col("complete"), read_turns(F.col("text")))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = rows.select("conv_id", "example", F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       loss_text(rows).alias("loss"), F.length("text").cast("long").alias("chars"), "complete")
    df = read.groupBy("conv_id").agg(
        F.max(F.when(F.col("complete"), F.col("n_turns"))).alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    df = df.withColumn("loss", F.array_join("loss.loss", ""))
    return df.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                     F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
