"""Quotation linking: reply-ordered conversations without quotes.

Lines are parsed into quote levels, quoted lines are normalised and hashed, and each is joined to the latest earlier
message of its conversation that says the same in its own words. The message that most of the nearest level's lines
come from is the one replied to. All of it is SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.llm.shared import land, let, numbered

QUOTE = "^(?:[ \\t]*>)+"
#: Lines that introduce a quote.
ATTRIBUTION = "^(?:On|Am|Le|El) .{1,200} (?:wrote|schrieb|a écrit|escribió)[ ]?:[ ]*$"
#: Messages of a conversation whose equal lines meet in one task; links are carried from block to block.
BLOCK = 4096


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), "[\\s\\p{Z}]+", " "))


def _introduces(lines: Column, line: Column, i: Column) -> Column:
    """Whether the i-th line (from 0) announces a quote: it reads like it, and a quoted line follows, after at most
    one blank line."""
    following, after = F.get(lines, i + 1), F.get(lines, i + 2)
    quoted = following.rlike(QUOTE) | ((F.trim(following) == "") & after.rlike(QUOTE))
    return line.rlike(ATTRIBUTION) & F.coalesce(quoted, F.lit(False))


def own_text(text: Column) -> Column:
    """The text without quoted lines, the lines that introduce quotes, and blank lines at either end."""
    own = let(F.split(text, "\n"), lambda lines: F.array_join(F.filter(
        lines, lambda line, i: ~line.rlike(QUOTE) & ~_introduces(lines, line, i)), "\n"))
    return F.regexp_replace(own, "^\\s+|\\s+$", "")


def _lines(messages: DataFrame) -> DataFrame:
    """A row for each kind of line with words in a message: its level (0: own) and the hash of its normal form."""
    line = F.col("line")
    quoted = F.regexp_extract(line, QUOTE, 0)
    told = let(F.split("text", "\n"), lambda lines: F.filter(lines, lambda line, i: ~_introduces(lines, line, i)))
    parsed = messages.where("text IS NOT NULL").select("conv_id", "turn", F.explode(told).alias("line")).select(
        "conv_id", "turn", F.length(F.regexp_replace(quoted, "[^>]", "")).alias("level"),
        normalised(F.substring(line, F.length(quoted) + 1, F.length(line))).alias("words"))
    return parsed.where("words != ''").select(
        "conv_id", "turn", "level", F.xxhash64("words").alias("passage")).distinct()


def _sources(lines: DataFrame) -> DataFrame:
    """For each quoted line the latest earlier turn of the conversation with that line of its own, as `source`.

    Equal lines of a conversation are looked through in blocks of turns, and what a block ends with is carried on
    to the next, so a line that a long conversation repeats all the time fills no single task.
    """
    placed = lines.withColumn("block", F.floor(F.col("turn") / BLOCK)).withColumn(
        "said", F.when(F.col("level") == 0, F.col("turn")))
    passage = ["conv_id", "passage"]
    # A quote comes before the message's own lines, as it refers to earlier ones.
    within = Window.partitionBy(*passage, "block").orderBy("turn", F.desc("level"))
    found = placed.withColumn("near", F.last("said", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = placed.groupBy(*passage, "block").agg(F.max("said").alias("said"))
    earlier = Window.partitionBy(*passage).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*passage, "block", F.last("said", ignorenulls=True).over(earlier).alias("far")).where(
        "far IS NOT NULL")
    quotes = found.where("level > 0").join(carried, [*passage, "block"], "left")
    return quotes.select("conv_id", "turn", "level", F.coalesce("near", "far").alias("source"))


def _parents(sources: DataFrame) -> DataFrame:
    """The turn replied to: the most frequent source of the nearest level that has one, the latest if several."""
    votes = sources.where("source IS NOT NULL").groupBy("conv_id", "turn", "level", "source").agg(
        F.count("*").alias("votes"))
    best = F.max(F.struct((-F.col("level")).alias("nearness"), "votes", "source"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("best")).select(
        "conv_id", "turn", F.col("best.source").alias("parent"))


def _threads(replies: DataFrame) -> DataFrame:
    """For each (conv_id, turn, parent) the first turn of its thread and the number of replies up to it.

    Each round doubles the steps that every message has gone up, so a chain of n replies takes log2(n) rounds.
    """
    above = land(replies.select("conv_id", "turn", "parent", F.coalesce("parent", "turn").alias("thread"),
                                F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")), "threads")
    while True:
        upper = above.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"),
                             F.col("depth").alias("more"))
        joined = above.join(upper, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", "parent", F.coalesce("next", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce(F.col("more") > 0, F.lit(False)).alias("moved"))
        above = land(joined, "threads")
        if above.where("moved").isEmpty():
            return above.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """One row a message: conv_id, turn, role, parent (the turn replied to), thread (its first turn), depth,
    reply_order (its place in the thread: replies follow what they reply to) and text without quotes.

    A message whose quotes lead nowhere, or without any, begins a thread. A null text has no lines and stays null;
    a message with a null conv_id or turn is a thread by itself. Repeated rows come out as often as they come in.
    """
    read = messages.select("conv_id", "turn", "role", "text")
    parents = _parents(_sources(land(_lines(read), "quote_lines")))
    turns = read.select("conv_id", "turn").distinct().join(parents, ["conv_id", "turn"], "left")
    order = ["conv_id", "thread", "depth", "turn"]
    threads = land(numbered(_threads(turns), order, {"place": F.lit(1)}, "reply_order"), "reply_places")
    first = threads.groupBy("conv_id", "thread").agg(F.min("place").alias("first_place"))
    placed = land(threads.join(land(first, "thread_starts"), ["conv_id", "thread"], "left").select(
        "conv_id", "turn", "parent", "thread", "depth",
        F.coalesce(F.col("place") - F.col("first_place"), F.lit(0)).alias("reply_order")), "replies")
    return read.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "parent", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("reply_order", F.lit(0)).cast("bigint").alias("reply_order"),
        own_text(F.col("text")).alias("text"))


def quoting(chats: DataFrame) -> DataFrame:
    """Chats as mails: every message but the first quotes the one it answers, and below it what that one answered.

    The answered turn is the one before, or two before for every fifth turn. The result is a derived input for
    `conversations`, with one message a turn: of several the least by role and text.
    """
    one = chats.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("m")).select(
        "conv_id", "turn", "m.role", "m.text")
    answered = F.col("turn") - F.when(F.col("turn") % 5 == 4, 2).otherwise(1)

    def quote(text: Column, mark: str) -> Column:
        return F.concat(F.lit(mark), F.regexp_replace(text, "\n", f"\n{mark}"), F.lit("\n"))

    first = one.select("conv_id", F.col("turn").alias("turn_1"), F.col("role").alias("role_1"),
                       F.col("text").alias("text_1"), answered.alias("turn_2"))
    second = one.select("conv_id", F.col("turn").alias("turn_2"), F.col("text").alias("text_2"))
    above = one.withColumn("turn_1", answered).join(first, ["conv_id", "turn_1"], "left").join(
        second, ["conv_id", "turn_2"], "left")
    head = F.concat(F.lit("On turn "), F.col("turn_1").cast("string"), F.lit(" "), F.col("role_1"), F.lit(" wrote:\n"))
    return above.select("conv_id", "turn", "role", F.concat(
        F.coalesce(F.concat(head, F.coalesce(quote(F.col("text_2"), "> > "), F.lit("")),
                            quote(F.col("text_1"), "> ")), F.lit("")), F.col("text")).alias("text"))
