"""Quotation linking in conversations, in DataFrame operations only.

A line's quote level is the number of signs > at its start.  Neighbouring lines of one level, up to a line without words, are
a passage; passages and, of LINE_WORDS words or more, single lines are normalised (lower case, single spaces) and hashed.
A quoted one is joined to the message of its conversation that has it first, unquoted.  A message replies to the latest
earlier message that its least quoted passages lead to.  Threads - a message and all that replies lead to - come from pointer
jumping; each row carries the turn of its thread's first message, so (conv_id, root_turn, turn) is the reply order: a
reply stands behind what it replies to.  Texts are returned without quotes and the lines that announce them.

Defined results: a null text counts as empty; a null role stays null; conv_id or turn may be null: null conversations are one
conversation, and a message without a turn links to none and is linked by none; rows equal in all four columns count once;
messages of one conversation and turn are told apart by a hash of role and text; ties go to the smaller turn, then hash; an
empty table gives no rows; other columns aren't read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import common

LINE_WORDS = 3
QUOTE = "^[ \\t]*(?:>[ \\t]?)+"
ANNOUNCES = "(?i)\\b(wrote|writes|schrieb|escribió|a écrit)[ \\t]*:[ \\t]*$"
BLANK = "^[ \\t-\\r]*$"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, "[ \\t-\\r]+", " "), F.lit(" ")))


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a key of each distinct message."""
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    null = F.lit("\0")
    return own.distinct().withColumn("key", F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), null), F.coalesce(F.col("turn").cast("string"), null), F.coalesce("role", null), "text"))


def without_quotes(text: Column) -> Column:
    """The lines that are no quotes and don't announce one, without blank lines at either end."""
    lines = F.split(text, "\n", -1)

    def kept(own: Column) -> Column:
        quoted = lambda i: F.coalesce(F.get(own, i).rlike(QUOTE), F.lit(False))
        announced = lambda x, i: x.rlike(ANNOUNCES) & (quoted(i + 1) | (F.coalesce(F.get(own, i + 1).rlike(BLANK), F.lit(False)) & quoted(i + 2)))
        return F.filter(own, lambda x, i: ~x.rlike(QUOTE) & ~announced(x, i))

    bare = F.array_join(F.transform(F.array(lines), kept)[0], "\n")
    return F.when(text.rlike("(?m)" + QUOTE), F.regexp_replace(F.regexp_replace(bare, "\\A(?:[ \\t-\\r]*\\n)+", ""), "[ \\t-\\r]+\\z", "")).otherwise(text)


def passages(told: DataFrame) -> DataFrame:
    """conv_id, turn, key, level, hash of the passages and longer lines of each message."""
    lines = told.select("conv_id", "turn", "key", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    lines = lines.select("conv_id", "turn", "key", "at", level(F.col("line")).alias("level"), normalised(F.regexp_replace("line", QUOTE, "")).alias("body"))
    row = Window.partitionBy("key").orderBy("at")
    starts = (F.col("level") != F.lag("level").over(row)) | (F.lag("body").over(row) == "")
    lines = lines.withColumn("passage", F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(row)).filter("body <> ''")
    whole = lines.groupBy("conv_id", "turn", "key", "level", "passage").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ").alias("body"), F.count(F.lit(1)).alias("n"))
    long = lines.filter(F.size(F.split("body", " ")) >= LINE_WORDS).select("conv_id", "turn", "key", "level", "body")
    return whole.select("conv_id", "turn", "key", "level", "body").unionAll(long).select("conv_id", "turn", "key", "level", F.xxhash64("body").alias("hash"))


def parents(told: DataFrame) -> DataFrame:
    """key, parent, parent_turn of the messages that reply to another."""
    held = passages(told).filter("turn is not null").withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    # Written before it's joined, so that the join can split the quotes of a passage that very many messages quote.
    first = common.checkpointed(held.filter("level = 0").groupBy("conv", "hash").agg(F.min(F.struct("turn", "key")).alias("original")))
    quoted = held.filter("level > 0").groupBy("conv", "hash", "turn", "key").agg(F.min("level").alias("level"))
    linked = quoted.join(first, ["conv", "hash"]).filter("original.turn < turn")
    best = linked.groupBy("key").agg(F.min(F.struct("level", (-F.col("original.turn")).alias("back"), F.col("original.key").alias("parent"))).alias("best"))
    return best.select("key", F.col("best.parent").alias("parent"), (-F.col("best.back")).alias("parent_turn"))


def rooted(replies: DataFrame) -> DataFrame:
    """key, root, depth of the messages that reply, by pointer jumping; replies: (key, parent)."""
    at = common.checkpointed(replies.select("key", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        further = at.select(F.col("key").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        jumped = common.checkpointed(at.join(further, "root", "left").select("key", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        at = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return at


def threads(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, parent_turn (null if it's no reply), root_turn and depth of every message."""
    told = common.checkpointed(messages(conversations))
    replies = common.checkpointed(parents(told))
    turns = told.select(F.col("key").alias("root"), F.col("turn").alias("root_turn"))
    ends = replies.select("key", "parent_turn").join(rooted(replies), "key").join(turns, "root").select("key", "parent_turn", "root_turn", "depth")
    out = told.join(ends, "key", "left")
    return out.select("conv_id", "turn", "role", without_quotes(F.col("text")).alias("text"), "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"))
