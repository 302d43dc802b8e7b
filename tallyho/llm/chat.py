"""Chat formatting from an event log.

Events ``(conv_id, seq, msg, kind, role, text)`` say how a conversation came about: `delta`
appends text to a message, `edit` replaces its text, `regenerate` empties it for the deltas
that follow.  Folding the events of a message in order of seq gives its final text; a
conversation's messages in order of their first event are its turns, which are then rendered.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template: each turn is START role SEP text END.  All control strings begin with "<",
# which never occurs in an escaped text.
START, SEP, END = "<|turn|>", "<|text|>", "</s>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Text without "<": the escape character becomes \\b, "<" becomes \\l."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    """The text that was escaped; every escape character begins one of the two pairs."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, first, role, text`` of an event log.

    Of a message's events only those from its last edit or regeneration on count.  The role
    is that of the message's first event that has one.  Null texts are empty; an unknown
    kind is a delta.  Events with equal seq are taken in order of kind and text.
    """
    message = Window.partitionBy("conv_id", "msg").orderBy("seq", "kind", "text")
    resets = F.when(F.col("kind").isin("edit", "regenerate"), 1).otherwise(0)
    rows = events.select("conv_id", "msg", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "role",
                         F.coalesce("text", F.lit("")).alias("text"))
    # the number of resets up to each event; only events of the last reset are text
    rows = rows.withColumn("_era", F.sum(resets).over(message)).withColumn("_nth", F.row_number().over(message))
    last = Window.partitionBy("conv_id", "msg")
    rows = rows.withColumn("_last", F.max("_era").over(last))
    parts = F.collect_list(F.when((F.col("_era") == F.col("_last")) & (F.col("kind") != "regenerate"),
                                  F.struct("_nth", "text")))
    return (rows.groupBy("conv_id", "msg")
            .agg(F.min("seq").alias("first"), F.sort_array(parts).alias("_parts"),
                 F.min_by("role", F.when(F.col("role").isNotNull(), F.col("_nth"))).alias("role"))
            .select("conv_id", "first", F.col("msg"), "role",
                    F.array_join(F.transform("_parts", lambda x: x["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, mask`` of each conversation's messages in order.

    ``mask`` lists (from, chars) of the formatted text, from counted from 1, that the loss is
    taken on: the assistant's escaped texts.
    """
    turn = Window.partitionBy("conv_id").orderBy("first", "msg")
    head = F.concat(F.lit(START), escaped(F.coalesce("role", F.lit(""))), F.lit(SEP))
    rows = messages.select("conv_id", "first", "msg", "role", head.alias("_head"), escaped(F.col("text")).alias("_body"))
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(END)))
    rows = rows.withColumn("_nth", F.row_number().over(turn)).withColumn(
        "_before", F.sum(F.length("_piece").cast("long")).over(turn) - F.length("_piece"))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct((F.col("_before") + F.length("_head") + 1).cast("int").alias("from"),
                                                       F.length("_body").alias("chars")))
    return (rows.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("_nth", "_piece"))).alias("_pieces"),
                 F.sort_array(F.collect_list(span)).alias("mask"))
            .select("conv_id", F.array_join(F.transform("_pieces", lambda x: x["_piece"]), "").alias("formatted"), "mask"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    turns = F.filter(F.split(formatted, END), lambda x: x != "")
    return F.transform(turns, lambda x: F.struct(
        unescaped(F.substring_index(F.replace(x, F.lit(START), F.lit("")), SEP, 1)).alias("role"),
        unescaped(F.substring_index(x, SEP, -1)).alias("text")))


def table_events(conversations: DataFrame) -> DataFrame:
    """A conversation table (conv_id, turn, role, text) as an event log: a row is one message's delta.

    Rows that share conversation and turn are messages of their own, in order of role and text.
    """
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_tie", F.row_number().over(same))
    return rows.select("conv_id", F.struct("turn", "_tie").alias("seq"), F.struct("turn", "_tie").alias("msg"),
                       F.lit("delta").alias("kind"), "role", "text")


def digests(rendered: DataFrame) -> DataFrame:
    """What the formatted texts hold, read back from them.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    rows = rendered.withColumn("_turns", parse(F.col("formatted")))
    under = F.transform("mask", lambda m: F.substring(F.col("formatted"), m["from"], m["chars"]))
    rows = rows.withColumn("_loss", F.array_join(F.transform(under, unescaped), ""))
    lines = F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return rows.select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
                       F.length("_loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Formatted conversations ``conv_id, formatted, mask`` of a table (conv_id, turn, role, text).

    Null texts and roles are empty; rows without conv_id are one conversation; other columns
    are not read; an empty table gives an empty result.  A conversation is one output row,
    so its turns meet in one task; nothing larger does.  Dealing by conversation first
    serves every window and grouping after it, so texts are shuffled once.
    """
    return render(fold(table_events(conversations.select("conv_id", "turn", "role", "text").repartition("conv_id"))))
