"""Chat formatting: root-to-leaf paths of reply trees, each one conversation.

Self-joins that double the length of known path pieces enumerate the paths;
branches are ranked by the sum of their messages' scores. The chosen paths are
written with a template whose control strings cannot occur inside texts: four
characters are escaped, reversibly. The loss mask is the list of (start, length)
code-point ranges of assistant texts in the output.

Null texts and roles are empty strings. Messages whose parent is missing or
is their own are roots; messages that only a cycle reaches belong to no path.
Repeated message ids of one conversation keep the row of the smallest text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The template's control strings, and the escapes of its characters.
OPEN, SHUT, END = "<|", "|>", "<|end|>"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))


def escape(col):
    for plain, coded in ESCAPES:
        col = F.replace(col, F.lit(plain), F.lit(coded))
    return col


def unescape(col):
    for plain, coded in reversed(ESCAPES):
        col = F.replace(col, F.lit(coded), F.lit(plain))
    return col


def paths(messages: DataFrame) -> DataFrame:
    """conv, leaf, path_score, rank and msg_ids (root first) of every leaf of
    ``messages`` (conv, msg, parent, score). A piece runs from a message up to
    ``top``, whose parent starts the piece it is joined with, so pieces double
    with each join."""
    m = messages.select("conv", "msg", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = m.select("conv", F.col("msg").alias("parent")).withColumn("found", F.lit(True))
    linked = m.join(known, ["conv", "parent"], "left").withColumn(
        "parent", F.when(F.col("found") & (F.col("parent") != F.col("msg")), F.col("parent")))
    pieces = stored(linked.select("conv", "msg", F.col("parent").alias("up"), F.array("msg").alias("ids"), "score"), "paths")
    inner = linked.where("parent is not null").select("conv", F.col("parent").alias("msg")).distinct()
    steps = 1
    count = pieces.count()
    while True:
        above = pieces.select("conv", F.col("msg").alias("up"), F.col("up").alias("up2"), F.col("ids").alias("ids2"), F.col("score").alias("score2"))
        joined = pieces.where("up is not null").join(above, ["conv", "up"]).select(
            "conv", "msg", F.col("up2").alias("up"), F.concat("ids2", "ids").alias("ids"), (F.col("score") + F.col("score2")).alias("score"))
        pieces = stored(pieces.where("up is null").unionByName(joined), "paths")
        steps *= 2
        if steps > count or not pieces.where("up is not null").head(1):
            break
    leaves = pieces.where("up is null").join(inner, ["conv", "msg"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("score").desc(), "msg"))
    return leaves.select("conv", F.col("msg").alias("leaf"), F.col("score").alias("path_score"), rank.alias("rank"), F.col("ids").alias("msg_ids"))


def format_paths(chosen: DataFrame, messages: DataFrame) -> DataFrame:
    """conv, leaf, formatted and loss_mask of the chosen paths."""
    on_path = chosen.select("conv", "leaf", F.posexplode("msg_ids").alias("pos", "msg"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SHUT))
    body = escape(F.col("text"))
    turns = on_path.join(messages.select("conv", "msg", F.coalesce("role", F.lit("")).alias("role"),
                                         F.coalesce("text", F.lit("")).alias("text")), ["conv", "msg"]) \
        .select("conv", "leaf", "pos", "role", head.alias("head"), body.alias("body"))
    so_far = Window.partitionBy("conv", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    width = F.char_length("head") + F.char_length("body") + F.lit(len(END))
    turns = turns.withColumn("start", F.coalesce(F.sum(width).over(so_far), F.lit(0)) + F.char_length("head"))
    listed = turns.groupBy("conv", "leaf").agg(F.sort_array(F.collect_list(F.struct(
        "pos", F.concat("head", "body", F.lit(END)).alias("turn"), "start", F.char_length("body").alias("length"),
        (F.col("role") == "assistant").alias("loss")))).alias("t"))
    return listed.select("conv", "leaf", F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"),
                         F.transform(F.filter("t", lambda t: t["loss"]), lambda t: F.struct(
                             t["start"].alias("start"), t["length"].alias("length"))).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, all
    taken from the output text and its mask."""
    cut = F.split("formatted", r"<\|end\|>")
    turns = F.transform(F.slice(cut, 1, F.size(cut) - 1), lambda t: F.concat(
        unescape(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), SHUT, 1)), F.lit("\n"),
        unescape(F.substring_index(t, SHUT, -1)), F.lit("\n")))
    loss = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"]))), "")
    return formatted.select(
        F.col("conv").alias("conv_id"), (F.size(cut) - 1).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def tree_of_turns(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees: each row answers the one before it (equal
    turns by role, then text)."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    c = conversations.select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    c = c.withColumn("msg", F.row_number().over(order).cast("long"))
    return c.select("conv", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"),
                    F.char_length(F.coalesce("text", F.lit(""))).cast("double").alias("score"), "role", "text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The best path of every conversation, formatted."""
    messages = stored(tree_of_turns(conversations.where("conv_id is not null")), "messages")
    return format_paths(paths(messages).where("rank = 1"), messages)
