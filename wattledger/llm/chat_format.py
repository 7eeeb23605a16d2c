"""Chat formatting by prefix-target expansion.

A conversation is written as one text, turn after turn:

    <|turn|>role newline text<|end|>

and every assistant turn becomes an example of its own: the text from the conversation's start
to that reply's end, of which only the reply is trainable. Control strings inside roles and
texts are escaped, so that none can be taken for a mark: a backslash becomes two, the first
character of a control string becomes a backslash and a letter; the way back is exact.

Only built-in expressions. A null role or text is empty, rows of one conversation are ordered
by turn (nulls first), then role and text; rows without a conversation id are one
conversation. Repeated rows are turns of their own. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"

#: Strings that mark turns, here or in other common templates (fixed values); all are escaped.
CONTROL = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>")

TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, r"<(?=\||/?s>)", r"\\l")
    return F.regexp_replace(text, r"\[(?=/?INST\])", r"\\b")


def unescape(text: Column) -> Column:
    """The way back. Two backslashes are one character, so the text is cut there first."""
    return F.array_join(
        F.transform(
            F.split(text, r"\\\\"),
            lambda part: F.replace(
                F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")),
                F.lit("\\n"),
                F.lit("\n"),
            ),
        ),
        "\\",
    )


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0), segment, and for assistant turns loss_start and loss_end:
    where the reply stands in the conversation's text, in code points, end exclusive."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # A role ends at the line's end, so one inside it is escaped too.
    head = F.concat(
        F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n")
    )
    body = escape(F.col("text"))
    pieces = turns.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(END)
    placed = pieces.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("position"),
        F.coalesce(F.sum(length).over(before), F.lit(0)).alias("start"),
        "role",
        "head",
        "body",
    )
    target = F.col("role") == TARGET_ROLE
    loss_start = F.col("start") + F.length("head")
    return placed.select(
        "conv_id",
        "position",
        F.concat("head", "body", F.lit(END)).alias("segment"),
        F.when(target, loss_start).alias("loss_start"),
        F.when(target, loss_start + F.length("body")).alias("loss_end"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted (the whole text), targets (an array of position, loss_start and
    loss_end, one for each assistant turn, in order)."""
    gathered = format_turns(conversations).groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("position", "segment", "loss_start", "loss_end"))
        ).alias("turns")
    )
    targets = F.filter("turns", lambda t: t["loss_start"].isNotNull())
    return gathered.select(
        "conv_id",
        F.array_join("turns.segment", "").alias("formatted"),
        F.transform(
            targets, lambda t: F.struct(t["position"], t["loss_start"], t["loss_end"])
        ).alias("targets"),
    )


def expand_examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, position, text (everything from the start of the
    conversation to the end of the reply), loss_start, loss_end. Conversations without an
    assistant turn give none."""
    return formatted.select("conv_id", "formatted", F.explode("targets").alias("target")).select(
        "conv_id",
        "target.position",
        F.substring("formatted", F.lit(1), F.col("target.loss_end").cast("int")).alias("text"),
        F.col("target.loss_start"),
        F.col("target.loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """role and text of every turn, from a formatted text: array of structs."""
    segments = F.slice(F.split(formatted, F.lit(r"<\|turn\|>")), 2, 1 << 30)
    return F.transform(
        segments,
        lambda s: F.struct(
            unescape(F.substring_index(s, "\n", 1)).alias("role"),
            unescape(
                F.substring(
                    s,
                    F.instr(s, "\n") + 1,
                    F.length(s) - F.instr(s, "\n") - len(END),
                )
            ).alias("text"),
        ),
    )


def read_loss(examples: DataFrame) -> DataFrame:
    """The examples with `reply`: the trainable text, cut out by its marks and unescaped."""
    start, end = F.col("loss_start"), F.col("loss_end")
    cut = F.substring("text", (start + 1).cast("int"), (end - start).cast("int"))
    return examples.withColumn("reply", unescape(cut))
