"""Chat formatting by perspective rotation (operator 8), in DataFrame functions only.

Every participant of a conversation gets a rendering of the whole dialogue in
which that participant is the assistant and all others are named users.  The
mask has one character per character of the rendering: ``1`` where the loss
counts (what the assistant of this rendering says, and its end mark), else
``0``.  System turns are instructions: shown in every rendering, never trained,
and no participant of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
UNNAMED = "unknown"
END = "<|end|>\n"


def _plain_name(name: Column) -> Column:
    for sign in '%"<|>\n\r':  # the percent sign first: it stands for all others
        name = F.replace(name, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return name


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, participant, n_turns, rendered, mask, n_trained.

    ``conversations`` has conv_id, turn, role, text; other columns are
    ignored.  Turns are ordered by turn, then role, then text; null turns come
    first, repeated rows are repeated turns.  A null or blank role is the
    speaker ``unknown``; a null text is empty.  ``<|`` inside a text is
    written ``< |``; of a name, ``%``, ``"``, ``<``, ``|``, ``>`` and line ends
    are written as ``%`` and two hex digits.  So no text or name can pass for a
    mark, and different names stay different.  Rows without a conv_id belong to
    no conversation; a conversation of system turns alone has no participant;
    both give no row.

    A rendering is one value, so a conversation's turns meet in one row, as
    they do in the result; different conversations never share a group.
    """
    speaker = F.when(F.trim(F.coalesce("role", F.lit(""))) == "", UNNAMED).otherwise(F.col("role"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct(F.col("turn").alias("turn"), speaker.alias("speaker"),
                            F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text")).alias("said"))
    dialogues = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    seats = F.filter(F.array_distinct(F.transform("turns", lambda t: t["speaker"])), lambda s: s != SYSTEM)
    views = dialogues.select("conv_id", "turns", F.explode(seats).alias("participant"))

    def own(t: Column) -> Column:
        return t["speaker"] == F.col("participant")

    def head(t: Column) -> Column:
        return (F.when(own(t), "<|assistant|>\n").when(t["speaker"] == SYSTEM, "<|system|>\n")
                .otherwise(F.concat(F.lit('<|user name="'), _plain_name(t["speaker"]), F.lit('"|>\n'))))

    def body(t: Column) -> Column:
        return F.concat(t["text"], F.lit(END))

    def marks(t: Column) -> Column:
        return F.concat(F.repeat(F.lit("0"), F.length(head(t))), F.repeat(F.when(own(t), "1").otherwise("0"), F.length(body(t))))

    return views.select(
        "conv_id", "participant", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), body(t))), "").alias("rendered"),
        F.array_join(F.transform("turns", marks), "").alias("mask"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda n, t: n + F.when(own(t), F.length(body(t))).otherwise(0)).alias("n_trained"))
