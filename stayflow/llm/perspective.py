"""Chat formatting for several parties: one rendering for every participant.

In the rendering of a participant their own turns are the assistant's, the turns of all
others those of users with their names, and system turns stay as they are. A rendering is
given as its messages, one row each, with the place of the message and of the text to be
learned in the whole rendering, so that no conversation is gathered in one place.

Places are running totals of lengths over the messages of a rendering, in ranges: rows are
range partitioned on rendering, turn, speaker, text and a row number, so that a conversation
of any size, with any number of equal turns or equal rows, is spread over many tasks, and
the totals of earlier ranges are added.

Only DataFrame functions are used. Defined cases: null and empty texts are empty messages;
turns that tie follow in the order of role and text, and repeated rows are repeated
messages; null turns come first; a null role is a user without a rendering of its own; a
null id is one conversation; a conversation with no participant gives no rows; markers
inside a text are broken up; other columns are left alone.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayflow.operators.ordered import running_totals
from stayflow.session import materialize

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
UNNAMED = "unknown"


def rotate(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, turn, speaker, form, message, start, learn_start, learn_length) of every message of every rendering.

    Lengths and places count characters. ``learn_start`` and ``learn_length`` are null
    but for the assistant's own turns, where they cover the text and the end marker.
    """
    turns = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("speaker"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("<\\|")).alias("body"),
    )
    turns = materialize(turns.withColumn("row", F.monotonically_increasing_id()), "turns")  # so that the row numbers stay as they are
    parties = turns.filter(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)).select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")).distinct()
    rows = turns.join(parties, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    form = F.when(F.col("speaker") == F.col("perspective"), "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    head = F.concat(F.lit(BEGIN), "form", F.when(F.col("form") == "user", F.concat(F.lit(" name="), F.coalesce("speaker", F.lit(UNNAMED)))).otherwise(""), F.lit("\n"))
    rows = rows.withColumn("form", form).withColumn("head", head).withColumn("message", F.concat("head", "body", F.lit(END)))
    # a null id is a conversation too, and no id reads like it
    rendering = F.when(F.col("conv_id").isNotNull(), F.concat(F.lit("v"), F.col("conv_id").cast("string"))).otherwise("n")
    rows = rows.withColumns({"size": F.length("message").cast("bigint"), "conv_key": rendering})
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("speaker"), F.col("body"), F.col("row")]
    placed = running_totals(rows, order, ["size"], ["conv_key", "perspective"])
    start = F.col("size_before")
    own = F.col("form") == "assistant"
    return placed.select(
        "conv_id", "perspective", "turn", "speaker", "form", "message", start.alias("start"),
        F.when(own, start + F.length("head")).alias("learn_start"), F.when(own, F.length("body") + len(END)).cast("long").alias("learn_length"),
    )
