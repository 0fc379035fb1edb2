"""Chat formatting: every participant's view of a dialogue, message by message."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from croptide.operators.numbering import number_rows

SYSTEM = "system"
NOBODY = "unknown"
SPAN = 1024  # messages whose lengths are summed together
OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>", "\n"


def participants(messages: DataFrame) -> DataFrame:
    """``(conv, perspective)``: who speaks in a conversation, the system apart."""
    return messages.where(F.col("speaker") != SYSTEM).select(
        "conv", F.col("speaker").alias("perspective")).distinct()


def rotate(conversations: DataFrame) -> DataFrame:
    """Render every conversation once per participant; one row per message and view.

    Input ``conv_id, turn, role, text``; further columns are ignored. In the view
    of a participant their messages are the ``assistant``'s, the system's stay
    the ``system``'s, and everybody else is a ``user`` with a name:

        <|im_start|>user name=alice\\nHello<|im_end|>\\n

    Columns: ``conv_id, perspective, turn, chat_role, name, segment``, the place
    of the segment in the rendered view (``position`` from 0, ``start`` in
    characters) and ``mask_start``/``mask_end``, the characters to learn: an
    assistant's text and its end mark (null for others). Joining the segments by
    ``position`` gives the view; ``render`` does it.

    Messages come in order of turn (null last), then role and text; repeated
    rows are repeated messages. A null or blank role is a participant
    ``unknown``, a null text is empty, conversations with a null id are one
    conversation. A conversation of the system alone has no views; an empty
    table gives an empty one. Messages are numbered by ranges of their order.
    Places come from sums per ``SPAN`` numbers and running sums over those and
    within each, so a huge conversation is not sorted in one task, nor are all
    its messages without a turn or of one turn.
    """
    messages = number_rows(conversations.select(
        F.struct(F.col("conv_id").alias("id")).alias("conv"), F.col("turn").cast("long"),
        F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit(NOBODY)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text")),
        F.col("conv.id").asc_nulls_first(), F.col("turn").asc_nulls_last(), "speaker", "text",
        name="number")
    views = messages.join(participants(messages), "conv")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker"))
    head = F.concat(F.lit(OPEN), F.col("chat_role"),
                    F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")),
                    F.lit(BREAK))
    shown = (views.withColumn("chat_role", role).withColumn("name", name)
             .withColumn("head", F.length(head))
             .withColumn("segment", F.concat(head, "text", F.lit(CLOSE + BREAK)))
             .withColumn("chars", F.length("segment").cast("long"))
             .withColumn("span", F.floor(F.col("number") / SPAN)))
    key = ["conv", "perspective", "span"]
    spans = shown.groupBy(*key).agg(F.sum("chars").alias("span_chars"),
                                    F.count(F.lit(1)).alias("span_rows"))
    earlier = (Window.partitionBy("conv", "perspective").orderBy("span")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = spans.select(
        *key, F.coalesce(F.sum("span_chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("span_rows").over(earlier), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy(*key).orderBy("number")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (shown.withColumn("rank", F.row_number().over(inside) - 1)
              .withColumn("upto", F.sum("chars").over(running)).join(offsets, key))
    start = F.col("chars_before") + F.col("upto") - F.col("chars")
    mine = F.col("chat_role") == "assistant"
    return placed.select(
        F.col("conv.id").alias("conv_id"), "perspective", "turn", "chat_role", "name",
        "segment", (F.col("rows_before") + F.col("rank")).alias("position"),
        start.alias("start"),
        F.when(mine, start + F.col("head")).alias("mask_start"),
        F.when(mine, start + F.col("chars") - len(BREAK)).alias("mask_end"))


def render(rotated: DataFrame) -> DataFrame:
    """``(conv_id, perspective, rendered, masks)``: one text per view.

    A text is one value, so a view has to fit in a task here.
    """
    mask = F.when(F.col("mask_start").isNotNull(), F.struct("mask_start", "mask_end"))
    return (rotated.groupBy("conv_id", "perspective")
            .agg(F.sort_array(F.collect_list(F.struct("position", "segment"))).alias("parts"),
                 F.sort_array(F.collect_list(mask)).alias("masks"))
            .select("conv_id", "perspective", F.array_join("parts.segment", "").alias("rendered"),
                    "masks"))
