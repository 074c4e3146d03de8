"""Chat formatting with multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered once,
with that speaker as the assistant, the others as named users, and the loss on
that speaker's messages only. The rendering is a table of segments, in order,
with their offsets in the dialogue: joining the segments of one (conversation,
perspective) gives its text, and the loss spans are offsets into that text.

Segments are range-partitioned by conversation, perspective and turn, so that
a conversation of any length is spread over many tasks. Offsets are running
sums inside each task's part plus the totals of the parts before it, of which
there is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoreline.llm.common import materialise

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    """Control markers in a text, made harmless by a blank after ``<``."""
    return F.replace(F.replace(text, F.lit(OPEN), F.lit("< |im_start|>")), F.lit(CLOSE), F.lit("< |im_end|>"))


def speaker_name(speaker: Column) -> Column:
    """The speaker as it appears in a header: other characters become ``_``."""
    return F.regexp_replace(speaker, "[^\\p{L}\\p{N}_.-]", "_")


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", system: str = "system") -> DataFrame:
    """(conv_id, perspective, message_no, turn, role, name, start, loss_start,
    loss_end, segment), one row per participant and message.

    Messages are ordered by turn, then speaker, then text; null turns come
    first and repeated rows stay. Messages of the speaker ``system`` keep that
    role in every perspective and are no participant's; a conversation of
    system messages only has no perspective and no rows. A null speaker is the
    participant ``unknown``, a null text an empty one; null conversation ids
    form one conversation. ``start`` is the segment's offset in the dialogue in
    code points; ``loss_start`` and ``loss_end`` bound what is learned (the
    message and its end marker) and are null on other speakers' messages. An
    empty table gives no rows, other columns are not read.
    """
    t = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                     F.coalesce(F.col(f"`{speaker_col}`"), F.lit("unknown")).alias("speaker"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    who = (t.where(F.col("speaker") != system).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective"))
           .distinct())
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    head = F.concat(F.lit(OPEN), F.col("role"), F.when(F.col("name").isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" name="), F.col("name"))), F.lit("\n"))
    body = _plain(F.col("text"))
    rendered = (t.join(who, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
                .withColumn("role", role)
                .withColumn("name", F.when(F.col("role") == "user", speaker_name(F.col("speaker"))))
                .withColumn("head", head).withColumn("segment", F.concat("head", body, F.lit(CLOSE + "\n")))
                .select("conv_id", "perspective", "turn", "speaker", "text", "role", "name", "segment",
                        F.length("head").cast("long").alias("h"), F.length("segment").cast("long").alias("n")))
    order = ["turn", "speaker", "text"]
    placed = materialise(rendered.repartitionByRange("conv_id", "perspective", *order)
                         .withColumn("part", F.spark_partition_id()))
    keys = ["conv_id", "perspective"]
    parts = placed.groupBy(*keys, "part").agg(F.sum("n").alias("chars"), F.count(F.lit(1)).alias("messages"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("part").alias("_part"),
                         F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
                         F.coalesce(F.sum("messages").over(before), F.lit(0)).alias("messages_before"))
    here = Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("upto", F.sum("n").over(here)).withColumn("no", F.count(F.lit(1)).over(here))
    out = local.join(parts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p"))
                     & (F.col("part") == F.col("_part")))
    start = F.col("chars_before") + F.col("upto") - F.col("n")
    learned = F.col("role") == "assistant"
    return out.select("conv_id", "perspective", (F.col("messages_before") + F.col("no") - 1).alias("message_no"), "turn",
                      "role", "name", start.alias("start"), F.when(learned, start + F.col("h")).alias("loss_start"),
                      F.when(learned, start + F.col("n") - 1).alias("loss_end"), "segment")
