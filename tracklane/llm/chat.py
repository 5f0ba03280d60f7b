"""Chat formatting by perspective rotation: every dialogue once for every participant.

A participant is a distinct speaker of a conversation other than ``system``. In the rendering for participant P, what P
says is spoken by the assistant and trained on (mask 1); everybody else speaks as a user who carries their name, and
system turns stay system turns (mask 0). One row per conversation, perspective and message: a conversation that holds a
third of all rows is split over tasks and never gathered; messages in ``turn`` order, joined, are the dialogue.

Edge cases: null text is an empty message; a null speaker speaks as user ``unknown`` and is no perspective of its own; a
conversation without participants gives no rows; null conversation ids are one conversation; repeated rows and equal
turns stay separate messages, in the order turn, speaker, text. Extra columns are neither read nor returned. Marker
strings inside texts are escaped, so no message can open or close another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rotate_perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """Messages: conv_id, perspective, turn, speaker, role, name, segment, mask and the content's span in the segment."""
    said = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{speaker}`").alias("speaker"), F.col(f"`{text}`").alias("text"))
    cast = said.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)).groupBy("conv_id", "speaker").agg(F.lit(1).alias("one")).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective"))
    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    role = F.when(own, "assistant").when(F.col("speaker").eqNullSafe(SYSTEM), SYSTEM).otherwise("user")
    safe = F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<\\|im_"))
    rotated = said.join(cast, F.col("conv_id").eqNullSafe(F.col("of"))).withColumn("role", role)
    rotated = rotated.withColumn("name", F.when(F.col("role") == "user", F.coalesce("speaker", F.lit(UNKNOWN)))).withColumn("content", safe)
    head = F.concat(F.lit(OPEN), "role", F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), F.regexp_replace("name", r"[\s<>|]+", "_"))).otherwise(""), F.lit("\n"))
    rotated = rotated.withColumn("head", head)
    begin = F.char_length("head").cast("long")
    return rotated.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "role",
        "name",
        F.concat("head", "content", F.lit(f"{CLOSE}\n")).alias("segment"),
        own.cast("int").alias("mask"),
        begin.alias("content_start"),
        (begin + F.char_length("content")).alias("content_end"),
    )


def assemble_dialogues(messages: DataFrame) -> DataFrame:
    """One row per conversation and perspective: the whole dialogue and the character spans to train on.

    A dialogue is one value and so held by one task; use the messages where conversations have no bound.
    """
    part = F.struct("turn", "speaker", "segment", "mask", "content_start", "content_end")
    whole = messages.groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(state, p):
        span = F.struct((state["at"] + p["content_start"]).alias("start"), (state["at"] + p["content_end"]).alias("end"))
        spans = F.when(p["mask"] == 1, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.char_length(p["segment"])).alias("at"), spans.alias("spans"))

    return whole.select(
        "conv_id",
        "perspective",
        F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("dialogue"),
        F.aggregate("parts", start, add)["spans"].alias("spans"),
    )
