"""Multi-party perspective rotation of dialogues, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The role whose turns are instructions to all and nobody's perspective.
SYSTEM = "system"
#: The name of a speaker whose role is null.
NOBODY = "unknown"
#: Turn numbers of one block; offsets within a dialogue are summed block by block.
BLOCK = 256
END = "<|end|>\n"


def unmarked(text: Column) -> Column:
    """The text with what could open a mark taken apart."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


#: Characters of a text that tell in which block a turn without a number is; blocks keep the order of texts.
EDGE = 8


def dialogues(segments: DataFrame) -> DataFrame:
    """(conv_id, speaker, dialogue, masks) of the segments of `perspectives`: each participant's text as a whole, and the
    [start, end] stretches that are trained on, in order.  One row gathers one dialogue, which must fit a row."""
    own = F.array_sort(F.collect_list(F.struct("position", "segment", "mask_start", "mask_end")))
    rows = segments.groupBy("conv_id", "speaker").agg(own.alias("_own"))
    masks = F.transform(F.filter("_own", lambda x: x["mask_start"].isNotNull()), lambda x: F.array(x["mask_start"], x["mask_end"]))
    return rows.select("conv_id", "speaker", F.array_join(F.transform("_own", lambda x: x["segment"]), "").alias("dialogue"), masks.alias("masks"))


def perspectives(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per turn and participant: the turn as it reads in the dialogue that has this participant as assistant.

    Takes (conv_id, turn, role, text).  A participant is every role of a conversation but `system`.  In a
    participant's dialogue the own turns are headed `<|assistant|>`, everyone else's `<|user name=ROLE|>` and system
    turns `<|system|>`.  Returns conv_id, speaker, position (from 0), turn, role, segment (header, text and end mark),
    start and end (offsets of the segment in the dialogue, in characters), train (the speaker's own turns), mask_start
    and mask_end (offsets of what is trained on: the text and its end mark; null elsewhere).  Joining a speaker's
    segments in order of position gives the dialogue, as `dialogues` does.  A mark's opening `<|` in a text or role is
    written `< |`, so that no turn can forge another.

    Turns are in order of number, nulls last, then role and text; repeated rows repeat.  Null texts are empty, a null
    role speaks as `unknown`, null conv_ids are one conversation, and a conversation of system turns only gives no
    rows.  Other columns are ignored.  A long conversation is spread over blocks of turn numbers (nulls: of roles and beginnings of texts):
    offsets are summed within a block and over blocks, so no task gathers a whole conversation.
    """
    own = turns.select("conv_id", "turn", F.coalesce("role", F.lit(NOBODY)).alias("role"), unmarked(F.coalesce("text", F.lit(""))).alias("text"))
    late = F.col("turn").isNull()
    own = own.withColumn("_block", F.struct(late.alias("late"), F.floor(F.col("turn") / block).alias("n"), F.when(late, F.col("role")).alias("role"), F.when(late, F.substring("text", 1, EDGE)).alias("edge")))
    speakers = own.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    each = own.join(speakers, own["conv_id"].eqNullSafe(speakers["_conv"])).drop("_conv")
    head = (
        F.when(F.col("role") == SYSTEM, F.lit("<|system|>")).when(F.col("role") == F.col("speaker"), F.lit("<|assistant|>"))
        .otherwise(F.concat(F.lit("<|user name="), unmarked(F.col("role")), F.lit("|>")))
    )
    each = each.withColumn("_head", head).withColumn("segment", F.concat("_head", "text", F.lit(END))).withColumn("_long", F.length("segment").cast("long"))

    of = ["conv_id", "speaker"]
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    before = Window.partitionBy(*of).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = each.groupBy(*of, "_block").agg(F.sum("_long").alias("_chars"), F.count("*").alias("_turns"))
    blocks = blocks.select(
        F.col("conv_id").alias("_c"), F.col("speaker").alias("_s"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_from"), F.coalesce(F.sum("_turns").over(before), F.lit(0)).alias("_first"),
    )
    inside = Window.partitionBy(*of, "_block").orderBy(*order)
    each = each.withColumn("_end", F.sum("_long").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_at", F.row_number().over(inside) - 1)
    placed = each.join(blocks, each["conv_id"].eqNullSafe(blocks["_c"]) & (each["speaker"] == blocks["_s"]) & (each["_block"] == blocks["_b"]))
    end = F.col("_from") + F.col("_end")
    start = end - F.col("_long")
    train = F.col("role") == F.col("speaker")
    return placed.select(
        "conv_id", "speaker", (F.col("_first") + F.col("_at")).alias("position"), "turn", "role", "segment", start.alias("start"), end.alias("end"), train.alias("train"),
        F.when(train, start + F.length("_head")).alias("mask_start"), F.when(train, end).alias("mask_end"),
    )
