"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the
assistant, all others as named users, and a mask of the character ranges to
train on: the assistant's words and the end marker after them. ``system`` turns are rendered as system blocks and are
nobody's perspective; a null role speaks as the user "unknown" and is nobody's perspective either.

A conversation is rendered in parts of ``part_turns`` consecutive turns (part 0 is the whole dialogue of
an ordinary conversation), so any conversation stays in bounded rows, whatever its turn numbers. A turn's
place in its conversation is a running count over ranges of (conversation, turn, role, text), so a conversation
that holds a third of all turns is spread, and equal turns are spread too. Numbers of turns and mask offsets are per part.
The turns move before they are multiplied by perspectives.

Edge cases: null texts render as empty; a marker inside a text is defused ("<|" becomes
"< |"); turns without a number come first, turns with equal numbers are ordered by role and text;
a null conv_id is a conversation; repeated rows are turns of their own; conversations
without a participant give no row; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm.running import running_sums

PART_TURNS = 256


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, perspective and part: conv_id, perspective, part, n_turns,
    rendered, mask (array of structs start, end: character ranges, end excluded)."""
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("named"),
                     F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
                     F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    # equal turns are alike, so their order among themselves, by a scattered number, does not matter
    t = t.withColumns({"_one": F.lit(1), "_tie": F.xxhash64(F.monotonically_increasing_id())})
    placed = running_sums(t, [F.col(c) for c in ("conv_id", "turn", "role", "text", "_tie")], {"_at": "_one"}, "conv_id")
    placed = placed.withColumn("part", F.floor(F.col("_at") / part_turns).cast("long"))
    parts = placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    speakers = t.filter("named is not null and named <> 'system'").select(F.col("conv_id").alias("_conv"), F.col("named").alias("perspective")).distinct()
    each = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def piece(x):
        who = F.when(x["role"] == F.col("perspective"), F.lit("<|assistant|>\n")).when(
            x["role"] == "system", F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user|>\n"), x["role"], F.lit(": ")))
        body = F.concat(x["text"], F.lit("\n<|end|>\n"))
        return F.struct(F.concat(who, body).alias("s"), F.length(who).alias("lead"), F.length(body).alias("body"),
                        (x["role"] == F.col("perspective")).alias("own"))

    each = each.withColumn("pieces", F.transform("turns", piece))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    grown = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), empty.alias("mask")), lambda a, x: F.struct(
        (a["at"] + x["lead"] + x["body"]).alias("at"),
        F.when(x["own"], F.concat(a["mask"], F.array(F.struct((a["at"] + x["lead"]).alias("start"), (a["at"] + x["lead"] + x["body"]).alias("end")))))
        .otherwise(a["mask"]).alias("mask")))
    return each.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(F.col("pieces.s"), "").alias("rendered"), grown["mask"].alias("mask"))
