"""Multi-party perspective rotation: a dialogue as each of its participants would have spoken it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.llm.common import let, prepare

#: Turns in one rendered part: a dialogue of any length is a row of such parts.
PART_TURNS = 512
SYSTEM, NAMELESS = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _piece(turn: Column, speaker: Column) -> Column:
    """One turn as ``speaker`` sees it: header, then what the mask may cover."""
    own = turn["role"] == speaker
    header = F.when(own, F.lit("assistant")).when(turn["role"] == SYSTEM, F.lit(SYSTEM)).otherwise(
        F.concat(F.lit("user name="), turn["role"])
    )
    head = F.concat(F.lit(OPEN), header, F.lit("\n"))
    return F.struct(
        head.alias("head"),
        F.concat(turn["text"], F.lit(CLOSE)).alias("body"),
        own.alias("own"),
    )


def _spans(pieces: Column) -> Column:
    """Character ranges [start, end) of the own bodies; each piece ends in a line feed."""
    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.char_length(p["head"])
        end = start + F.char_length(p["body"])
        found = F.when(p["own"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))
        return F.struct((end + 1).alias("at"), found.otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    begun = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(pieces, begun, step, lambda state: state["spans"])


def rotate(
    turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(conversation, speaker, part, n_turns, rendered, spans)``: each dialogue once per participant.

    In a speaker's rendering their own turns are the assistant's, every other participant is a
    named user, system turns stay the system's. ``spans`` are the character ranges of
    ``rendered`` that the loss covers: the speaker's own texts with their closing mark. Part k
    holds the turns numbered from ``k * part_turns`` on, so no task gathers a whole long
    dialogue; the parts of one speaker in order are the dialogue, and ranges count from the
    start of their part. A participant who is silent in a part gets it without spans.

    Turns are ordered by number, then role, then text; repeated rows appear as often as they
    come. Null turns stand in a last part of their own (part null), null roles are the
    participant ``unknown``, null texts are empty, a null conversation is one conversation. A
    dialogue with system turns alone has no participant and no row. Other columns of the
    table are ignored; an empty table gives an empty table.
    """
    prepare(turns.sparkSession)
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.floor(F.col(turn) / part_turns).alias("part"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit(NAMELESS)).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    parts = said.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    speakers = (
        said.select("conv_id", F.col("said.role").alias("speaker"))
        .filter(F.col("speaker") != SYSTEM)
        .distinct()
        .withColumnRenamed("conv_id", "_conv")
    )
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    pieces = F.transform("turns", lambda t: _piece(t, F.col("speaker")))
    line = lambda p: F.concat(p["head"], p["body"], F.lit("\n"))
    made = let(pieces, lambda ps: F.struct(
        F.array_join(F.transform(ps, line), "").alias("rendered"), _spans(ps).alias("spans")
    ))
    return seen.withColumn("_made", made).select(
        F.col("conv_id").alias(conversation), "speaker", "part", F.size("turns").cast("long").alias("n_turns"),
        F.col("_made.rendered").alias("rendered"), F.col("_made.spans").alias("spans"),
    )
