"""Preference formatting: one prompt and two masked completions for a pair of conversations.

The longest run of equal turns at the start of both conversations is rendered once as the
prompt; what follows it in each is a completion. A completion's mask lists the character ranges
to train on, which are what assistant turns say with the mark that ends the turn.

A conversation is one row of the result, so it has to fit a row as a document does; pairs
shuffle once by id. Turns come in the order of their number, then role and text; a null role or
text counts as empty and equals another null; a conversation that only one side has gives a pair
with an empty other side; a null id is a pair of its own; repeated turns are kept. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"


def _side(turns: DataFrame, side: str, id_col, turn_col, role_col, text_col) -> DataFrame:
    said = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return turns.select(F.col(id_col).alias("id"), F.lit(side).alias("side"), said.alias("said"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(TURN_START), turn.role, F.lit("\n"))


def _rendered(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(_head(t), t.text, F.lit(TURN_END)))
    return F.array_join(parts, "")


def _mask(turns: Column, trained_role: str) -> Column:
    """`start-end` of the trained parts of rendered turns, in characters, comma-joined."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("m"))

    def step(state: Column, turn: Column) -> Column:
        first = state.at + F.length(_head(turn))
        last = first + F.length(turn.text) + len(TURN_END)
        span = F.array(F.concat_ws("-", first.cast("string"), last.cast("string")))
        return F.struct(
            last.alias("at"),
            F.when(turn.role == trained_role, F.concat(state.m, span)).otherwise(state.m).alias("m"),
        )

    return F.aggregate(turns, start, step, lambda state: F.array_join(state.m, ","))


def preference_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """`(id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask)` per pair.

    Both inputs hold a row per turn, and a pair has the same id on both sides.
    """
    names = id_col, turn_col, role_col, text_col
    both = _side(chosen, "chosen", *names).union(_side(rejected, "rejected", *names))
    pairs = both.groupBy("id").agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("said")))).alias(side)
            for side in ("chosen", "rejected")
        ]
    )
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(
        F.array().cast("array<int>")
    )

    def differ(place: Column) -> Column:
        a, b = F.element_at("chosen", place), F.element_at("rejected", place)
        return (a.role != b.role) | (a.text != b.text)

    first = F.array_min(F.filter(places, differ))
    pairs = pairs.withColumn("n_prompt_turns", F.coalesce(first - 1, shorter))
    prompt = F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))
    ends = {
        side: F.slice(side, F.col("n_prompt_turns") + 1, F.size(side))
        for side in ("chosen", "rejected")
    }
    return pairs.select(
        F.col("id").alias(id_col),
        F.col("n_prompt_turns").cast("bigint").alias("n_prompt_turns"),
        _rendered(prompt).alias("prompt"),
        _rendered(ends["chosen"]).alias("chosen"),
        _rendered(ends["rejected"]).alias("rejected"),
        _mask(ends["chosen"], trained_role).alias("chosen_mask"),
        _mask(ends["rejected"], trained_role).alias("rejected_mask"),
    )
