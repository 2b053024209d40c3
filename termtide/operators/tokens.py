"""Texts to words, and stop-word removal."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.functions.words import rule as word_rule


def tokenize(
    df: DataFrame, text: str = "review", rule: str = "nonword", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per word of `text` under the named rule, with the `keep` columns alongside."""
    if "word" in keep:
        raise ValueError("'word' is the output column and cannot be kept as well")
    spec = word_rule(rule)
    word = F.col("word")
    rows = df.select(*keep, F.explode(spec.pieces(F.col(text))).alias("word"))
    if spec.accept:
        rows = rows.where(spec.accept(word))
    if spec.shape:
        rows = rows.select(*keep, spec.shape(word).alias("word"))
    return rows


def drop_stop_words(df: DataFrame, words: Iterable[str]) -> DataFrame:
    """Drop rows whose `word` is listed. Above ten entries Spark tests against a hash set."""
    listed = list(words)
    return df.where(~F.col("word").isin(listed)) if listed else df


def drop_stop_table(df: DataFrame, table: DataFrame) -> DataFrame:
    """Drop rows whose `word` occurs in the `word` column of a table of any size.

    Apply it to counts rather than to tokens where possible: counts hold each word
    once, so a frequent word cannot make the join uneven. How to join is left to Spark,
    which sees the real sizes when it runs.
    """
    stops = table.select("word").where("word IS NOT NULL").distinct()
    return df.join(stops, "word", "left_anti")
