"""Reports over saved windowed counts `(window, word, count)`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.operators.counts import merge_counts
from termtide.operators.ranking import top_k

# Pivot values become columns, so their number is bounded by what a schema can hold.
MAX_SERIES = 1_000


def recent_top_words(windowed: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent words over all given windows."""
    return top_k(merge_counts(windowed.select("word", "count")), n)


def keep_words(windowed: DataFrame, top: DataFrame) -> DataFrame:
    """Rows of the words in `top`, a result of a top-n limit and so of known size."""
    return windowed.join(F.broadcast(top.select("word")), "word", "left_semi")


def word_trend(windowed: DataFrame, top: DataFrame) -> DataFrame:
    """`(window_start, word, count)` for the words in `top`."""
    return (
        keep_words(windowed, top)
        .groupBy(F.col("window.start").alias("window_start"), "word")
        .agg(F.sum("count").alias("count"))
    )


def series_keys(df: DataFrame, key: str, most: int = MAX_SERIES) -> list:
    """Distinct non-null values of a key in order, for use as column names.

    More than `most` raise an error; the long form holds any number.
    """
    found = (
        df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(most + 1)
    )
    values = [row[0] for row in found.collect()]
    if len(values) > most:
        raise ValueError(f"{key} has more than {most} values, too many for columns")
    return values


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots or backticks, as raw words do."""
    return "`" + name.replace("`", "``") + "`"


def wide_trend(trend: DataFrame, words: Sequence[str]) -> DataFrame:
    """One row per window and one column per word, 0 where a word is absent."""
    wide = trend.groupBy("window_start").pivot("word", list(words)).agg(F.sum("count"))
    filled = [F.coalesce(F.col(quoted(w)), F.lit(0)).alias(w) for w in words]
    return wide.select("window_start", *filled)
