"""Word and label counts.

Each aggregates before it shuffles, so a word or label holding a large part of all rows
reaches the exchange as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.functions.numbers import round_binary
from termtide.functions.text import escape_dollar, normal_label


def word_count(tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`(*by, word, count)`; on a stream this is the running count."""
    return tokens.groupBy(*by, "word").count()


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Add up count tables saved by separate runs."""
    every = reduce(DataFrame.unionByName, counts)
    return every.groupBy("word").agg(F.sum("count").alias("count"))


def label_counts(df: DataFrame, label: str = "sentiment", normalize: bool = False) -> DataFrame:
    """Rows per label. A missing label is a group of its own, or `''` when normalized."""
    value = normal_label(F.col(label)) if normalize else F.col(label)
    return df.groupBy(value.alias(label)).count()


def total_count(df: DataFrame) -> DataFrame:
    """One row holding the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def label_share(counts: DataFrame, label: str = "sentiment") -> DataFrame:
    """Each label's share of all rows in percent, with the label ready for a chart.

    The total is a scalar subquery, not a window: an unpartitioned window would bring
    every label into one task.
    """
    total = counts.select(F.sum("count")).scalar()
    return counts.select(
        escape_dollar(F.col(label)).alias(label),
        "count",
        round_binary(F.col("count") * F.lit(100.0) / total, 1).alias("percent"),
    )
