"""Batch word count and its timing sweep."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.functions.text import first_field
from termtide.operators.counts import word_count
from termtide.operators.messages import required
from termtide.operators.ranking import first_records
from termtide.operators.tokens import tokenize
from termtide.session import spread

LOG_SCHEMA = "size bigint, workers int, time_s double"


def review_words(reviews: DataFrame, rule: str = "ascii_runs") -> DataFrame:
    """Word counts over the reviews of a table; rows without a review are skipped."""
    return word_count(tokenize(spread(required(reviews, "review")), "review", rule))


def line_words(lines: DataFrame, first_only: bool = True) -> DataFrame:
    """Word counts over lines, by default over the text before the first comma."""
    field = first_field(F.col("line")) if first_only else F.col("line")
    return word_count(tokenize(spread(lines.select(field.alias("review"))), "review", "ws_alpha"))


def timing_sweep(
    records: DataFrame, key: str, text: str, sizes: Sequence[int], rule: str = "ws_alpha"
) -> DataFrame:
    """Time the word count over growing prefixes of a table, then over all of it.

    Rows read are counted, not assumed. `workers` is the number of cores this session
    has; repeat the sweep on other cluster sizes and read the result files together.
    """
    spark = records.sparkSession
    cores = spark.sparkContext.defaultParallelism
    log = []
    for size in [*sizes, None]:
        part = records if size is None else first_records(records, size, key)
        rows = part.count()
        counts = word_count(tokenize(spread(part.select(text)), text, rule))
        start = time.perf_counter()
        counts.write.format("noop").mode("overwrite").save()
        log.append((rows, cores, time.perf_counter() - start))
    return spark.createDataFrame(log, LOG_SCHEMA)
