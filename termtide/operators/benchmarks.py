"""Tables over benchmark runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.functions.numbers import round_binary
from termtide.functions.text import run_stamp
from termtide.operators.trends import MAX_SERIES, quoted, series_keys

# Decimal places of (time, throughput, latency) in the two published table forms.
FINE_PLACES = (4, 2, 8)
COARSE_PLACES = (2, 2, 4)


def bench_metrics(log: DataFrame, places: Sequence[int] = FINE_PLACES) -> DataFrame:
    """Throughput and latency from `(size, workers, time_s)`; NULL where undefined.

    `size` must be the number of records read, not the number asked for.
    """
    time_places, rate_places, latency_places = places
    size, time_s = F.col("size"), F.col("time_s")
    return log.select(
        "size",
        "workers",
        round_binary(time_s, time_places).alias("time_s"),
        round_binary(F.try_divide(size, time_s), rate_places).alias("throughput_rps"),
        round_binary(F.try_divide(time_s, size), latency_places).alias("latency_s"),
    )


def distinct_keys(results: DataFrame, key: str) -> DataFrame:
    """The values of one key in order, such as all sizes or all worker counts."""
    return results.select(key).distinct().orderBy(key)


def one_series(results: DataFrame, workers: int) -> DataFrame:
    """Rows of one worker count."""
    return results.where(F.col("workers") == workers)


def bench_series(
    results: DataFrame,
    metric: str,
    workers: Sequence[int] | None = None,
    most: int = MAX_SERIES,
) -> DataFrame:
    """One row per size and one `w<count>` column per worker count.

    Where runs repeat a point, the smallest value stands for it. Without `workers`
    the counts are looked up first, which reads the results twice; more than `most` are an
    error.
    """
    counts = list(workers) if workers is not None else series_keys(results, "workers", most)
    wide = results.groupBy("size").pivot("workers", counts).agg(F.min(metric))
    return wide.select("size", *[F.col(quoted(str(w))).alias(f"w{w}") for w in counts])


def run_summary(records: DataFrame, processes: int, moment: Column) -> DataFrame:
    """One row `(timestamp, total_records, num_processes)` describing a run."""
    return records.agg(F.count(F.lit(1)).alias("total_records")).select(
        run_stamp(moment).alias("timestamp"),
        "total_records",
        F.lit(processes).alias("num_processes"),
    )
