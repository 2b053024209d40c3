"""Sorts and limits. Every limit has a total order, so results do not vary by run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERCENTILE_ACCURACY = 10_000
# So many keys at most are put in order by one task.
MOST_SORTED = 10_000


def by_count(counts: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """Most frequent first; on a stream only complete mode can sort.

    Equal counts follow the other columns. Most words occur once, and a sort on the count
    alone would send all of those to one task.
    """
    ties = [c for c in counts.columns if c != "count"] if ties is None else ties
    return counts.orderBy(F.desc("count"), *ties)


def top_k(counts: DataFrame, k: int = 10, ties: Sequence[str] = ("word",)) -> DataFrame:
    """The k most frequent rows; equal counts go to the alphabetically first."""
    return by_count(counts, ties).limit(k)


def first_rows(df: DataFrame, n: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The first n rows in the order of the `by` columns, for showing; without `by`, any n."""
    return (df.orderBy(*by) if by else df).limit(n)


def nth_key(keys: DataFrame, key: str, n: int) -> int | float | None:
    """The n-th smallest value of a numeric column, or None if it has fewer.

    Ranking n keys per task and merging them in one would not scale with n or the number
    of tasks. Approximate percentiles give a narrow band around the wanted rank instead, and
    exact counts place it. A band that misses the rank is widened; one that holds it is
    narrowed again, until few keys or a single value are left.
    """
    total = keys.count()
    if n > total:
        return None
    value, band, rank, size = F.col(key), keys.where(F.col(key).isNotNull()), n, total
    while size > MOST_SORTED:
        share, slack = rank / size, 2 / PERCENTILE_ACCURACY
        while True:
            bounds = [max(0.0, share - slack), min(1.0, share + slack)]
            low, high = band.agg(F.percentile_approx(key, bounds, PERCENTILE_ACCURACY)).first()[0]
            below, within = band.agg(F.count_if(value < low), F.count_if(value <= high)).first()
            if below < rank <= within:
                break
            slack *= 10
        if low == high:
            return low
        if within - below == size:
            # All keys are between the percentiles that are one step apart; halve by value.
            middle = (low + high) / 2
            lower = band.where(value <= middle)
            count = lower.count()
            inside = rank <= count
            band = lower if inside else band.where(value > middle)
            rank, size = (rank, count) if inside else (rank - count, size - count)
            continue
        band = band.where(value.between(low, high))
        rank, size = rank - below, within - below
    return band.orderBy(key).limit(rank).agg(F.max(key)).first()[0]


def first_records(df: DataFrame, size: int, key: str) -> DataFrame:
    """The first `size` records by a unique, non-null, numeric key.

    The key at the cut is looked up first, from that column alone. As a literal it lets
    the scan skip what lies beyond, and the records stay spread over their tasks.
    """
    if size <= 0:
        return df.limit(0)
    last = nth_key(df.select(key), key, size)
    return df if last is None else df.where(F.col(key) <= F.lit(last))
