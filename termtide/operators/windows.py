"""Counts per time window."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def windowed_count(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    size: str,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """`(window, *keys, count)` over tumbling or sliding windows, batch or stream.

    Rows without a time are in no window. The watermark takes effect in append and
    update mode only; complete mode keeps all state. Sliding windows of a table are counted
    in blocks.
    """
    if slide and not df.isStreaming and in_blocks(df, time, size, slide):
        return block_windows(block_count(df, time, keys, size, slide), keys, size, slide)
    if watermark:
        df = df.withWatermark(time, watermark)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return df.groupBy(window.alias("window"), *keys).count()


UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}


def seconds(duration: str) -> int:
    """Length of a duration such as `90 seconds` or `1 minute`."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", duration)
    if not found:
        raise ValueError(f"not a duration in seconds, minutes, hours or days: {duration!r}")
    return int(found[1]) * UNIT_SECONDS[found[2]]


def slide_panes(panes: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Sliding windows from tumbling counts of `slide` length, `(window, *keys, count)`.

    A stream that keeps only the tumbling panes holds one state row per pane and key,
    where sliding windows would hold size / slide of them.
    """
    length, step = seconds(size), seconds(slide)
    if length % step:
        raise ValueError("the window size must be a multiple of the slide")
    starts = [
        F.col("window.start") - F.expr(f"interval {back} seconds")
        for back in range(0, length, step)
    ]
    summed = (
        panes.select(F.explode(F.array(*starts)).alias("start"), *keys, "count")
        .groupBy("start", *keys)
        .agg(F.sum("count").alias("count"))
    )
    end = F.col("start") + F.expr(f"interval {length} seconds")
    return summed.select(F.struct("start", end.alias("end")).alias("window"), *keys, "count")


# A block holds the counts of so many panes, each as long as the slide.
BLOCK_PANES = 16
# Where the panes that a block shares with the next are more, blocks save little.
MOST_SHARED = 4


def pane_counts() -> list[str]:
    """Columns of a block's counts, in the order of its panes."""
    return [f"pane_{place}" for place in range(BLOCK_PANES)]


def in_blocks(df: DataFrame, time: str, size: str, slide: str) -> bool:
    """Whether windows can be counted in blocks: whole panes, and few of them to a window."""
    try:
        length, step = seconds(size), seconds(slide)
    except ValueError:
        return False
    known = isinstance(df.schema[time].dataType, T.TimestampType) if time in df.columns else False
    return known and step > 0 and length % step == 0 and 0 <= length // step - 1 <= MOST_SHARED


def block_count(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    size: str,
    slide: str,
    watermark: str | None = None,
) -> DataFrame:
    """`(window, *keys, pane_0, ...)`: the counts of a block's panes in one row, batch or stream.

    `window` is the whole block. It starts some windows and reaches to the end of the last of
    them, so each window lies whole in the block in which it starts: `block_windows` needs no
    shuffle, and the panes shared with the next block are the only ones counted twice. Sliding
    windows would bring a row for each of a key's windows to the shuffle or the state instead.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    return pane_count(place_in_blocks(df, time, size, slide), time, keys, slide)


def block_stride(size: str, slide: str) -> int:
    """Seconds from a block to the next."""
    step = seconds(slide)
    return (BLOCK_PANES - seconds(size) // step + 1) * step


def place_in_blocks(df: DataFrame, time: str, size: str, slide: str) -> DataFrame:
    """Each row once for each block that its time is in, `window`."""
    length, stride = BLOCK_PANES * seconds(slide), block_stride(size, slide)
    return df.withColumn("window", F.window(time, f"{length} seconds", f"{stride} seconds"))


def pane_count(placed: DataFrame, time: str, keys: Sequence[str], slide: str) -> DataFrame:
    """The counts of `block_count` from rows that are in their blocks already."""
    step = seconds(slide)
    inside = F.unix_micros(time) - F.unix_micros("window.start")
    pane = F.call_function("div", inside, F.lit(step * 1_000_000))
    placed = placed.select("window", *keys, pane.cast("int").alias("pane"))
    counts = [F.count(F.when(F.col("pane") == n, 1)).alias(c) for n, c in enumerate(pane_counts())]
    return placed.groupBy("window", *keys).agg(*counts)


def block_windows(blocks: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """The windows that start in the blocks of `block_count`, `(window, *keys, count)`."""
    length, step = seconds(size), seconds(slide)
    panes, reach = [F.col(c) for c in pane_counts()], length // step
    sums = [sum(panes[n + 1 : n + reach], panes[n]) for n in range(BLOCK_PANES - reach + 1)]
    slid = blocks.select(
        F.unix_micros("window.start").alias("block"), *keys, F.posexplode(F.array(*sums)).alias("place", "count")
    ).where("count > 0")
    start = F.col("block") + F.col("place").cast("bigint") * F.lit(step * 1_000_000)
    window = F.struct(
        F.timestamp_micros(start).alias("start"),
        F.timestamp_micros(start + F.lit(length * 1_000_000)).alias("end"),
    )
    return slid.select(window.alias("window"), *keys, "count")


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the `window` struct by `window_start` and `window_end`."""
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *others,
    )
