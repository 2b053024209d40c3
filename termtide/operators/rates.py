"""How fast a stream is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_rates(rates: DataFrame) -> DataFrame:
    """`(number, read_at, seconds, rows, rows_per_second)` from a ledger's rate table.

    `number` is the batch. A batch that took no measurable time has no rate.
    """
    rate = F.when(F.col("seconds") > 0, F.col("count") / F.col("seconds"))
    return rates.select(
        "number",
        "read_at",
        "seconds",
        F.col("count").alias("rows"),
        rate.alias("rows_per_second"),
    )
