"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(value: Column, places: int) -> Column:
    """Round a double as Python does: by its exact binary value, ties to even.

    `F.round` works on the printed digits, ties up, and would turn 0.145 into 0.15.
    """
    pattern = "0." + "0" * places if places else "0"
    rounded = F.call_function("format_number", value, F.lit(pattern)).cast("double")
    return F.when(F.abs(value) == float("inf"), value).otherwise(rounded)
