"""Reviews to messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.functions.text import event_time, iso_time

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("review", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where each named column is neither NULL nor empty."""
    for name in columns:
        df = df.where(F.col(name) != "")
    return df


def build_messages(
    df: DataFrame, created_at: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Complete reviews as JSON text in `value`, with the `keep` columns alongside.

    The message carries `created_at`, without which no reader can place it in an
    event-time window: the given expression, else a `created_at` column, else now, also
    where these are NULL.
    """
    now = iso_time(F.current_timestamp())
    if created_at is None:
        created_at = F.col("created_at") if "created_at" in df.columns else now
    created_at = F.coalesce(created_at, now)
    complete = required(df, "review", "sentiment")
    body = F.struct("review", "sentiment", created_at.alias("created_at"))
    return complete.select(F.to_json(body).alias("value"), *keep)


def parse_messages(
    raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Flat columns from JSON in a binary or text `value`; bad JSON gives NULL fields."""
    data = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(data.alias("data"), *keep).select("data.*", *keep)


def checked_messages(
    raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, keep: tuple[str, ...] = ()
) -> DataFrame:
    """`parse_messages` with `unparsed`: the text of a message that does not fit the schema.

    It is NULL for messages that do. A message that is NULL, blank or not an object does not fit;
    fields that could be read are kept beside the text.
    """
    text = F.col("value").cast("string")
    marked = T.StructType([*schema.fields, T.StructField("unparsed", T.StringType())])
    data = F.from_json(text, marked, {"columnNameOfCorruptRecord": "unparsed"})
    parsed = raw.select(text.alias("value"), data.alias("data"), *keep)
    # Where nothing can be read the whole struct may be NULL.
    is_object = F.coalesce(F.ltrim("value"), F.lit("")).startswith("{")
    unparsed = F.when(is_object & F.col("data").isNotNull(), F.col("data.unparsed"))
    unparsed = unparsed.otherwise(F.coalesce("value", F.lit("")))
    fields = [F.col(f"data.`{name}`").alias(name) for name in schema.names]
    return parsed.select(*fields, unparsed.alias("unparsed"), *keep)


def fitting(checked: DataFrame) -> DataFrame:
    """The messages that fit, without `unparsed`."""
    return checked.where("unparsed IS NULL").drop("unparsed")


def unfit(checked: DataFrame) -> DataFrame:
    """How often each text came that does not fit, `(unparsed, count)`."""
    return checked.where("unparsed IS NOT NULL").groupBy("unparsed").count()


def with_event_time(df: DataFrame, source: str = "created_at") -> DataFrame:
    """Add `event_time`, parsed from a text column."""
    return df.withColumn("event_time", event_time(F.col(source)))


def with_broker_time(raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Parsed messages whose `event_time` is the broker's own `timestamp`."""
    return parse_messages(raw, schema, keep=("timestamp",)).withColumnRenamed(
        "timestamp", "event_time"
    )


def with_arrival_time(df: DataFrame) -> DataFrame:
    """Add `event_time` as the moment of processing."""
    return df.withColumn("event_time", F.current_timestamp())
