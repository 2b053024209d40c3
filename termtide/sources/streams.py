"""Stream readers giving a broker's shape: a binary `value` and a `timestamp`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC = "reviews"


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options; `starting` is `earliest` or `latest`.

    `max_offsets_per_trigger` cuts a backlog into several micro-batches; all of it is read.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector package on the class path."""
    options = kafka_options(servers, topic, starting, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """JSON-lines files as messages, one per line, timed by their file."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(path)
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def table_files(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder or name pattern as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
