"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.operators.messages import build_messages
from termtide.sources.streams import TOPIC

# The header of result files.
RESULT_HEADER = {
    "size": "Size",
    "workers": "Workers",
    "time_s": "Time(s)",
    "throughput_rps": "Throughput(rps)",
    "latency_s": "Latency(s/record)",
}


def result_path(folder: str, stamp: str) -> str:
    return f"{folder.rstrip('/')}/performance_metrics_{stamp}.csv"


def summary_path(folder: str, stamp: str) -> str:
    return f"{folder.rstrip('/')}/benchmark_summary_{stamp}.json"


def write_bench_results(results: DataFrame, path: str) -> None:
    """One CSV part with a header. The table has a row per measured point, so it is small."""
    named = results.select(*[F.col(c).alias(title) for c, title in RESULT_HEADER.items()])
    named.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The one-row run summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def send_reviews(reviews: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send complete reviews to a topic, each task its own part; delivery is at least once."""
    messages = build_messages(reviews)
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


def save_messages(reviews: DataFrame, path: str) -> None:
    """The same messages as JSON-lines files, for readers without a broker."""
    build_messages(reviews).write.mode("append").text(path)


def schema_report(df: DataFrame) -> DataFrame:
    """`(position, name, type)` of the columns, as a table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
