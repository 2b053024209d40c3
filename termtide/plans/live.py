"""Starting streaming queries and preparing their tables for display."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termtide.operators.ranking import by_count
from termtide.operators.rates import live_rates
from termtide.operators.trends import recent_top_words, wide_trend, word_trend
from termtide.sinks.ledger import Ledger
from termtide.sinks.streams import RATES, RATES_KEPT, to_parquet, to_tables, to_windows
from termtide.sources.tables import latest_files
from termtide.streaming import reviews


def analysis_ledger(spark: SparkSession, path: str) -> Ledger:
    """The tables of `words_and_labels`: words, labels, unfit messages and rates."""
    return Ledger(spark, path, reviews.ANALYSIS_KEPT | {RATES: RATES_KEPT})


def words_and_labels(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    rows: int = 10,
    bounded: bool = False,
    quiet: bool = False,
) -> StreamingQuery:
    """Windowed words, label counts, unfit messages and rates of one stream, in one query.

    Each batch is read and parsed once. No state is kept: batches bring partial counts, which the
    ledger adds up, and windows behind the watermark leave its base. The first rows of the words
    and all labels are printed after each batch unless `quiet`.
    """

    def show(ledger: Ledger) -> None:
        by_count(ledger.read("words")).limit(rows).show(rows, truncate=False)
        by_count(ledger.read("labels")).limit(rows).show(rows, truncate=False)
        live_rates(ledger.read(RATES)).orderBy(F.desc("number")).limit(1).show(truncate=False)
        print(f"Messages so far: {ledger.marks()[-1].total}")

    ledger = analysis_ledger(messages.sparkSession, path)
    timed = reviews.timed_messages(messages)
    then = None if quiet else show
    return to_tables(timed, ledger, reviews.ANALYSIS, checkpoint, "event_time", bounded=bounded, then=then)


def broker_words(
    messages: DataFrame, path: str, checkpoint: str, rows: int = 10, bounded: bool = False
) -> StreamingQuery:
    """Windowed words by broker time; state ends a minute after the window.

    Prints the first rows after each batch.
    """
    result = reviews.words_by_broker_time(messages, reviews.DELAY)

    def show(table: DataFrame) -> None:
        by_count(table).limit(rows).show(rows, truncate=False)

    return to_windows(
        result, path, checkpoint, ["word"], reviews.DELAY, reviews.EVERY_FAST, bounded, then=show
    )


def await_any(spark: SparkSession) -> None:
    """Wait for the first query to end; a failure of any surfaces at once."""
    spark.streams.awaitAnyTermination()


def save_words(
    messages: DataFrame, path: str, checkpoint: str, bounded: bool = False, by_day: bool = False
) -> StreamingQuery:
    """Windowed raw words by arrival, appended every minute."""
    return to_parquet(
        reviews.words_by_arrival(messages), path, checkpoint, reviews.EVERY_SAVED, bounded, by_day
    )


def save_labels(
    messages: DataFrame, path: str, checkpoint: str, bounded: bool = False, by_day: bool = False
) -> StreamingQuery:
    """Windowed labels by arrival, appended every ten seconds."""
    return to_parquet(
        reviews.labels_by_arrival(messages), path, checkpoint, reviews.EVERY_LABELS, bounded, by_day
    )


def recent_report(
    spark: SparkSession, path: str, files: int = 5, n: int = 10, by: str = "mtime"
) -> tuple[DataFrame, DataFrame]:
    """Top words of the newest files and their trend with one column per word."""
    recent = latest_files(spark, path, files, by)
    top = recent_top_words(recent, n)
    words = [row.word for row in top.collect()]
    return top, wide_trend(word_trend(recent, top), words)
