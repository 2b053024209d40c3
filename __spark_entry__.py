"""

Stand-ins: a review is `documents.text`, its label `documents.lang`, and its time
2024-01-01 plus 7 seconds per `doc_id`. Label streams use `events`. Benchmark run logs
are derived from `lineitem`.
"""

from __future__ import annotations

import datetime
import importlib.util
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termtide.functions.stopwords import ENGLISH, STOP7, STOP11
from termtide.functions.text import base_name, escape_dollar, first_field, iso_time, preview, run_stamp
from termtide.operators.benchmarks import (
    COARSE_PLACES,
    bench_metrics,
    bench_series,
    distinct_keys,
    one_series,
    run_summary,
)
from termtide.operators.counts import (
    label_counts,
    label_share,
    merge_counts,
    total_count,
    word_count,
)
from termtide.operators.messages import (
    build_messages,
    checked_messages,
    fitting,
    parse_messages,
    required,
    unfit,
    with_arrival_time,
    with_broker_time,
    with_event_time,
)
from termtide.operators.ranking import by_count, first_records, first_rows, top_k
from termtide.operators.rates import live_rates
from termtide.operators.tokens import drop_stop_table, drop_stop_words, tokenize
from termtide.operators.trends import recent_top_words, wide_trend, word_trend
from termtide.operators.windows import flat_window, windowed_count
from termtide.plans.batch import line_words, review_words
from termtide.plans.live import analysis_ledger, words_and_labels
from termtide.session import (
    scratch_dir,
    spread,
    spread_in_time,
    use_cluster_sizes,
    use_disk_state,
)
from termtide.sinks.ledger import Kept, Ledger
from termtide.sinks.streams import (
    RATES,
    WINDOWS,
    Tokens,
    await_idle,
    read_changes,
    read_ended_windows,
    read_snapshot,
    to_changes,
    to_ended_windows,
    to_parquet,
    to_snapshots,
    to_tables,
    to_windows,
    window_ledger,
)
from termtide.sinks.tables import (
    result_path,
    save_messages,
    schema_report,
    summary_path,
    write_bench_results,
    write_summary,
)
from termtide.sources.streams import message_files, table_files
from termtide.sources.tables import (
    first_in_files,
    join_small_files,
    latest_files,
    list_results,
    read_bench_results,
    read_csv,
    read_csv_split,
    read_joined,
    read_lines,
    read_summary,
    read_tsv,
    read_windowed,
)
from termtide.streaming import reviews as review_stream

Query = Callable[[SparkSession, str], DataFrame]

# The training-data operators can be left out as a whole; nothing else depends on them.
LLM = importlib.util.find_spec("termtide.llm") and importlib.util.find_spec("corpus_pipeline")

EPOCH_2024 = 1_704_067_200
SECONDS_APART = 7
SAMPLE_SIZE = 500
ANCHOR = "timestamp '1970-01-01'"


# Declared, so that no job reads file footers to find out.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    use_cluster_sizes(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def as_reviews(documents: DataFrame) -> DataFrame:
    seconds = F.lit(EPOCH_2024) + F.col("doc_id") * SECONDS_APART
    return documents.select(
        "doc_id",
        F.col("text").alias("review"),
        F.col("lang").alias("sentiment"),
        F.timestamp_seconds(seconds).alias("event_time"),
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return as_reviews(table(spark, sf, "documents"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return as_events(table(spark, sf, "events"))


def as_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("sentiment"),
    )


def as_messages(rows: DataFrame) -> DataFrame:
    """Reviews in a broker's shape."""
    sent = rows.withColumn("timestamp", F.col("event_time"))
    messages = build_messages(sent, iso_time(F.col("event_time")), keep=("timestamp",))
    return messages.withColumn("value", F.col("value").cast("binary"))


def table_stream(spark: SparkSession, sf: str, name: str, dealt: bool = True) -> DataFrame:
    """A table as a stream, its rows dealt over all cores unless the query deals them by itself."""
    rows = table_files(spark, f"{sf}/{name}*.parquet", table(spark, sf, name).schema)
    return rows.repartition(spark.sparkContext.defaultParallelism) if dealt else rows


def review_messages(spark: SparkSession, sf: str, dealt: bool = True) -> DataFrame:
    return as_messages(as_reviews(table_stream(spark, sf, "documents", dealt)))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Runs as ship days: rows are the size, line numbers the worker count."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_shipdate", F.col("l_linenumber").alias("workers"))
        .agg(F.count("*").alias("size"), (F.sum("l_quantity") / 1000.0).alias("time_s"))
    )


# ---------------------------------------------------------------- results


def flat(windowed: DataFrame) -> DataFrame:
    """Windows as plain UTC times, the type DuckDB returns."""
    out = flat_window(windowed)
    for name in ("window_start", "window_end"):
        out = out.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return out


def complete(
    spark: SparkSession,
    result: DataFrame,
    finish: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataFrame:
    """Run a complete-mode query over what is there and read its last snapshot."""
    use_disk_state(spark)
    out, offsets = scratch_dir(spark, "snapshot"), scratch_dir(spark, "offsets")
    to_snapshots(result, out, offsets, bounded=True, finish=finish).awaitTermination()
    return read_snapshot(spark, out)


def complete_windows(
    spark: SparkSession, timed: DataFrame, tokens: Tokens, windows: tuple[str, str]
) -> DataFrame:
    """Keep snapshots of the word windows of a stream over what is there, and read the last one."""
    out, offsets = scratch_dir(spark, "snapshot"), scratch_dir(spark, "offsets")
    to_snapshots(timed, out, offsets, bounded=True, tokens=tokens, blocks=windows).awaitTermination()
    return review_stream.windows_from_blocks(*windows)(read_snapshot(spark, out))


def appended(spark: SparkSession, result: DataFrame) -> DataFrame:
    """Run an append-mode query over what is there and read the saved windows."""
    use_disk_state(spark)
    out, offsets = scratch_dir(spark, "appended"), scratch_dir(spark, "offsets")
    to_parquet(result, out, offsets, bounded=True).awaitTermination()
    return read_windowed(spark, out)


def ended(spark: SparkSession, timed: DataFrame) -> DataFrame:
    """Save the word windows of a stream as they end over what is there, and read them."""
    out, offsets = scratch_dir(spark, "ended"), scratch_dir(spark, "offsets")
    tokens, windows, delay = review_stream.saved_tokens, review_stream.SAVED_WINDOWS, review_stream.DELAY
    to_ended_windows(
        timed, tokens, out, offsets, "event_time", ["word"], windows, delay, bounded=True
    ).awaitTermination()
    return read_ended_windows(spark, out)


def changed(spark: SparkSession, result: DataFrame, key: str) -> DataFrame:
    """Run an update-mode count over what is there and read the current counts."""
    use_disk_state(spark)
    out, offsets = scratch_dir(spark, "changes"), scratch_dir(spark, "offsets")
    to_changes(result, out, offsets, [key], bounded=True).awaitTermination()
    return read_changes(spark, out, [key])


def saved(spark: SparkSession, windowed: DataFrame) -> DataFrame:
    """Windowed counts written to and read back from a table."""
    out = scratch_dir(spark, "windowed")
    windowed.write.parquet(out)
    return read_windowed(spark, out)


# ---------------------------------------------------------------- word counts


def counted(rule: str, stops: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        words = tokenize(spread(reviews(spark, sf).select("review")), "review", rule)
        return word_count(drop_stop_words(words, stops))

    return run


def wc_stop_table(spark: SparkSession, sf: str) -> DataFrame:
    stops = spark.range(1).select(F.explode(F.array(*map(F.lit, ENGLISH))).alias("word"))
    return drop_stop_table(counted("ws_alpha")(spark, sf), stops)


def wc_merge_partials(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for name in ("documents", "conversations", "benchmark"):
        texts = spread(table(spark, sf, name).select(F.col("text").alias("review")))
        path = f"{scratch_dir(spark, 'partial')}"
        word_count(tokenize(texts, "review", "nonword")).write.parquet(path)
        parts.append(spark.read.parquet(path))
    return merge_counts(*parts)


def top10_words(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(counted("nonword", STOP11)(spark, sf), 10)


def csv_files(spark: SparkSession, sf: str) -> str:
    """The reviews written as quoted CSV."""
    path = scratch_dir(spark, "reviews-csv")
    writer = reviews(spark, sf).select("review", "sentiment").write.option("header", True)
    writer = writer.option("escape", '"').option("quoteAll", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def review_csv(spark: SparkSession, sf: str) -> DataFrame:
    return read_csv(spark, csv_files(spark, sf))


def review_csv_split(spark: SparkSession, sf: str) -> DataFrame:
    return read_csv_split(spark, csv_files(spark, sf))


def review_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "reviews-lines")
    reviews(spark, sf).select("review").write.text(path)
    return read_lines(spark, path)


def scan_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "events-tsv")
    kept = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    writer = kept.write.option("header", True).option("sep", "\t").option("escape", '"')
    writer.csv(path)
    return read_tsv(spark, path)


def wc_csv_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return review_words(review_csv(spark, sf))


def wc_line_fields(spark: SparkSession, sf: str) -> DataFrame:
    return line_words(review_lines(spark, sf))


# ---------------------------------------------------------------- labels, messages, texts


def label_share_query(spark: SparkSession, sf: str) -> DataFrame:
    return label_share(label_counts(reviews(spark, sf), normalize=True))


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    return required(reviews(spark, sf), "review", "sentiment").select("doc_id", "sentiment")


def messages_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf)
    return build_messages(rows, iso_time(F.col("event_time")), keep=("doc_id",))


def messages_parsed(spark: SparkSession, sf: str) -> DataFrame:
    timed = with_event_time(parse_messages(as_messages(reviews(spark, sf))))
    return timed.select(
        "review", "sentiment", F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


def parse_props(spark: SparkSession, sf: str) -> DataFrame:
    data = F.from_json("props", "k bigint")
    return table(spark, sf, "events").select("event_id", data.alias("data")).select(
        "event_id", F.col("data.k").alias("k")
    )


def text_previews(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("review")
    return reviews(spark, sf).select(
        "doc_id",
        preview(text).alias("short"),
        preview(text, always_mark=True).alias("marked"),
        first_field(text).alias("field"),
        escape_dollar(text).alias("label"),
    )


def prefix_sample(spark: SparkSession, sf: str) -> DataFrame:
    return first_records(table(spark, sf, "documents"), SAMPLE_SIZE, "doc_id")


def prefix_in_files(spark: SparkSession, sf: str) -> DataFrame:
    """The first records of a table of several files, each holding a range of ids in order."""
    path = scratch_dir(spark, "in-files")
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    docs.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return first_in_files(spark.read.parquet(path), SAMPLE_SIZE)


def cut_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of which every seventh lost its end on the way."""
    numbered = build_messages(reviews(spark, sf), iso_time(F.col("event_time")), keep=("doc_id",))
    text = F.col("value")
    cut = F.expr("left(value, length(value) - 20)")
    return numbered.withColumn("value", F.when(F.pmod("doc_id", F.lit(7)) == 0, cut).otherwise(text))


def messages_fitting(spark: SparkSession, sf: str) -> DataFrame:
    checked = checked_messages(cut_messages(spark, sf), keep=("doc_id",))
    return fitting(checked).select("doc_id", "review", "sentiment", "created_at")


def messages_unfit(spark: SparkSession, sf: str) -> DataFrame:
    return unfit(checked_messages(cut_messages(spark, sf)))


def schema_rows(spark: SparkSession, sf: str) -> DataFrame:
    return schema_report(spark.read.parquet(f"{sf}/documents.parquet"))


# ---------------------------------------------------------------- windows and streams


def win_words(rule: str, stops: tuple[str, ...], size: str, slide: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        texts = spread_in_time(reviews(spark, sf).select("review", "event_time"), "event_time")
        words = drop_stop_words(tokenize(texts, "review", rule, keep=["event_time"]), stops)
        return flat(windowed_count(words, "event_time", ["word"], size, slide))

    return run


def win_labels(size: str, slide: str | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return flat(windowed_count(events(spark, sf), "event_time", ["sentiment"], size, slide))

    return run


def win_words_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return by_count(win_words("nonword", STOP11, "60 seconds", "20 seconds")(spark, sf))


def stream_words_event_time(spark: SparkSession, sf: str) -> DataFrame:
    timed = review_stream.messages_at_event_time(review_messages(spark, sf, dealt=False))
    return flat(complete_windows(spark, timed, review_stream.event_tokens, ("60 seconds", "20 seconds")))


def stream_words_broker_time(spark: SparkSession, sf: str) -> DataFrame:
    timed = with_broker_time(review_messages(spark, sf, dealt=False))
    return flat(complete_windows(spark, timed, review_stream.broker_tokens, ("30 seconds", "10 seconds")))


def stream_words_saved(spark: SparkSession, sf: str) -> DataFrame:
    timed = as_reviews(table_stream(spark, sf, "documents", dealt=False))
    return flat(ended(spark, timed))


def stream_labels_saved(spark: SparkSession, sf: str) -> DataFrame:
    timed = as_events(table_stream(spark, sf, "events"))
    return flat(appended(spark, review_stream.saved_labels(timed)))


def stream_labels_running(spark: SparkSession, sf: str) -> DataFrame:
    return complete(spark, review_stream.running_labels(review_messages(spark, sf)))


def stream_labels_running_norm(spark: SparkSession, sf: str) -> DataFrame:
    messages = review_messages(spark, sf)
    return complete(spark, review_stream.running_labels(messages, normalize=True))


def stream_words_running(spark: SparkSession, sf: str) -> DataFrame:
    return complete(spark, review_stream.running_words(review_messages(spark, sf)))


def stream_words_changes(spark: SparkSession, sf: str) -> DataFrame:
    return changed(spark, review_stream.running_words(review_messages(spark, sf)), "word")


def stream_total_running(spark: SparkSession, sf: str) -> DataFrame:
    return complete(spark, review_stream.running_total(review_messages(spark, sf)))


def stream_message_files(spark: SparkSession, sf: str) -> DataFrame:
    """Messages saved as JSON lines, then read as a stream of files."""
    path = scratch_dir(spark, "messages")
    rows = reviews(spark, sf).withColumn("created_at", iso_time(F.col("event_time")))
    save_messages(rows, path)
    return complete(spark, review_stream.running_words(message_files(spark, path), ENGLISH))


def saved_windows(spark: SparkSession, sf: str) -> DataFrame:
    texts = spread_in_time(reviews(spark, sf).select("review", "event_time"), "event_time")
    return saved(spark, review_stream.saved_words(texts))


def recent_words(spark: SparkSession, sf: str) -> DataFrame:
    return recent_top_words(saved_windows(spark, sf), 10)


def trend_long(spark: SparkSession, sf: str) -> DataFrame:
    windows = saved_windows(spark, sf)
    trend = word_trend(windows, recent_top_words(windows, 10))
    return trend.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def trend_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Daily label trend: labels take the place of words, so that columns are known."""
    windows = windowed_count(events(spark, sf), "event_time", ["sentiment"], "1 day")
    windows = saved(spark, windows.withColumnRenamed("sentiment", "word"))
    top = recent_top_words(windows, 10)
    words = sorted(row.word for row in top.collect())
    wide = wide_trend(word_trend(windows, top), words)
    return wide.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def word_trend_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Trend of the five most frequent words, a column for each by its rank."""
    windows = saved_windows(spark, sf)
    top = recent_top_words(windows, 5)
    words = [row.word for row in top.collect()]
    wide = wide_trend(word_trend(windows, top), words)
    names = ["window_start", *[f"top{rank}" for rank in range(1, len(words) + 1)]]
    return wide.toDF(*names).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---------------------------------------------------------------- files and benchmark tables


def events_by_day(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "events-by-day")
    days = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    days.repartition("day").write.partitionBy("day").parquet(path)
    return path


def latest_event_files(spark: SparkSession, sf: str) -> DataFrame:
    return latest_files(spark, events_by_day(spark, sf), 5, by="name").select("event_id", "event_type")


def latest_files_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """The newest two of five files, written one after another and each holding a fifth."""
    path = scratch_dir(spark, "events-by-time")
    rows = table(spark, sf, "events").select("event_id", "event_type")
    for part in (3, 0, 4, 1, 2):
        own = rows.where(F.pmod("event_id", F.lit(5)) == part)
        own.coalesce(1).write.mode("append").parquet(path)
    return latest_files(spark, path, 2)


def message_batches(
    spark: SparkSession,
    sf: str,
    part: Column,
    parts: int,
    label: str,
    start: Callable[[DataFrame], StreamingQuery],
) -> None:
    """The reviews as message files that arrive one part at a time, in the order of the parts.

    `start` begins a bounded run of the query on its checkpoint, which reads the part that has
    come. So a part is a batch however many files it has.
    """
    use_disk_state(spark)
    path = scratch_dir(spark, f"{label}-messages")
    rows = reviews(spark, sf).withColumn("created_at", iso_time(F.col("event_time")))
    for number in range(parts):
        own = rows.where(part == number)
        build_messages(spread(own)).write.text(f"{path}/part={number}")
        start(message_files(spark, f"{path}/*")).awaitTermination()


def analysis(spark: SparkSession, sf: str) -> Ledger:
    """Words, labels, unfit messages and rates of one stream, from four parts."""
    out, offsets = scratch_dir(spark, "analysis"), scratch_dir(spark, "offsets")

    def start(stream: DataFrame) -> StreamingQuery:
        return words_and_labels(stream, out, offsets, bounded=True, quiet=True)

    message_batches(spark, sf, F.pmod("doc_id", F.lit(4)), 4, "analysis", start)
    return analysis_ledger(spark, out)


def stream_one_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Labels and windowed words of one query that reads and parses each batch once."""
    ledger = analysis(spark, sf)
    labels = ledger.read("labels").select(
        F.lit("label").alias("kind"),
        F.lit(None).cast("timestamp_ntz").alias("window_start"),
        F.col("sentiment").alias("key"),
        "count",
    )
    start = F.col("window.start").cast("timestamp_ntz").alias("window_start")
    words = ledger.read("words").select(F.lit("word").alias("kind"), start, F.col("word").alias("key"), "count")
    return labels.unionAll(words)


def stream_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each batch, and whether the rate and the total go with them."""
    ledger = analysis(spark, sf)
    total = ledger.marks()[-1].total
    agrees = F.abs(F.col("rows_per_second") * F.col("seconds") - F.col("rows")) < 0.001
    return live_rates(ledger.read(RATES)).select(
        F.col("number").cast("int").alias("batch"),
        "rows",
        agrees.alias("agrees"),
        F.lit(total).cast("bigint").alias("total"),
    )


def stream_windows_ending(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding word windows whose state ends, from four parts in the order of time."""
    size = table(spark, sf, "documents").agg(F.max("doc_id") + 1).scalar()
    part = F.floor(F.col("doc_id") * 4 / size)
    out, offsets = scratch_dir(spark, "windows"), scratch_dir(spark, "offsets")
    delay, blocks = review_stream.DELAY, review_stream.WORD_WINDOWS

    def start(stream: DataFrame) -> StreamingQuery:
        timed, tokens = review_stream.messages_at_event_time(stream), review_stream.event_tokens
        return to_windows(
            timed, out, offsets, ["word"], delay, bounded=True, merge_every=2, blocks=blocks, tokens=tokens
        )

    message_batches(spark, sf, part, 4, "ending", start)
    return flat(window_ledger(spark, out, ["word"], delay, 2, blocks, True).read(WINDOWS))


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Label windows on time and late, of messages of which every tenth comes two parts late."""
    size = table(spark, sf, "documents").agg(F.max("doc_id") + 1).scalar()
    due = F.floor(F.col("doc_id") * 4 / size)
    part = due + F.when(F.pmod("doc_id", F.lit(10)) == 3, 2).otherwise(0)
    delay = review_stream.DELAY
    kept = {"labels": Kept(("window", "sentiment"), delay=delay, aside=True)}
    ledger = Ledger(spark, scratch_dir(spark, "late"), kept, every=3)
    offsets = scratch_dir(spark, "offsets")

    def start(stream: DataFrame) -> StreamingQuery:
        timed, results = review_stream.timed_messages(stream), {"labels": review_stream.labels_in_windows}
        return to_tables(timed, ledger, results, offsets, "event_time", bounded=True)

    message_batches(spark, sf, part, 6, "late", start)
    on_time, late = (
        flat(ledger.read(name)).withColumn("late", F.lit(name != "labels"))
        for name in ("labels", "labels_late")
    )
    return on_time.unionByName(late)


def saved_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Two days of label windows that a stream saved by day, with the earlier days' files joined."""
    use_disk_state(spark)
    saved_to, joined = scratch_dir(spark, "by-day"), scratch_dir(spark, "joined")
    timed = as_events(table_stream(spark, sf, "events"))
    result = review_stream.saved_labels(timed)
    to_parquet(result, saved_to, scratch_dir(spark, "offsets"), bounded=True, by_day=True).awaitTermination()
    first = table(spark, sf, "events").select(F.to_date(F.min("ts"))).first()[0]
    join_small_files(spark, saved_to, joined, first + datetime.timedelta(days=3))
    since, until = (first + datetime.timedelta(days=d) for d in (2, 3))
    return flat(read_joined(spark, saved_to, joined, since, until))


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Message files counted in two bounded runs on one checkpoint."""
    use_disk_state(spark)
    path, out, offsets = (scratch_dir(spark, name) for name in ("messages", "snapshot", "offsets"))
    rows = reviews(spark, sf).withColumn("created_at", iso_time(F.col("event_time")))
    for half in (0, 1):
        save_messages(rows.where(F.pmod("doc_id", F.lit(2)) == half), f"{path}/half={half}")
        found = message_files(spark, f"{path}/*")
        counts = review_stream.running_words(found, ENGLISH)
        to_snapshots(counts, out, offsets, bounded=True).awaitTermination()
    return read_snapshot(spark, out)


def stream_two_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Words and labels of the same messages, counted by two queries that run side by side."""
    use_disk_state(spark)
    counted_by = {
        "label": (review_stream.running_labels(review_messages(spark, sf)), "sentiment"),
        "word": (review_stream.running_words(review_messages(spark, sf)), "word"),
    }
    out = {kind: scratch_dir(spark, f"snapshot-{kind}") for kind in counted_by}
    started = [
        to_snapshots(result, out[kind], scratch_dir(spark, f"offsets-{kind}"), bounded=True)
        for kind, (result, _) in counted_by.items()
    ]
    for query in started:
        query.awaitTermination()
    labels, words = (
        read_snapshot(spark, out[kind]).select(F.lit(kind).alias("kind"), F.col(key).alias("key"), "count")
        for kind, (_, key) in counted_by.items()
    )
    return labels.unionAll(words)


def stream_triggers(spark: SparkSession, sf: str) -> DataFrame:
    """Labels counted by a query that is triggered each second, until no more messages come."""
    use_disk_state(spark)
    out, offsets = scratch_dir(spark, "snapshot"), scratch_dir(spark, "offsets")
    result = review_stream.running_labels(review_messages(spark, sf))
    query = to_snapshots(result, out, offsets, every="1 second")
    await_idle(query)
    return read_snapshot(spark, out)


def arrival_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels in windows of arrival, and whether every window lies around the run.

    `timely` needs each row's window to hold the row's own time of arrival, no window to end
    before the query began, and none to start after it ended.
    """
    out = scratch_dir(spark, "arrival")
    began = spark.sql("SELECT current_timestamp()").first()[0]
    arrived = with_arrival_time(parse_messages(as_messages(reviews(spark, sf))))
    window = F.window("event_time", "30 seconds")
    inside = (F.col("window.start") <= F.col("event_time")) & (F.col("event_time") < F.col("window.end"))
    rows = arrived.select("sentiment", "event_time", window.alias("window"))
    rows.groupBy("window", "sentiment").agg(
        F.count("*").alias("count"), F.bool_and(inside).alias("inside")
    ).write.parquet(out)
    ended = spark.sql("SELECT current_timestamp()").first()[0]
    around = (F.col("window.end") > F.lit(began)) & (F.col("window.start") <= F.lit(ended))
    return spark.read.parquet(out).groupBy("sentiment").agg(
        F.sum("count").alias("count"), F.bool_and(F.col("inside") & around).alias("timely")
    )


def base_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", base_name(F.col("url")).alias("name"))


def result_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Result files of an area with a run for each ship month, by folder and file name.

    Beside each CSV part lies a JSON summary, which the suffix leaves out.
    """
    path = scratch_dir(spark, "runs")
    month = F.date_trunc("month", F.col("l_shipdate"))
    log = run_log(spark, sf).withColumn("run", run_stamp(month)).drop("l_shipdate")
    log = log.repartition("run")
    log.write.partitionBy("run").option("header", True).csv(path)
    log.groupBy("run").agg(F.count("*").alias("n")).write.mode("append").partitionBy("run").json(path)
    shape = F.regexp_extract("file_name", r"^(part)-\d+-[0-9a-f-]+.*(\.[a-z]+)$", 1)
    suffix = F.regexp_extract("file_name", r"(\.[a-z]+)$", 1)
    return list_results(spark, path).groupBy("folder", shape.alias("shape"), suffix.alias("suffix")).agg(
        F.count_distinct("file_name").alias("files")
    )


def bench_rows(places: tuple[int, int, int] | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        log = run_log(spark, sf)
        return bench_metrics(log, places) if places else bench_metrics(log)

    return run


def bench_saved(spark: SparkSession, sf: str) -> DataFrame:
    path = result_path(scratch_dir(spark, "results"), "20240101_000000")
    write_bench_results(bench_metrics(run_log(spark, sf)), path)
    return read_bench_results(spark, path)


def bench_summary(spark: SparkSession, sf: str) -> DataFrame:
    path = summary_path(scratch_dir(spark, "results"), "20240101_000000")
    moment = F.timestamp_seconds(F.lit(EPOCH_2024))
    write_summary(run_summary(table(spark, sf, "lineitem"), 8, moment), path)
    return read_summary(spark, path)


def bench_wide(metric: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        # TPC-H orders have up to seven lines, so the worker counts are known.
        return bench_series(bench_metrics(run_log(spark, sf)), metric, range(1, 8))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Ten most frequent words of the reviews, common words dropped."""
    return top10_words(spark, "/root/testdata/sf0.001")


def llm_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and counterparts of the training-data operators, or none without them."""
    if not LLM:
        return {}, {}
    import corpus_pipeline
    from termtide.llm import queries as llm

    made = llm.QUERIES | {"pipeline": corpus_pipeline.run}
    written = llm.ORACLE_SQL | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return made, {name: sql for name, sql in written.items() if sql}


def queries() -> dict[str, Query]:
    return llm_queries()[0] | {
        "wc_ws_alpha": counted("ws_alpha"),
        "wc_ascii_runs": counted("ascii_runs"),
        "wc_nonword": counted("nonword"),
        "wc_nonword_stop11": counted("nonword", STOP11),
        "wc_nonword_cased": counted("nonword_cased"),
        "wc_ws_raw_stop7": counted("ws_raw", STOP7),
        "wc_ws_alpha_stop7": counted("ws_alpha", STOP7),
        "wc_ws_alpha_english": counted("ws_alpha", ENGLISH),
        "wc_stop_table": wc_stop_table,
        "wc_merge_partials": wc_merge_partials,
        "wc_csv_reviews": wc_csv_reviews,
        "wc_line_fields": wc_line_fields,
        "top10_words": top10_words,
        "label_counts": lambda s, sf: label_counts(reviews(s, sf)),
        "label_counts_norm": lambda s, sf: label_counts(reviews(s, sf), normalize=True),
        "label_share": label_share_query,
        "total_records": lambda s, sf: total_count(reviews(s, sf)),
        "required_fields": required_fields,
        "messages_json": messages_json,
        "messages_parsed": messages_parsed,
        "parse_props": parse_props,
        "text_previews": text_previews,
        "prefix_sample": prefix_sample,
        "win_words_60_20": win_words("nonword", STOP11, "60 seconds", "20 seconds"),
        "win_words_30_10": win_words("nonword_cased", (), "30 seconds", "10 seconds"),
        "win_words_60_30": win_words("ws_raw", STOP7, "60 seconds", "30 seconds"),
        "win_words_sorted": win_words_sorted,
        "win_labels_30": win_labels("30 seconds"),
        "win_events_60m_20m": win_labels("60 minutes", "20 minutes"),
        "stream_words_event_time": stream_words_event_time,
        "stream_words_broker_time": stream_words_broker_time,
        "stream_words_saved": stream_words_saved,
        "stream_labels_saved": stream_labels_saved,
        "stream_labels_running": stream_labels_running,
        "stream_labels_running_norm": stream_labels_running_norm,
        "stream_words_running": stream_words_running,
        "stream_words_changes": stream_words_changes,
        "stream_total_running": stream_total_running,
        "stream_message_files": stream_message_files,
        "stream_restart": stream_restart,
        "stream_two_queries": stream_two_queries,
        "stream_triggers": stream_triggers,
        "arrival_labels": arrival_labels,
        "base_names": base_names,
        "first_rows": lambda s, sf: first_rows(table(s, sf, "documents"), 20, ["doc_id"]),
        "schema_report": schema_rows,
        "prefix_in_files": prefix_in_files,
        "messages_fitting": messages_fitting,
        "messages_unfit": messages_unfit,
        "stream_one_parse": stream_one_parse,
        "stream_rates": stream_rates,
        "stream_windows_ending": stream_windows_ending,
        "stream_late_rows": stream_late_rows,
        "saved_by_day": saved_by_day,
        "latest_files_by_time": latest_files_by_time,
        "recent_top_words": recent_words,
        "word_trend_long": trend_long,
        "trend_wide": trend_wide,
        "word_trend_wide": word_trend_wide,
        "scan_csv": review_csv,
        "scan_csv_split": review_csv_split,
        "scan_tsv": scan_tsv,
        "scan_lines": review_lines,
        "latest_files": latest_event_files,
        "result_listing": result_listing,
        "bench_metrics": bench_rows(),
        "bench_metrics_coarse": bench_rows(COARSE_PLACES),
        "bench_saved": bench_saved,
        "bench_summary": bench_summary,
        "bench_sizes": lambda s, sf: distinct_keys(bench_rows()(s, sf), "size"),
        "bench_one_series": lambda s, sf: one_series(bench_rows()(s, sf), 4),
        "bench_throughput": bench_wide("throughput_rps"),
        "bench_latency": bench_wide("latency_s"),
    }


# ---------------------------------------------------------------- DuckDB counterparts

# DuckDB's \s is ASCII and lacks U+000B, so the spaces are spelled out.
SQL_SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SQL_PIECES = {
    "ws_alpha": f"regexp_split_to_array({{t}}, '{SQL_SPACE}+')",
    "ascii_runs": r"regexp_extract_all(lower({t}), '[\p{L}\p{N}_]+')",
    "nonword": r"regexp_split_to_array(lower({t}), '\W+')",
    "nonword_cased": r"regexp_split_to_array({t}, '\W+')",
    "ws_raw": r"regexp_split_to_array(lower({t}), '[\s\x0b]+')",
}
SQL_ACCEPT = {
    "ws_alpha": r"regexp_full_match(word, '\p{L}+')",
    "ascii_runs": "regexp_full_match(word, '[a-z]+')",
    "nonword": "word <> ''",
    "nonword_cased": "word <> ''",
    "ws_raw": "true",
}


def sql_words(
    rule: str, stops: tuple[str, ...] = (), source: str = "documents", text: str = "text",
    keep: str = "",
) -> str:
    """Rows `(word, keep)` of a source."""
    pieces = SQL_PIECES[rule].replace("{t}", text)
    extra = f", {keep}" if keep else ""
    shape = "lower(word)" if rule == "ws_alpha" else "word"
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in stops)
    drop = f" WHERE word NOT IN ({listed})" if stops else ""
    return (
        f"SELECT * FROM (SELECT {shape} AS word{extra} FROM "
        f"(SELECT unnest({pieces}) AS word{extra} FROM {source}) "
        f"WHERE {SQL_ACCEPT[rule]}){drop}"
    )


def sql_count(words: str) -> str:
    return f"SELECT word, count(*) AS count FROM ({words}) GROUP BY word"


SQL_TIMED = (
    "(SELECT text, lang, timestamp '2024-01-01 00:00:00' + "
    f"doc_id * interval {SECONDS_APART} seconds AS ts FROM documents)"
)


def sql_windows(rows: str, key: str, size: int, slide: int, closed_by: str = "") -> str:
    """Windowed counts; `closed_by` is a subquery for the last time seen."""
    counted_rows = (
        "SELECT window_start, window_start + interval {size} seconds AS window_end, {key}, "
        "count(*) AS count FROM (SELECT {key}, time_bucket(interval {slide} seconds, ts, "
        "{anchor}) - k * interval {slide} seconds AS window_start FROM ({rows}), range(0, {n}) "
        "r(k)) GROUP BY window_start, {key}"
    ).format(size=size, slide=slide, key=key, rows=rows, anchor=ANCHOR, n=size // slide)
    if not closed_by:
        return counted_rows
    return (
        f"SELECT * FROM ({counted_rows}) WHERE window_end <= "
        f"(SELECT date_trunc('millisecond', max(ts)) FROM {closed_by}) - interval 1 minute"
    )


def sql_win_words(
    rule: str, stops: tuple[str, ...], size: int, slide: int, closed: bool = False
) -> str:
    rows = sql_words(rule, stops, SQL_TIMED, keep="ts")
    return sql_windows(rows, "word", size, slide, SQL_TIMED if closed else "")


# What is sent as a message: rows without a review or a label are not.
SQL_SENT = "(SELECT * FROM documents WHERE text <> '' AND lang <> '')"
SQL_EVENTS = "(SELECT ts, event_type AS sentiment FROM events)"
SQL_LINES = (
    r"(SELECT regexp_replace(piece, '^SPACE+|SPACE+$', '', 'g') AS line FROM (SELECT unnest("
    r"regexp_split_to_array(text, '\r\n|\r|\n')) AS piece FROM documents))"
).replace("SPACE", SQL_SPACE)
SQL_LOG = (
    "(SELECT l_shipdate, l_linenumber AS workers, count(*) AS size, "
    "sum(l_quantity) / 1000.0 AS time_s FROM lineitem GROUP BY ALL)"
)


def sql_round(value: str, places: int) -> str:
    """Rounding of the exact binary value; DuckDB's round() scales first, which is inexact."""
    return f"format('{{:.{places}f}}', {value})::DOUBLE"


def sql_bench(time_places: int = 4, rate_places: int = 2, latency_places: int = 8) -> str:
    return (
        f"SELECT size, workers, {sql_round('time_s', time_places)} AS time_s, "
        f"{sql_round('size / time_s', rate_places)} AS throughput_rps, "
        f"{sql_round('time_s / size', latency_places)} AS latency_s FROM {SQL_LOG}"
    )


def sql_series(metric: str) -> str:
    columns = ", ".join(
        f"min(CASE WHEN workers = {w} THEN {metric} END) AS w{w}" for w in range(1, 8)
    )
    return f"SELECT size, {columns} FROM ({sql_bench()}) GROUP BY size"


# Every tenth message comes two files late; a window is late in a file if it ended a minute
# before the newest time in the files before the last one.
SQL_LATE = f"""
WITH sent AS (
    SELECT lang AS sentiment, ts, due + CASE WHEN doc_id % 10 = 3 THEN 2 ELSE 0 END AS part
    FROM (SELECT *, timestamp '2024-01-01 00:00:00' + doc_id * interval {SECONDS_APART} seconds AS ts,
                 doc_id * 4 // (SELECT max(doc_id) + 1 FROM documents) AS due FROM {SQL_SENT})
), limits AS (
    SELECT p.part, max(ts) - interval 1 minute AS mark
    FROM (SELECT DISTINCT part FROM sent) p LEFT JOIN sent ON sent.part <= p.part - 2 GROUP BY p.part
), windows AS (
    SELECT part, sentiment,
           time_bucket(interval 20 seconds, ts, {ANCHOR}) - k * interval 20 seconds AS window_start
    FROM sent, range(0, 3) r(k)
)
SELECT window_start, window_start + interval 60 seconds AS window_end, sentiment,
       count(*) AS count, coalesce(window_start + interval 60 seconds <= mark, false) AS late
FROM windows JOIN limits USING (part) GROUP BY ALL
"""


def oracle_sql() -> dict[str, str]:
    t1_lines = sql_words(
        "ws_alpha", source=f"{SQL_LINES} WHERE line <> ''", text="split_part(line, ',', 1)"
    )
    merged = " UNION ALL ".join(
        sql_words("nonword", source=name) for name in ("documents", "conversations", "benchmark")
    )
    sent = "strftime(timestamp '2024-01-01 00:00:00' + doc_id * interval 7 seconds, "
    sent += "'%Y-%m-%dT%H:%M:%S.000Z')"
    windows_60_30 = sql_win_words("ws_raw", STOP7, 60, 30)
    top_words = (
        f"SELECT word, sum(count)::BIGINT AS count FROM ({windows_60_30}) GROUP BY word "
        "ORDER BY count DESC, word LIMIT 10"
    )
    w60_20 = sql_win_words("nonword", STOP11, 60, 20)
    w30_10 = sql_win_words("nonword_cased", (), 30, 10)
    labels = "SELECT lang AS sentiment, count(*) AS count FROM documents GROUP BY lang"
    labels_of_sent = f"SELECT lang AS sentiment, count(*) AS count FROM {SQL_SENT}"
    words_of_sent = sql_count(sql_words("ws_alpha", STOP7, SQL_SENT))
    by_rank = ", ".join(
        f"coalesce(sum(count) FILTER (rank = {rank}), 0)::BIGINT AS top{rank}" for rank in range(1, 6)
    )
    ranked = (
        "SELECT word, row_number() OVER (ORDER BY sum(count) DESC, word) AS rank "
        f"FROM ({windows_60_30}) GROUP BY word"
    )
    labels_norm = (
        "SELECT lower(coalesce(lang, '')) AS sentiment, count(*) AS count FROM documents GROUP BY 1"
    )
    types = ("click", "error", "purchase", "signup", "view")
    type_columns = ", ".join(
        f"count(*) FILTER (event_type = '{t}') AS \"{t}\"" for t in types
    )
    return llm_queries()[1] | {
        "wc_ws_alpha": sql_count(sql_words("ws_alpha")),
        "wc_ascii_runs": sql_count(sql_words("ascii_runs")),
        "wc_nonword": sql_count(sql_words("nonword")),
        "wc_nonword_stop11": sql_count(sql_words("nonword", STOP11)),
        "wc_nonword_cased": sql_count(sql_words("nonword_cased")),
        "wc_ws_raw_stop7": sql_count(sql_words("ws_raw", STOP7)),
        "wc_ws_alpha_stop7": sql_count(sql_words("ws_alpha", STOP7)),
        "wc_ws_alpha_english": sql_count(sql_words("ws_alpha", ENGLISH)),
        "wc_stop_table": sql_count(sql_words("ws_alpha", ENGLISH)),
        "wc_merge_partials": sql_count(merged),
        "wc_csv_reviews": sql_count(sql_words("ascii_runs")),
        "wc_line_fields": sql_count(t1_lines),
        "top10_words": sql_count(sql_words("nonword", STOP11))
        + " ORDER BY count DESC, word LIMIT 10",
        "label_counts": labels,
        "label_counts_norm": labels_norm,
        "label_share": "SELECT replace(sentiment, '$', '\\$') AS sentiment, count, "
        "format('{:.1f}', count * 100::DOUBLE / (SELECT count(*) FROM documents))::DOUBLE "
        "AS percent "
        f"FROM ({labels_norm})",
        "total_records": "SELECT count(*) AS total FROM documents",
        "required_fields": "SELECT doc_id, lang AS sentiment FROM documents "
        "WHERE text <> '' AND lang <> ''",
        "messages_json": "SELECT doc_id, to_json({'review': text, 'sentiment': lang, "
        f"'created_at': {sent}}})::VARCHAR AS value FROM documents "
        "WHERE text <> '' AND lang <> ''",
        "messages_parsed": "SELECT text AS review, lang AS sentiment, ts AS event_time "
        f"FROM {SQL_TIMED} WHERE text <> '' AND lang <> ''",
        "parse_props": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
        "text_previews": "SELECT doc_id, CASE WHEN length(text) > 80 "
        "THEN substring(text, 1, 80) || '...' ELSE text END AS short, "
        "substring(text, 1, 80) || '...' AS marked, split_part(text, ',', 1) AS field, "
        "replace(text, '$', '\\$') AS label FROM documents",
        "prefix_sample": f"SELECT * FROM documents ORDER BY doc_id LIMIT {SAMPLE_SIZE}",
        "win_words_60_20": w60_20,
        "win_words_30_10": w30_10,
        "win_words_60_30": windows_60_30,
        "win_words_sorted": f"{w60_20} ORDER BY count DESC",
        "win_labels_30": sql_windows(SQL_EVENTS, "sentiment", 30, 30),
        "win_events_60m_20m": sql_windows(SQL_EVENTS, "sentiment", 3600, 1200),
        "stream_words_event_time": w60_20,
        "stream_words_broker_time": w30_10,
        "stream_words_saved": sql_win_words("ws_raw", STOP7, 60, 30, closed=True),
        "stream_labels_saved": sql_windows(SQL_EVENTS, "sentiment", 30, 30, SQL_EVENTS),
        "stream_labels_running": f"{labels_of_sent} GROUP BY lang",
        "stream_labels_running_norm": labels_norm.replace("FROM documents", f"FROM {SQL_SENT}"),
        "stream_words_running": sql_count(sql_words("ws_alpha", STOP7, SQL_SENT)),
        "stream_words_changes": sql_count(sql_words("ws_alpha", STOP7, SQL_SENT)),
        "stream_total_running": "SELECT count(*) AS total FROM documents "
        "WHERE text <> '' AND lang <> ''",
        "stream_message_files": sql_count(sql_words("ws_alpha", ENGLISH, SQL_SENT)),
        "stream_restart": sql_count(sql_words("ws_alpha", ENGLISH, SQL_SENT)),
        "stream_two_queries": f"SELECT 'label' AS kind, sentiment AS key, count FROM "
        f"({labels_of_sent} GROUP BY lang) UNION ALL SELECT 'word', word, count "
        f"FROM ({words_of_sent})",
        "stream_triggers": f"{labels_of_sent} GROUP BY lang",
        "arrival_labels": f"SELECT *, true AS timely FROM ({labels_of_sent} GROUP BY lang)",
        "base_names": "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages",
        "first_rows": "SELECT * FROM documents ORDER BY doc_id LIMIT 20",
        "recent_top_words": top_words,
        "word_trend_long": "SELECT window_start, word, sum(count)::BIGINT AS count FROM "
        f"({windows_60_30}) WHERE word IN (SELECT word FROM ({top_words})) GROUP BY ALL",
        "trend_wide": f"SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, {type_columns} "
        "FROM events GROUP BY 1",
        "word_trend_wide": f"SELECT window_start, {by_rank} FROM ({windows_60_30}) "
        f"JOIN ({ranked}) USING (word) WHERE rank <= 5 GROUP BY window_start",
        "scan_csv": "SELECT text AS review, lang AS sentiment FROM documents",
        "scan_csv_split": "SELECT text AS review, lang AS sentiment FROM documents",
        "scan_tsv": "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, "
        "event_type, props FROM events",
        "scan_lines": f"SELECT line FROM {SQL_LINES} WHERE line <> ''",
        "latest_files": "SELECT event_id, event_type FROM events WHERE ts::DATE IN "
        "(SELECT DISTINCT ts::DATE AS day FROM events ORDER BY day DESC LIMIT 5)",
        "result_listing": "SELECT DISTINCT 'run=' || strftime(date_trunc('month', l_shipdate), "
        "'%Y%m%d_%H%M%S') AS folder, 'part' AS shape, '.csv' AS suffix, 1::BIGINT AS files "
        "FROM lineitem",
        "schema_report": "SELECT position, column_name AS name, lower(replace(column_type, "
        "'VARCHAR', 'string')) AS type FROM (SELECT row_number() OVER ()::INTEGER AS position, * "
        "FROM (DESCRIBE documents))",
        "prefix_in_files": f"SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT {SAMPLE_SIZE}",
        "messages_fitting": f"SELECT doc_id, text AS review, lang AS sentiment, {sent} AS created_at "
        f"FROM {SQL_SENT} WHERE doc_id % 7 <> 0",
        "messages_unfit": "SELECT left(value, length(value) - 20) AS unparsed, count(*) AS count FROM "
        "(SELECT to_json({'review': text, 'sentiment': lang, "
        f"'created_at': {sent}}})::VARCHAR AS value FROM {SQL_SENT} WHERE doc_id % 7 = 0) GROUP BY 1",
        "stream_one_parse": "SELECT 'label' AS kind, NULL::TIMESTAMP AS window_start, sentiment AS key, "
        f"count FROM ({labels_of_sent} GROUP BY lang) UNION ALL "
        f"SELECT 'word', window_start, word, count FROM ({w60_20})",
        "stream_rates": "SELECT (doc_id % 4)::INTEGER AS batch, count(*) AS rows, true AS agrees, "
        f"(SELECT count(*) FROM {SQL_SENT}) AS total FROM {SQL_SENT} GROUP BY 1",
        "stream_windows_ending": w60_20,
        "stream_late_rows": SQL_LATE,
        "saved_by_day": f"SELECT * FROM ({sql_windows(SQL_EVENTS, 'sentiment', 30, 30, SQL_EVENTS)}) "
        "WHERE window_start::DATE - (SELECT min(ts)::DATE FROM events) IN (2, 3)",
        "latest_files_by_time": "SELECT event_id, event_type FROM events WHERE event_id % 5 IN (1, 2)",
        "bench_metrics": sql_bench(),
        "bench_metrics_coarse": sql_bench(*COARSE_PLACES),
        "bench_saved": sql_bench(),
        "bench_summary": "SELECT '20240101_000000' AS timestamp, count(*) AS total_records, "
        "8::INTEGER AS num_processes FROM lineitem",
        "bench_sizes": f"SELECT DISTINCT size FROM {SQL_LOG} ORDER BY size",
        "bench_one_series": f"SELECT * FROM ({sql_bench()}) WHERE workers = 4",
        "bench_throughput": sql_series("throughput_rps"),
        "bench_latency": sql_series("latency_s"),
    }
