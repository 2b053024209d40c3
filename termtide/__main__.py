"""Command line: `python -m termtide <job> ...`, or the same under spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.functions.stopwords import LISTS
from termtide.functions.words import RULES
from termtide.operators.benchmarks import bench_metrics, bench_series, run_summary
from termtide.operators.counts import label_counts, label_share, total_count
from termtide.operators.ranking import by_count, first_rows, top_k
from termtide.operators.tokens import drop_stop_words
from termtide.plans import live
from termtide.plans.batch import line_words, review_words, timing_sweep
from termtide.session import session
from termtide.sinks.streams import await_idle, to_console
from termtide.sinks.tables import (
    result_path,
    save_messages,
    send_reviews,
    summary_path,
    write_bench_results,
    write_summary,
)
from termtide.sources.streams import TOPIC, kafka_stream, message_files
from termtide.sources.tables import (
    read_bench_results,
    read_csv,
    read_csv_split,
    read_lines,
    read_tsv,
)
from termtide.streaming import reviews

SWEEP_SIZES = (1_000, 10_000, 100_000, 150_000)


def reviews_table(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "parquet":
        return spark.read.parquet(args.path)
    if args.format == "tsv":
        return read_tsv(spark, args.path)
    if args.format == "csv-split":
        return read_csv_split(spark, args.path)
    return read_csv(spark, args.path, multi_line=not args.single_line)


def messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return kafka_stream(spark, args.servers, args.topic, args.starting, args.max_offsets)
    return message_files(spark, args.files, args.max_files)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    table = reviews_table(spark, args)
    first_rows(table, 5).show()
    table.printSchema()


def words(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.lines:
        counts = line_words(read_lines(spark, args.path, args.header), args.first_field)
    else:
        counts = review_words(reviews_table(spark, args), args.rule)
    counts = drop_stop_words(counts, LISTS[args.stop])
    if args.out:
        counts.write.mode("overwrite").parquet(args.out)
    top_k(counts, args.top).show(args.top, truncate=False)


def labels(spark: SparkSession, args: argparse.Namespace) -> None:
    table = reviews_table(spark, args)
    by_count(label_share(label_counts(table, normalize=True)), ["sentiment"]).show(truncate=False)
    total_count(table).show()


def sweep(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = read_lines(spark, args.path, args.header)
    records = lines.withColumn("number", F.monotonically_increasing_id())
    log = timing_sweep(records, "number", "line", args.sizes)
    stamp = spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMdd_HHmmss')").first()[0]
    results = bench_metrics(log)
    write_bench_results(results, result_path(args.out, stamp))
    cores = spark.sparkContext.defaultParallelism
    summary = run_summary(records, cores, F.to_timestamp(F.lit(stamp), "yyyyMMdd_HHmmss"))
    write_summary(summary, summary_path(args.out, stamp))
    results.show(truncate=False)


def series(spark: SparkSession, args: argparse.Namespace) -> None:
    results = read_bench_results(spark, args.path)
    for metric in ("throughput_rps", "latency_s"):
        bench_series(results, metric).orderBy("size").show(truncate=False)


def send(spark: SparkSession, args: argparse.Namespace) -> None:
    table = reviews_table(spark, args)
    if args.servers:
        send_reviews(table, args.servers, args.topic)
    else:
        save_messages(table, args.out)


def watch(spark: SparkSession, args: argparse.Namespace) -> None:
    stream = messages(spark, args)
    if args.kind == "analysis":
        out = args.out or f"{args.checkpoint}/tables"
        live.words_and_labels(stream, out, f"{args.checkpoint}/offsets", bounded=args.bounded)
    elif args.kind == "broker-words":
        out = args.out or f"{args.checkpoint}/tables"
        live.broker_words(stream, out, f"{args.checkpoint}/offsets", bounded=args.bounded)
    elif args.kind == "labels":
        result = reviews.running_labels(stream, normalize=args.normalize)
        to_console(result, args.checkpoint, bounded=args.bounded)
    elif args.kind == "total":
        to_console(reviews.running_total(stream), args.checkpoint, bounded=args.bounded)
    elif args.kind == "running":
        result = top_k(reviews.running_words(stream, LISTS[args.stop]))
        to_console(result, args.checkpoint, rows=10, bounded=args.bounded)
    elif args.kind == "save-words":
        live.save_words(stream, args.out, args.checkpoint, args.bounded, args.by_day)
    else:
        live.save_labels(stream, args.out, args.checkpoint, args.bounded, args.by_day)
    if args.bounded:
        for query in spark.streams.active:
            query.awaitTermination()
    elif args.idle:
        for query in spark.streams.active:
            await_idle(query, args.idle)
    else:
        live.await_any(spark)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    top, trend = live.recent_report(spark, args.path, args.files, args.top, args.by)
    top.show(args.top, truncate=False)
    trend.orderBy("window_start").show(truncate=False)


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="termtide", description=__doc__)
    main.add_argument("--master", help="Spark master where spark-submit does not set one")
    jobs = main.add_subparsers(dest="job", required=True)

    def job(run, *, table: bool = False, broker: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__)
        sub.set_defaults(run=run)
        if table:
            sub.add_argument("path")
            sub.add_argument("--format", choices=["csv", "csv-split", "tsv", "parquet"], default="csv")
            sub.add_argument("--single-line", action="store_true")
        if broker:
            sub.add_argument("--servers")
            sub.add_argument("--topic", default=TOPIC)
        return sub

    job(load, table=True)
    sub = job(words, table=True)
    sub.add_argument("--rule", choices=list(RULES), default="ascii_runs")
    sub.add_argument("--stop", choices=list(LISTS), default="none")
    sub.add_argument("--lines", action="store_true")
    sub.add_argument("--first-field", action="store_true")
    sub.add_argument("--header")
    sub.add_argument("--top", type=int, default=10)
    sub.add_argument("--out")
    job(labels, table=True)
    sub = job(sweep)
    sub.add_argument("path")
    sub.add_argument("out")
    sub.add_argument("--sizes", type=int, nargs="*", default=SWEEP_SIZES)
    sub.add_argument("--header")
    job(series).add_argument("path")
    sub = job(send, table=True, broker=True)
    sub.add_argument("--out")
    sub = job(watch, broker=True)
    sub.add_argument(
        "kind",
        choices=[
            "analysis",
            "broker-words",
            "labels",
            "total",
            "running",
            "save-words",
            "save-labels",
        ],
    )
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--starting", choices=["earliest", "latest"], default="earliest")
    sub.add_argument("--files")
    sub.add_argument("--max-files", type=int)
    sub.add_argument("--max-offsets", type=int)
    sub.add_argument("--normalize", action="store_true")
    sub.add_argument("--idle", type=float, help="end after so many seconds without messages")
    sub.add_argument("--stop", choices=list(LISTS), default="stop7")
    sub.add_argument("--out")
    sub.add_argument("--bounded", action="store_true")
    sub.add_argument("--by-day", action="store_true", help="save windows in a folder a day")
    sub = job(report)
    sub.add_argument("path")
    sub.add_argument("--files", type=int, default=5)
    sub.add_argument("--top", type=int, default=10)
    sub.add_argument("--by", choices=["mtime", "name", "batch"], default="mtime")
    return main


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session(f"termtide-{args.job}", args.master)
    args.run(spark, args)


if __name__ == "__main__":
    main()
