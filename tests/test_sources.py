"""Readers and writers, round trips through files."""

import csv
import datetime
import io
import os
import time
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from termtide.operators.benchmarks import bench_metrics, run_summary
from termtide.plans.batch import line_words, review_words, timing_sweep
from termtide.session import (
    INITIAL_PARTITIONS,
    scratch_dir,
    spread,
    spread_tasks,
    use_cluster_sizes,
)
from termtide.sinks.tables import (
    kafka_sink_options,
    result_path,
    schema_report,
    summary_path,
    write_bench_results,
    write_summary,
)
from termtide.sources.streams import kafka_options
from termtide.sources.tables import (
    days_of,
    first_in_files,
    join_small_files,
    latest_files,
    list_files,
    list_results,
    newest_files,
    read_bench_results,
    read_csv,
    read_csv_split,
    read_joined,
    read_lines,
    read_summary,
    read_tsv,
    read_windowed,
    sink_files,
)


def save(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


def test_csv(spark, tmp_path):
    path = save(
        f"{tmp_path}/r.csv",
        'sentiment,review\npos,"He said ""hi, all"" ok"\nneg,"two\nlines"\n,none\npos,\n"",x\n',
    )
    rows = [(r.review, r.sentiment) for r in read_csv(spark, path).collect()]
    assert rows == [
        ('He said "hi, all" ok', "pos"), ("two\nlines", "neg"), ("none", None), (None, "pos"),
        ("x", None),
    ]
    counts = {r["word"]: r["count"] for r in review_words(read_csv(spark, path)).collect()}
    assert counts["ok"] == 1 and counts["lines"] == 1 and "" not in counts


CSV_CASES = [
    'review,sentiment\npos "x" y,a\n',
    'sentiment,review\npos,"He said ""hi, all"" ok"\nneg,"two\nlines"\n,none\n\npos,\n"",x\n',
    'review,sentiment\r\n"a\r\n\r\nb""\r\n""c",pos\r\nlast,neg',
    "review,sentiment\n",
]


def plain(rows):
    """Rows with NULL as the empty string, which Python's reader gives."""
    return Counter(tuple(v or "" for v in row) for row in rows)


@pytest.mark.parametrize("case", range(len(CSV_CASES)))
def test_csv_equals_python(spark, tmp_path, case):
    path = save(f"{tmp_path}/r.csv", CSV_CASES[case])
    reader = csv.DictReader(io.StringIO(CSV_CASES[case], newline=""))
    expected = [tuple(row.values()) for row in reader]
    split = read_csv_split(spark, path)
    assert split.columns == reader.fieldnames
    assert plain(split.collect()) == plain(expected)
    # The whole-file reader turns line breaks inside fields into plain newlines.
    newlines = [tuple((v or "").replace("\r\n", "\n") for v in row) for row in expected]
    assert plain(read_csv(spark, path).collect()) == plain(newlines)


def test_split_csv_in_many_small_splits(spark, small, tmp_path):
    """Splits far smaller than some records, so that records cross several of them."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select(F.col("text").alias("review"), F.col("lang").alias("sentiment"))
    rows = rows.union(rows.where("lang = 'fr'"))
    with open(f"{tmp_path}/big.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["review", "sentiment"])
        writer.writerows(tuple(r) for r in rows.collect())
    size = os.path.getsize(f"{tmp_path}/big.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        path = f"{tmp_path}/big.csv"
        split_count = spark.read.text(path).select("_metadata.file_block_start").distinct().count()
        assert split_count > size / 4_000
        got = Counter(map(tuple, read_csv_split(spark, path).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == Counter(map(tuple, rows.collect()))


def test_split_csv_in_runs_of_lines(spark, tmp_path, monkeypatch):
    """One split of Spark's is put together in many runs, also where records cross several."""
    rows = [(f"{n}" + "\n" * (n % 40) + '"x"', f"s{n}") for n in range(300)]
    for name in ("a", "b"):
        with open(f"{tmp_path}/{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(["review", "sentiment"])
            writer.writerows(rows)
    monkeypatch.setattr("termtide.sources.tables.LINES_TOGETHER", 8)
    got = read_csv_split(spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(rows * 2)
    assert "run" in got._jdf.queryExecution().optimizedPlan().toString()


def test_tsv(spark, tmp_path):
    path = save(f"{tmp_path}/r.tsv", 'id\tbody\n1\ta "b" c\n2\t"q\n')
    table = read_tsv(spark, path, quote="")
    assert [tuple(r) for r in table.collect()] == [("1", 'a "b" c'), ("2", '"q')]
    assert [tuple(r) for r in schema_report(table).orderBy("position").collect()] == [
        (1, "id", "string"), (2, "body", "string"),
    ]
    assert read_tsv(spark, path).columns == ["id", "body"]


def test_lines(spark, tmp_path):
    path = save(f"{tmp_path}/r.txt", "review,sentiment\r\n good film,pos \n\n　\nbad film, x,neg\n")
    lines = sorted(r.line for r in read_lines(spark, path).collect())
    assert lines == ["bad film, x,neg", "good film,pos", "review,sentiment"]
    kept = read_lines(spark, path, header="review,sentiment")
    assert {r["word"]: r["count"] for r in line_words(kept).collect()} == {
        "good": 1, "bad": 1, "film": 2,
    }
    whole = {r["word"]: r["count"] for r in line_words(kept, first_only=False).collect()}
    assert whole == {"good": 1, "bad": 1}


def test_latest_files(spark, folder):
    for n in range(8):
        spark.range(n * 10, n * 10 + 10).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    newest = latest_files(spark, folder, 5)
    assert sorted(r.id for r in newest.collect()) == list(range(30, 80))
    # Times set by hand, against the order in which the files were written.
    files = sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))
    for age, path in enumerate(files):
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))
    by_time, by_name = newest_files(spark, folder, 3), newest_files(spark, folder, 3, "name")
    assert [os.path.basename(p) for p in by_time] == [os.path.basename(p) for p in files[:3]]
    assert [os.path.basename(p) for p in by_name] == [os.path.basename(p) for p in files[:-4:-1]]
    assert latest_files(spark, folder, 50).count() == 80
    with pytest.raises(ValueError):
        latest_files(spark, folder, 5, by="size")


def test_latest_files_skips_the_others(spark, folder):
    spark.range(80).repartition(8).write.parquet(folder)
    newest = latest_files(spark, folder, 2)
    newest.collect()
    scans = newest._jdf.queryExecution().executedPlan().collectLeaves()
    files = [scans.apply(n).metrics().apply("numFiles").value() for n in range(scans.size())]
    assert files == [2]


def test_listing_reads_no_data(spark, folder):
    spark.range(80).repartition(3).write.parquet(folder)
    listed = list_files(spark, folder, "*.parquet")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    sizes = {os.path.join(folder, f): os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder)}
    got = {r.path.removeprefix("file:"): r.bytes for r in listed.collect()}
    assert len(got) == 3 and all(sizes[path] == size for path, size in got.items())


def test_files_of_a_stream_by_batch(spark, tmp_path):
    """Also where the sink has merged its log; files no batch has committed are left out."""
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(13):
        path = save(f"{inbox}/{n}.txt", f"row{n}\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(inbox)
    writer = stream.writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert any(f.endswith(".compact") for f in os.listdir(f"{out}/_spark_metadata"))
    spark.createDataFrame([("stray",)], "value string").write.mode("append").parquet(out + "2")
    stray = next(f for f in os.listdir(out + "2") if f.endswith(".parquet"))
    os.link(f"{out}2/{stray}", f"{out}/{stray}")
    assert sink_files(spark, out).count() == 13
    for n in (1, 3, 13):
        got = latest_files(spark, out, n, by="batch")
        assert sorted(r.value for r in got.collect()) == sorted(f"row{k}" for k in range(13 - n, 13))


def test_first_in_files(spark, folder):
    """As a slice of all records in the order of files, without a key."""
    spark.range(1_000).withColumn("x", F.hash("id")).repartition(7).write.parquet(folder)
    table = spark.read.parquet(folder)
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    every = [r.id for f in files for r in spark.read.parquet(f"{folder}/{f}").collect()]
    for size in (0, 1, 143, 500, 999, 1_000, 5_000):
        got = first_in_files(table, size)
        assert sorted(r.id for r in got.collect()) == sorted(every[:size])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan
    assert first_in_files(table.limit(0), 5).count() == 0


def windows_of(spark, days):
    rows = [(f"2024-01-0{d} 10:00:00", f"w{i}", i) for d in days for i in range(5)]
    made = spark.createDataFrame(rows, "at string, word string, count bigint")
    start = F.col("at").cast("timestamp")
    return made.select(F.struct(start.alias("start"), start.alias("end")).alias("window"), "word", "count")


def test_small_files_are_joined(spark, tmp_path):
    saved, joined = str(tmp_path / "saved"), str(tmp_path / "joined")
    for part in range(4):
        made = windows_of(spark, [1, 2, 3]).withColumn("day", F.to_date("window.start"))
        made.repartition(3).write.mode("append").partitionBy("day").parquet(saved)
    whole = sorted(map(str, read_windowed(spark, saved).collect()))
    assert sorted(map(str, read_joined(spark, saved, joined).collect())) == whole
    for _ in range(2):
        join_small_files(spark, saved, joined, datetime.date(2024, 1, 3))
        assert days_of(spark, joined) == [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)]
        assert list_files(spark, joined, "*.parquet").count() == 2
        assert sorted(map(str, read_joined(spark, saved, joined).collect())) == whole
    day = datetime.date(2024, 1, 2)
    some = read_joined(spark, saved, joined, day, day)
    assert some.count() == 20 and some.columns == ["window", "word", "count"]
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
    assert read_windowed(spark, saved, day).count() == 40
    plain = str(tmp_path / "plain")
    windows_of(spark, [1, 2]).write.parquet(plain)
    assert read_windowed(spark, plain, day, day).count() == 5


def test_results_and_summary(spark, tmp_path):
    log = spark.createDataFrame([(1000, 4, 0.12), (1000, 8, 0.1)], "size long, workers int, time_s double")
    for stamp in ("20240101_000000", "20240102_000000"):
        write_bench_results(bench_metrics(log), result_path(str(tmp_path), stamp))
    path = result_path(str(tmp_path), "20240101_000000")
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    header = open(os.path.join(path, part)).readline().strip()
    assert header == "Size,Workers,Time(s),Throughput(rps),Latency(s/record)"
    assert sorted(map(tuple, read_bench_results(spark, path).collect())) == sorted(
        map(tuple, bench_metrics(log).collect())
    )
    assert read_bench_results(spark, f"{tmp_path}/performance_metrics_*.csv").count() == 4
    listed = list_results(spark, str(tmp_path)).collect()
    assert sorted(r.folder for r in listed) == [
        "performance_metrics_20240101_000000.csv", "performance_metrics_20240102_000000.csv",
    ]
    assert all(r.file_name.endswith(".csv") for r in listed)
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp")
    write_summary(run_summary(log, 8, moment), summary_path(str(tmp_path), "20240101_000000"))
    summary = read_summary(spark, summary_path(str(tmp_path), "20240101_000000")).first()
    assert tuple(summary) == ("20240101_000000", 2, 8)


def test_sweep(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    log = timing_sweep(docs, "doc_id", "text", [50, 5_000]).collect()
    assert [r["size"] for r in log] == [50, docs.count(), docs.count()]
    assert all(r.time_s > 0 and r.workers == 4 for r in log)


def test_kafka_options():
    assert kafka_options("h:9092", starting="latest") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "reviews", "startingOffsets": "latest",
    }
    assert kafka_sink_options("h:9092") == {"kafka.bootstrap.servers": "h:9092", "topic": "reviews"}
    with pytest.raises(ValueError):
        kafka_options("h:9092", starting="middle")


def test_kafka_rate_limit():
    assert kafka_options("h:9092", max_offsets_per_trigger=500)["maxOffsetsPerTrigger"] == "500"


def test_spread_only_scans_of_few_tasks(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert spread(docs).rdd.getNumPartitions() == 8
    many = docs.repartition(4)
    assert spread_tasks(many) is None and spread(many) is many


@pytest.mark.parametrize(
    "text",
    [
        'review,sentiment\n5" screen,pos\nok,neg\nfine,pos\n',
        'review,sentiment\n"open,pos\nok,neg\n',
        "review,sentiment\rgood,pos\rbad,neg\r",
        "\nreview,sentiment\ngood,pos\n",
    ],
)
def test_split_csv_refuses_what_it_cannot_put_together(spark, tmp_path, text):
    path = save(f"{tmp_path}/odd.csv", text)
    with pytest.raises(Exception, match="use read_csv"):
        read_csv_split(spark, path).collect()


def test_tsv_quotes_and_line_breaks(spark, tmp_path):
    path = save(f"{tmp_path}/q.tsv", 'id\tbody\n1\t"say ""hi"" now"\n2\t"two\nlines"\n')
    rows = [tuple(r) for r in read_tsv(spark, path).collect()]
    assert rows == [("1", 'say "hi" now'), ("2", "two\nlines")]


def test_header_is_dropped_as_first_line_only(spark, tmp_path):
    save(f"{tmp_path}/a.txt", "head\none\nhead\n")
    save(f"{tmp_path}/b.txt", "two\nhead\n")
    lines = sorted(r.line for r in read_lines(spark, str(tmp_path), header="head").collect())
    assert lines == ["head", "head", "one", "two"]


def stub(setting, master):
    """Stands for a session: the folder is a core setting, fixed when a context starts."""
    conf = SimpleNamespace(get=lambda key, default=None: setting)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_dir():
    shared = stub("hdfs://shared/tmp/", "yarn")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second
    assert "termtide" in scratch_dir(stub(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch_dir(stub(None, "yarn"), "x")


def test_cluster_sizes():
    def cluster(master, initial):
        held = {"spark.sql.shuffle.partitions": "200"}
        if initial:
            held[INITIAL_PARTITIONS] = initial
        conf = SimpleNamespace(
            get=lambda key, *default: held.get(key, *default), set=held.__setitem__
        )
        context = SimpleNamespace(master=master, defaultParallelism=1_000)
        use_cluster_sizes(SimpleNamespace(conf=conf, sparkContext=context))
        return held.get(INITIAL_PARTITIONS)

    assert cluster("yarn", None) == "4000"
    assert cluster("yarn", "50") == "50"
    assert cluster("local[4]", None) is None
