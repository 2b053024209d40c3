"""Streams over files: equality with batch, late data, restart, sinks."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException, StreamingQueryException

from termtide.operators.ranking import by_count
from termtide.operators.windows import flat_window, windowed_count
from termtide.plans import live
from termtide.sinks import streams
from termtide.sinks.streams import (
    await_idle,
    read_changes,
    read_ended_windows,
    read_snapshot,
    to_changes,
    to_console,
    to_ended_windows,
    to_parquet,
    to_snapshots,
)
from termtide.sources.streams import message_files, table_files
from termtide.sources.tables import read_windowed
from termtide.streaming import reviews as R

ROWS = [
    {"review": "The cat the DOG", "sentiment": "Pos", "created_at": "2024-01-01T00:00:05Z"},
    {"review": "a dog's day", "sentiment": "neg", "created_at": "2024-01-01T00:00:45Z"},
    {"review": "day of the cat", "sentiment": None, "created_at": "2024-01-01T00:02:00Z"},
    {"review": "no time at all", "sentiment": "pos"},
    {"review": "bad time", "sentiment": "pos", "created_at": "nope"},
]
LATE = [
    [("hello", "2024-01-01T00:00:30Z")],
    [("world", "2024-01-01T00:10:00Z")],
    [("late1", "2024-01-01T00:00:31Z"), ("notime", None)],
    [("late2", "2024-01-01T00:00:32Z")],
    [("x", "2024-01-01T00:20:00Z")],
]


def put(folder, name, rows, when=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        for row in rows:
            out.write(row if isinstance(row, str) else json.dumps(row))
            out.write("\n")
    if when:
        os.utime(path, (when, when))


@pytest.fixture
def inbox(tmp_path):
    folder = str(tmp_path / "inbox")
    put(folder, "1.json", ROWS[:2], 1_700_000_000)
    put(folder, "2.json", ROWS[2:] + ["garbage"], 1_700_000_010)
    return folder


def static(spark, inbox):
    return spark.read.text(inbox).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def rows_of(df):
    return sorted(map(str, df.collect()))


def snapshot(spark, result, tmp_path, **kw):
    out = str(tmp_path / "out")
    to_snapshots(result, out, str(tmp_path / "offsets"), bounded=True, **kw).awaitTermination()
    return read_snapshot(spark, out)


JOBS = {
    "event_time": R.words_by_event_time,
    "broker_time": R.words_by_broker_time,
    "labels": R.running_labels,
    "words": R.running_words,
    "total": R.running_total,
}


@pytest.mark.parametrize("job", JOBS)
def test_stream_equals_batch(spark, inbox, tmp_path, job):
    stream = message_files(spark, inbox, max_files_per_trigger=1)
    got = snapshot(spark, JOBS[job](stream), tmp_path)
    expected = JOBS[job](static(spark, inbox))
    assert rows_of(got) == rows_of(expected) and expected.count() > 0


def test_panes_equal_windows(spark, inbox, tmp_path):
    words = R.words_at_event_time(message_files(spark, inbox, max_files_per_trigger=1))
    finish = R.windows_from("60 seconds", "20 seconds")
    got = snapshot(spark, R.panes(words, "20 seconds"), tmp_path, finish=finish)
    assert rows_of(got) == rows_of(R.words_by_event_time(static(spark, inbox)))


def test_changes_equal_batch(spark, inbox, tmp_path):
    out = str(tmp_path / "changes")
    result = R.running_words(message_files(spark, inbox, max_files_per_trigger=1))
    to_changes(result, out, str(tmp_path / "c"), ["word"], bounded=True).awaitTermination()
    got = read_changes(spark, out, ["word"])
    assert rows_of(got) == rows_of(R.running_words(static(spark, inbox)))


def test_old_snapshots_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "inbox")
    for n in range(5):
        put(folder, f"{n}.json", [{"review": "a", "sentiment": "s"}], 1_700_000_000 + n)
    result = R.running_total(message_files(spark, folder, max_files_per_trigger=1))
    got = snapshot(spark, result, tmp_path, keep=2)
    assert got.first().total == 5
    assert sorted(f for f in os.listdir(tmp_path / "out")) == ["batch=3", "batch=4"]
    with pytest.raises(ValueError):
        snapshot(spark, result, tmp_path, keep=1)


def test_labels_count_bad_messages(spark, inbox):
    got = {r.sentiment: r["count"] for r in R.running_labels(static(spark, inbox)).collect()}
    assert got == {"Pos": 1, "neg": 1, None: 2, "pos": 2}
    normal = R.running_labels(static(spark, inbox), normalize=True)
    assert {r.sentiment: r["count"] for r in normal.collect()} == {"pos": 3, "neg": 1, "": 2}


def late_stream(spark, tmp_path):
    folder = str(tmp_path / "late")
    for n, batch in enumerate(LATE):
        rows = [{"review": w, "sentiment": "s", "created_at": t} for w, t in batch]
        put(folder, f"{n}.json", rows, 1_700_000_000 + n)
    return message_files(spark, folder, max_files_per_trigger=1)


def test_late_data_complete(spark, tmp_path):
    got = snapshot(spark, R.words_by_event_time(late_stream(spark, tmp_path)), tmp_path)
    assert {r.word: r.n for r in got.groupBy("word").agg(F.count("*").alias("n")).collect()} == {
        "hello": 3, "world": 3, "late1": 3, "late2": 3, "x": 3,
    }


def test_late_data_append(spark, tmp_path):
    out = str(tmp_path / "out")
    result = R.words_by_event_time(late_stream(spark, tmp_path))
    to_parquet(result, out, str(tmp_path / "offsets"), bounded=True).awaitTermination()
    assert sorted(r.word for r in spark.read.parquet(out).distinct().collect()) == [
        "hello"] * 3 + ["late1"] * 3 + ["world"] * 3


def test_append_equals_closed_windows(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    stream = table_files(spark, f"{small}/events*.parquet", events.schema)

    def timed(df):
        return df.select(F.col("ts").cast("timestamp").alias("event_time"), "event_type")

    out = str(tmp_path / "out")
    result = R.saved_labels(timed(stream), "event_type")
    to_parquet(result, out, str(tmp_path / "offsets"), bounded=True).awaitTermination()
    whole = flat_window(R.saved_labels(timed(events), "event_type"))
    closed = whole.where(
        F.col("window_end")
        <= timed(events).select(F.max("event_time") - F.expr("interval 1 minute")).scalar()
    )
    assert rows_of(flat_window(spark.read.parquet(out))) == rows_of(closed)


def test_restart_counts_once(spark, inbox, tmp_path):
    def run():
        result = R.running_labels(message_files(spark, inbox))
        got = snapshot(spark, result, tmp_path)
        return {r.sentiment: r["count"] for r in got.collect()}

    first = run()
    assert run() == first
    put(inbox, "3.json", [{"review": "more", "sentiment": "neg"}])
    assert run() == {**first, "neg": first["neg"] + 1}


def test_arrival_time_jobs(spark, inbox, tmp_path):
    """Windows by arrival stay open in a bounded run; the rows are held as state."""
    stream = message_files(spark, inbox)
    query = to_parquet(
        R.words_by_arrival(stream), str(tmp_path / "w"), str(tmp_path / "c1"), bounded=True
    )
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] > 0
    batch = R.labels_by_arrival(static(spark, inbox))
    assert sum(r["count"] for r in batch.collect()) == 6
    assert set(batch.columns) == {"window", "sentiment", "count"}


def test_console_sorted_and_one_stream(spark, inbox, tmp_path):
    stream = message_files(spark, inbox)
    query = live.words_and_labels(stream, str(tmp_path / "t"), str(tmp_path / "c"), bounded=True)
    live.await_any(spark)
    query.awaitTermination()
    assert query.exception() is None
    assert query.recentProgress[0]["numInputRows"] == 6
    spark.streams.resetTerminated()
    result = by_count(R.words_by_broker_time(stream))
    to_console(result, str(tmp_path / "c2"), bounded=True).awaitTermination()


def test_await_idle_stops_a_quiet_query(spark, inbox, tmp_path):
    result = R.running_total(message_files(spark, inbox))
    query = to_snapshots(result, str(tmp_path / "o"), str(tmp_path / "c"), every="1 second")
    await_idle(query, idle_seconds=5)
    assert not query.isActive
    assert read_snapshot(spark, str(tmp_path / "o")).first().total == 6


def test_saved_by_day(spark, small, tmp_path):
    """Windows appended in a folder a day are read by day, and equal those saved without days."""
    events = spark.read.parquet(f"{small}/events.parquet")

    def saved(name, **kw):
        stream = table_files(spark, f"{small}/events*.parquet", events.schema)
        timed = stream.select(F.col("ts").cast("timestamp").alias("event_time"), "event_type")
        out = str(tmp_path / name)
        result = R.saved_labels(timed, "event_type")
        to_parquet(result, out, str(tmp_path / f"c{name}"), bounded=True, **kw).awaitTermination()
        return out

    plain, by_day = saved("plain"), saved("days", by_day=True)
    assert rows_of(read_windowed(spark, by_day)) == rows_of(read_windowed(spark, plain))
    day = events.select(F.to_date(F.min("ts")) + 2).first()[0]
    some = read_windowed(spark, by_day, day, day)
    assert rows_of(some) == rows_of(read_windowed(spark, plain, day, day)) and some.count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_saved_report(spark, inbox, tmp_path):
    timed = static(spark, inbox).select(
        F.lit("dog cat").alias("review"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("event_time"),
    )
    out = str(tmp_path / "saved")
    R.saved_words(timed).write.parquet(out)
    top, wide = live.recent_report(spark, out, n=2)
    assert [(r.word, r["count"]) for r in top.collect()] == [("cat", 12), ("dog", 12)]
    assert [(r.cat, r.dog) for r in wide.collect()] == [(6, 6), (6, 6)]


def test_refused_modes(spark, inbox, tmp_path):
    stream = message_files(spark, inbox)
    unbounded = R.words_by_broker_time(stream)
    with pytest.raises(AnalysisException):
        to_parquet(unbounded, str(tmp_path / "o"), str(tmp_path / "c"), bounded=True)
    with pytest.raises(AnalysisException):
        windowed = windowed_count(stream.withColumn("t", F.lit("x")), "t", [], "1 minute")
        to_snapshots(windowed.withWatermark("t", "1 minute"), "o", "c", bounded=True)


# Seconds and words by batch. The watermark lags by 60 s: the second batch counts on in open windows
# and brings a word too late for all of its windows and one too late for the first of its two; the
# third has no times at all, the fourth is late as a whole, and the last leaves its windows open.
SECONDS = [
    [(5, "k"), (35, "k b"), (95, "c")],
    [(-20, "late"), (20, "half"), (80, "d"), (96, "c"), (200, "e e"), (130, "f")],
    [(None, "notime")],
    [(60, "late")],
    [(90_000.5, "g"), (89_930, "h")],
]


def ended_by_hand():
    found, seen = Counter(), None
    for batch in SECONDS:
        before = seen
        for when, text in batch:
            if when is None:
                continue
            for start in (when // 30 * 30, when // 30 * 30 - 30):
                if before is None or start + 60 > before - 60:
                    found.update((int(start), word) for word in text.split(" "))
            seen = when if seen is None else max(seen, when)
    return {key: n for key, n in found.items() if key[0] + 60 <= seen - 60}


def save_ended(spark, tmp_path, batches):
    """The batches as files of `(review, event_time)`, one run of the stream over them."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = table_files(spark, f"{folder}/*", "review string, event_time timestamp", 1)
    for number in batches:
        rows = [(None if when is None else float(when), text) for when, text in SECONDS[number]]
        rows = spark.createDataFrame(rows, "seconds double, review string")
        time = F.timestamp_seconds(F.col("seconds") + 1_704_067_200).alias("event_time")
        path = f"{folder}/part={number}"
        rows.select("review", time).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 + number,) * 2)
    stream = stream.select("review", "event_time")
    return out, to_ended_windows(
        stream, R.saved_tokens, out, str(tmp_path / "c"), "event_time", ["word"], R.SAVED_WINDOWS, R.DELAY,
        bounded=True,
    )


def ended_rows(spark, out):
    start = (F.col("window.start").cast("long") - 1_704_067_200).alias("start")
    length = F.col("window.end").cast("long") - F.col("window.start").cast("long")
    rows = read_ended_windows(spark, out).select(start, length.alias("length"), "word", "count").collect()
    assert all(r.length == 60 for r in rows)
    assert len({(r.start, r.word) for r in rows}) == len(rows)
    return {(r.start, r.word): r["count"] for r in rows}


@pytest.mark.parametrize("most", (32 << 20, 60, 0))
def test_ended_windows_over_batches(spark, tmp_path, monkeypatch, most):
    """Whether no block, some or all of them are above what a task counts."""
    from termtide.sinks import streams

    monkeypatch.setattr(streams, "BLOCK_MOST_BYTES", most)
    out, query = save_ended(spark, tmp_path, range(len(SECONDS)))
    query.awaitTermination()
    assert len(query.recentProgress) >= len(SECONDS)
    assert all(not p["stateOperators"] for p in query.recentProgress)
    want = ended_by_hand()
    assert want[(60, "c")] == 2 and (0, "half") in want and (-30, "half") not in want
    assert not {"g", "late", "notime"} & {word for _, word in want}
    assert ended_rows(spark, out) == want


def test_ended_windows_after_a_failure(spark, tmp_path, monkeypatch):
    """A batch that wrote its windows and was lost before its marker counts once, after a restart."""
    from termtide.sinks import streams

    mark = streams._mark_done

    def failing(spark, path, batch_id, seen):
        if batch_id == 1:
            raise RuntimeError("lost")
        mark(spark, path, batch_id, seen)

    monkeypatch.setattr(streams, "_mark_done", failing)
    out, query = save_ended(spark, tmp_path, range(2))
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    first = ended_rows(spark, out)
    assert set(first.items()) <= set(ended_by_hand().items())
    monkeypatch.setattr(streams, "_mark_done", mark)
    out, query = save_ended(spark, tmp_path, range(2, len(SECONDS)))
    query.awaitTermination()
    assert ended_rows(spark, out) == ended_by_hand()


def test_only_complete_batches_are_read(spark, tmp_path):
    from termtide.sinks.streams import _mark_done

    path = str(tmp_path / "out")
    for batch, words in enumerate((["a"], ["a", "b"])):
        rows = spark.createDataFrame([(w, batch + 1) for w in words], "word string, count bigint")
        rows.write.parquet(f"{path}/batch={batch}")
        if batch == 0:
            _mark_done(spark, path, batch)
    assert [tuple(r) for r in read_snapshot(spark, path).collect()] == [("a", 1)]


COUNTED = {
    "event": (R.messages_at_event_time, R.event_tokens, R.WORD_WINDOWS, R.words_by_event_time),
    "broker": (R.with_broker_time, R.broker_tokens, ("30 seconds", "10 seconds"), R.words_by_broker_time),
}


@pytest.mark.parametrize("kind, most_shared, most", [("event", 1_000, 32 << 20), ("event", 0, 10), ("broker", 1_000, 32 << 20)])
def test_counted_snapshots(spark, inbox, tmp_path, monkeypatch, kind, most_shared, most):
    """Each snapshot holds all windows so far, late ones too, and no state store any of them (F3, F4)."""
    monkeypatch.setattr("termtide.sinks.streams.MOST_SHARED", most_shared)
    monkeypatch.setattr("termtide.sinks.streams.BLOCK_MOST_BYTES", most)
    timed, tokens, windows, at_once = COUNTED[kind]
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    further = [
        [{"review": "the day The cat", "sentiment": "s", "created_at": f"2024-01-01T{t}Z"} for t in ("09:00:00", "00:00:06")],
        [],
        [{"review": "cat dog", "sentiment": None, "created_at": f"2024-01-01T{t}Z"} for t in ("08:59:59", "09:30:00")],
    ]
    for n, rows in enumerate([None, *further]):
        if rows is not None:
            put(inbox, f"more-{n}.json", rows, 1_700_000_000 + 5 * n)
        stream = timed(message_files(spark, inbox, max_files_per_trigger=1))
        to_snapshots(stream, out, offsets, bounded=True, tokens=tokens, blocks=windows).awaitTermination()
        got = R.windows_from_blocks(*windows)(read_snapshot(spark, out))
        assert rows_of(got) == rows_of(at_once(static(spark, inbox)))
    assert got.count() > 0 and not os.path.exists(f"{offsets}/state")
    assert spark.read.parquet(f"{out}/batch=4").groupBy("window", "word").count().where("count > 1").count() == 0


def test_a_counted_snapshot_that_failed_counts_once(spark, inbox, tmp_path, monkeypatch):
    """A batch whose snapshot was written but not marked is counted anew from the one before (F3, F4)."""
    out, offsets, marks = str(tmp_path / "out"), str(tmp_path / "offsets"), []

    def failing(*args):
        marks.append(args)
        if len(marks) == 2:
            raise RuntimeError("lost")
        mark(*args)

    def run():
        stream = R.messages_at_event_time(message_files(spark, inbox, max_files_per_trigger=1))
        query = to_snapshots(stream, out, offsets, bounded=True, tokens=R.event_tokens, blocks=R.WORD_WINDOWS)
        query.awaitTermination()

    mark = streams._mark_done
    monkeypatch.setattr(streams, "_mark_done", failing)
    with pytest.raises(StreamingQueryException):
        run()
    run()
    got = R.windows_from_blocks(*R.WORD_WINDOWS)(read_snapshot(spark, out))
    assert rows_of(got) == rows_of(R.words_by_event_time(static(spark, inbox)))
