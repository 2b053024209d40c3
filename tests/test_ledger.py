"""Results kept batch by batch: equality with batch, failures, late rows, bounded folders."""

import datetime
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from termtide.operators.messages import checked_messages, fitting, unfit
from termtide.operators.rates import live_rates
from termtide.operators.windows import windowed_count
from termtide.plans import live
from termtide.sinks import streams as S
from termtide.sinks.ledger import Kept, Ledger
from termtide.sources.streams import message_files
from termtide.streaming import reviews as R
from test_streams import late_stream, put, rows_of, static


def one_word_messages(folder, count, word=lambda n: f"w{n % 3}", apart=30):
    """A file for each message, `apart` seconds of event time from the one before."""
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    for n in range(count):
        when = start + datetime.timedelta(seconds=apart * n)
        row = {"review": word(n), "sentiment": "s", "created_at": when.isoformat()}
        put(folder, f"{n}.json", [row], 1_700_000_000 + n)


@pytest.fixture
def mixed(tmp_path):
    """Three files of messages, some of which do not fit."""
    folder = str(tmp_path / "mixed")
    row = {"review": "The cat the dog", "sentiment": "Pos", "created_at": "2024-01-01T00:00:05Z"}
    put(folder, "1.json", [row, row, "garbage", "", "[1]"], 1_700_000_000)
    put(folder, "2.json", [row | {"sentiment": "neg"}, "garbage", '{"review": "cut'], 1_700_000_001)
    put(folder, "3.json", [row | {"created_at": "2024-01-01T09:00:00Z"}, "null", "{}"], 1_700_000_002)
    return folder


def test_messages_that_do_not_fit(spark, mixed):
    checked = checked_messages(static(spark, mixed))
    bad = {r.unparsed: r["count"] for r in unfit(checked).collect()}
    assert bad == {"garbage": 2, "": 1, "[1]": 1, '{"review": "cut': 1, "null": 1}
    good = fitting(checked)
    assert good.columns == ["review", "sentiment", "created_at"] and good.count() == 5
    assert good.count() + sum(bad.values()) == checked.count()
    other = spark.createDataFrame([('{"review": 1, "sentiment": {"a": 2}}',), (None,)], "value string")
    assert {r.unparsed for r in checked_messages(other).collect()} == {None, ""}


def analysis(spark, folder, tmp_path, **kw):
    stream = message_files(spark, folder, max_files_per_trigger=1)
    out = str(tmp_path / "tables")
    query = live.words_and_labels(stream, out, str(tmp_path / "c"), bounded=True, **kw)
    query.awaitTermination()
    return query, live.analysis_ledger(spark, out)


def test_one_stream_several_tables(spark, mixed, tmp_path, capsys):
    query, ledger = analysis(spark, mixed, tmp_path)
    raw = static(spark, mixed)
    assert rows_of(ledger.read("words")) == rows_of(R.words_by_event_time(raw))
    assert rows_of(ledger.read("labels")) == rows_of(R.running_labels(raw))
    assert rows_of(ledger.read("unfit")) == rows_of(unfit(checked_messages(raw)))
    # Every batch read its file once: the rows that came in are the messages there are.
    read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert read == [5, 3, 3]
    assert "Messages so far: 11" in capsys.readouterr().out


def test_rates_add_up(spark, mixed, tmp_path):
    _, ledger = analysis(spark, mixed, tmp_path, quiet=True)
    rates = {r.number: r for r in live_rates(ledger.read(S.RATES)).collect()}
    assert {n: r.rows for n, r in rates.items()} == {0: 5, 1: 3, 2: 3}
    assert sum(r.rows for r in rates.values()) == ledger.marks()[-1].total == 11
    assert all(abs(r.rows_per_second * r.seconds - r.rows) < 1e-6 for r in rates.values())


def test_failure_between_two_tables(spark, mixed, tmp_path, monkeypatch):
    """A batch that fails after its first table shows nothing, and counts once when repeated."""
    put_rows, calls = Ledger._put, []

    def failing(self, rows, name, batch):
        calls.append((name, batch))
        if batch == 1 and name == "labels" and calls.count((name, batch)) == 1:
            raise RuntimeError("lost")
        put_rows(self, rows, name, batch)

    monkeypatch.setattr(Ledger, "_put", failing)
    with pytest.raises(StreamingQueryException):
        analysis(spark, mixed, tmp_path, quiet=True)
    ledger = live.analysis_ledger(spark, str(tmp_path / "tables"))
    assert [m.batch for m in ledger.marks()] == [0] and ("words", 1) in calls
    first = static(spark, mixed + "/1.json")
    assert rows_of(ledger.read("words")) == rows_of(R.words_by_event_time(first))
    _, ledger = analysis(spark, mixed, tmp_path, quiet=True)
    raw = static(spark, mixed)
    assert rows_of(ledger.read("words")) == rows_of(R.words_by_event_time(raw))
    assert rows_of(ledger.read("labels")) == rows_of(R.running_labels(raw))


def test_a_marked_batch_is_not_written_again(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"), {"c": Kept(("k",))}, every=1)
    for _ in range(2):
        ledger.write(0, {"c": spark.createDataFrame([("a", 2)], "k string, count bigint")}, 2)
    ledger.write(1, {"c": spark.createDataFrame([("a", 1), ("b", 1)], "k string, count bigint")}, 2)
    assert {r.k: r["count"] for r in ledger.read("c").collect()} == {"a": 3, "b": 1}
    assert ledger.marks()[-1].total == 4
    with pytest.raises(ValueError):
        Ledger(spark, str(tmp_path / "none"), {"c": Kept(("k",))}).read("c")


def folders(path):
    return sum(len(names) for _, names, _ in os.walk(path))


def test_folders_stay_few(spark, tmp_path):
    """Over 60 batches of running counts the folders stay those of the first few."""
    ledger = Ledger(spark, str(tmp_path / "t"), {"c": Kept(("k",), "last")}, every=3)
    seen, want = [], {}
    for batch in range(60):
        want |= {f"k{batch % 7}": batch, "all": batch}
        rows = [(f"k{batch % 7}", batch), ("all", batch)]
        ledger.write(batch, {"c": spark.createDataFrame(rows, "k string, count bigint").coalesce(1)})
        seen.append(folders(str(tmp_path / "t")))
    assert {r.k: r["count"] for r in ledger.read("c").collect()} == want
    assert max(seen) == seen[12] and len(ledger.marks()) <= ledger.places


def test_windows_end(spark, tmp_path):
    """State rows fall as windows close, and rows equal those of all messages at once."""
    folder = str(tmp_path / "inbox")
    one_word_messages(folder, 12, apart=40)
    stream = message_files(spark, folder, max_files_per_trigger=1)
    out = str(tmp_path / "windows")
    result = R.words_by_event_time(stream)
    query = S.to_windows(
        result, out, str(tmp_path / "c"), ["word"], R.DELAY, bounded=True, merge_every=2
    )
    query.awaitTermination()
    ledger = S.window_ledger(spark, out, ["word"], R.DELAY, 2)
    assert rows_of(ledger.read(S.WINDOWS)) == rows_of(R.words_by_event_time(static(spark, folder)))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    removed = [p["stateOperators"][0]["numRowsRemoved"] for p in query.recentProgress]
    assert sum(removed) > 0
    # Closed windows are in one place only and not in the base.
    mark = ledger.marks()[-1]
    base = spark.read.parquet(ledger._base(S.WINDOWS, mark.merges))
    closed = spark.read.parquet(f"{out}/{S.WINDOWS}/closed").where(F.col("upto") <= mark.upto)
    assert 0 < base.count() < 12 and closed.count() > 12
    assert closed.groupBy("window", "word").count().where("count > 1").count() == 0
    assert base.join(closed, ["window", "word"]).count() == 0
    assert len(kept) >= 12


def test_days_are_pruned(spark, tmp_path):
    folder = str(tmp_path / "inbox")
    one_word_messages(folder, 6, apart=24 * 3_600)
    _, ledger = analysis(spark, folder, tmp_path, quiet=True)
    ledger = Ledger(spark, ledger.path, ledger.tables, every=8)
    whole = R.words_by_event_time(static(spark, folder))
    day = datetime.date(2024, 1, 3)
    want = whole.where(F.to_date("window.start") == F.lit(day))
    assert rows_of(ledger.read("words", day, day)) == rows_of(want)


def test_closed_days_reach_the_scan(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"), {"w": Kept(("window", "k"), delay="1 minute")}, 1)
    for batch in range(4):
        rows = spark.createDataFrame([("a", f"2024-01-0{batch + 1} 10:00:00")], "k string, t string")
        counts = windowed_count(rows.withColumn("t", F.col("t").cast("timestamp")), "t", ["k"], "1 hour")
        ledger.write(batch, {"w": counts})
    day = datetime.date(2024, 1, 2)
    got = ledger.read("w", day, day)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "day#" in plan
    assert [r["count"] for r in got.collect()] == [1]
    assert ledger.read("w").count() == 4


def test_late_rows_are_kept_aside(spark, tmp_path):
    """What Spark's watermark drops goes to the other table."""
    kept = {"words": Kept(("window", "word"), delay=R.DELAY, aside=True)}
    ledger = Ledger(spark, str(tmp_path / "t"), kept, every=2)
    timed = R.timed_messages(late_stream(spark, tmp_path))
    S.to_tables(
        timed, ledger, {"words": R.words_in_windows}, str(tmp_path / "c"), "event_time", bounded=True
    ).awaitTermination()
    on_time = Counter(r.word for r in ledger.read("words").collect())
    late = Counter(r.word for r in ledger.read("words_late").collect())
    assert on_time == {"hello": 3, "world": 3, "late1": 3, "x": 3} and late == {"late2": 3}
    result = R.words_by_event_time(late_stream(spark, tmp_path))
    query = S.to_windows(result, str(tmp_path / "o"), str(tmp_path / "c2"), ["word"], R.DELAY, bounded=True)
    query.awaitTermination()
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
    assert dropped == sum(late.values())
    same = S.window_ledger(spark, str(tmp_path / "o"), ["word"], R.DELAY).read(S.WINDOWS)
    assert rows_of(same) == rows_of(ledger.read("words"))


def test_broker_words(spark, mixed, tmp_path, capsys):
    stream = message_files(spark, mixed)
    out = str(tmp_path / "t")
    live.broker_words(stream, out, str(tmp_path / "c"), bounded=True).awaitTermination()
    got = S.window_ledger(spark, out, ["word"], R.DELAY).read(S.WINDOWS)
    assert rows_of(got) == rows_of(R.words_by_broker_time(static(spark, mixed)))
    assert "|cat" in capsys.readouterr().out


@pytest.mark.parametrize("mode", ["append", "update"])
def test_console_limits_rows(spark, mixed, tmp_path, mode, capfd):
    stream = message_files(spark, mixed)
    result = R.running_words(stream) if mode != "append" else checked_messages(stream).select("unparsed")
    S.to_console(result, str(tmp_path / "c"), rows=1, mode=mode, bounded=True).awaitTermination()
    shown = [line for line in capfd.readouterr().out.splitlines() if line.startswith("|")]
    assert len(shown) == 2


def test_windows_end_in_blocks(spark, tmp_path):
    """Blocks close and give the windows of all messages, with fewer rows of state than windows."""
    folder = str(tmp_path / "inbox")
    one_word_messages(folder, 12, apart=90)
    stream = message_files(spark, folder, max_files_per_trigger=3)
    out, blocks = str(tmp_path / "windows"), R.WORD_WINDOWS
    query = S.to_windows(
        R.word_blocks_by_event_time(stream), out, str(tmp_path / "c"), ["word"], R.DELAY,
        bounded=True, merge_every=2, blocks=blocks,
    )
    query.awaitTermination()
    ledger = S.window_ledger(spark, out, ["word"], R.DELAY, 2, blocks)
    whole = R.words_by_event_time(static(spark, folder))
    assert rows_of(ledger.read(S.WINDOWS)) == rows_of(whole)
    state = [p["stateOperators"][0] for p in query.recentProgress]
    assert sum(s["numRowsRemoved"] for s in state) > 0
    assert sum(s["numRowsUpdated"] for s in state) * 2 < whole.count()
    with pytest.raises(ValueError):
        Kept(("window", "word"), delay=R.DELAY, aside=True, blocks=blocks)


def test_blocks_equal_windows(spark, mixed, tmp_path):
    words = R.words_at_event_time(message_files(spark, mixed, max_files_per_trigger=1))
    got = str(tmp_path / "out")
    S.to_snapshots(
        R.blocks(words, *R.WORD_WINDOWS), got, str(tmp_path / "offsets"), bounded=True,
        finish=R.windows_from_blocks(*R.WORD_WINDOWS),
    ).awaitTermination()
    assert rows_of(S.read_snapshot(spark, got)) == rows_of(R.words_by_event_time(static(spark, mixed)))


def counted_windows(stream, out, checkpoint, by_state=False, **kw):
    if by_state:
        rows, tokens = R.word_blocks_by_event_time(stream), None
    else:
        rows, tokens = R.messages_at_event_time(stream), R.event_tokens
    S.to_windows(
        rows, out, checkpoint, ["word"], R.DELAY, bounded=True, merge_every=2, blocks=R.WORD_WINDOWS,
        tokens=tokens, **kw,
    ).awaitTermination()
    return S.window_ledger(stream.sparkSession, out, ["word"], R.DELAY, 2, R.WORD_WINDOWS, not by_state)


@pytest.mark.parametrize("most_shared, block_bytes", [(1_000, 32 << 20), (0, 32 << 20), (1_000, 10)])
def test_counted_windows_need_no_state(spark, tmp_path, monkeypatch, most_shared, block_bytes):
    """Batches in the order of time give the windows of all messages, each row written once (F2)."""
    monkeypatch.setattr("termtide.sinks.ledger.MOST_SHARED", most_shared)
    monkeypatch.setattr(S, "BLOCK_MOST_BYTES", block_bytes)
    folder, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    one_word_messages(folder, 36, apart=60)
    stream = message_files(spark, folder, max_files_per_trigger=10)
    ledger = counted_windows(stream, out, str(tmp_path / "c"))
    whole = R.words_by_event_time(static(spark, folder))
    assert rows_of(ledger.read(S.WINDOWS)) == rows_of(whole)
    assert not os.path.exists(tmp_path / "c" / "state")
    closed = spark.read.parquet(f"{out}/{S.WINDOWS}/closed")
    assert {r.origin for r in closed.select("origin").distinct().collect()} == {"own", "merged"}
    assert closed.groupBy("window", "word").count().where("count > 1").count() == 0
    mark = ledger.marks()[-1]
    base = spark.read.parquet(ledger._base(S.WINDOWS, mark.merges))
    assert mark.upto == mark.batch == 3 and 0 < base.count() < closed.count()
    assert base.join(closed, ["window", "word"]).count() == 0
    day = datetime.date(2024, 1, 1)
    assert rows_of(ledger.read(S.WINDOWS, day, day)) == rows_of(whole.where(F.to_date("window.start") == F.lit(day)))
    assert ledger.read(S.WINDOWS, datetime.date(2024, 1, 2)).count() == 0


def test_counted_windows_drop_what_the_watermark_drops(spark, tmp_path):
    """Late rows for closed blocks are dropped, those for open ones counted, as with Spark's state (F2)."""
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    batches = [
        [("a", 0), ("a", 30), (None, 30), ("b", None)],
        [("a", 200), ("b", 290), ("c", 600)],
        [("late", 10), ("b", 560), ("c", 400), ("d", 900)],
        [],
        [("late", 500), ("d", 850), ("d", 5_000), ("e", 3_000), ("e", 3_001)],
        [("late", 4_600), ("e", 4_990)],
    ]
    read = []
    for by_state in (False, True):
        folder = str(tmp_path / f"inbox-{by_state}")
        for n, batch in enumerate(batches):
            rows = [
                {"review": w, "sentiment": "s"} | ({} if t is None else {"created_at": (start + datetime.timedelta(seconds=t)).isoformat()})
                for w, t in batch
            ]
            put(folder, f"{n}.json", rows, 1_700_000_000 + n)
            ledger = counted_windows(
                message_files(spark, folder), f"{tmp_path}/out-{by_state}", f"{tmp_path}/c-{by_state}", by_state
            )
            if batch:
                read.append((by_state, rows_of(ledger.read(S.WINDOWS))))
    counted, by_state = ([rows for state, rows in read if state == s] for s in (False, True))
    assert counted == by_state and "late" not in str(counted) and len(counted) == 5


def test_a_counted_batch_that_failed_counts_once(spark, tmp_path, monkeypatch):
    """A batch lost before its mark shows none of its closed blocks, and counts once when repeated (F2)."""
    folder, out, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "out"), str(tmp_path / "c")
    one_word_messages(folder, 12, apart=120)
    stream = message_files(spark, folder, max_files_per_trigger=6)
    merge, calls = Ledger._merge, []

    def failing(self, *args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return merge(self, *args)

    monkeypatch.setattr(Ledger, "_merge", failing)
    with pytest.raises(StreamingQueryException):
        counted_windows(stream, out, checkpoint)
    ledger = S.window_ledger(spark, out, ["word"], R.DELAY, 2, R.WORD_WINDOWS, True)
    first = static(spark, [f"{folder}/{n}.json" for n in range(6)])
    assert [m.batch for m in ledger.marks()] == [0]
    assert rows_of(ledger.read(S.WINDOWS)) == rows_of(R.words_by_event_time(first))
    ledger = counted_windows(stream, out, checkpoint)
    assert rows_of(ledger.read(S.WINDOWS)) == rows_of(R.words_by_event_time(static(spark, folder)))
    with pytest.raises(ValueError):
        Kept(("window", "word"), "last", R.DELAY, blocks=R.WORD_WINDOWS, final=True)
