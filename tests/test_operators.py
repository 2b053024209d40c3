"""Counts, ranking, stop words, messages, text and number expressions."""

import json
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from termtide.functions import text as X
from termtide.functions.numbers import round_binary
from termtide.functions.stopwords import ENGLISH, STOP7, STOP11
from termtide.operators import ranking
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
from termtide.operators.messages import build_messages, parse_messages, required, with_event_time
from termtide.operators.ranking import by_count, first_records, nth_key, top_k
from termtide.operators.tokens import drop_stop_table, drop_stop_words, tokenize
from termtide.operators.trends import recent_top_words, series_keys, wide_trend, word_trend
from termtide.operators.windows import (
    block_count,
    flat_window,
    seconds,
    slide_panes,
    windowed_count,
)
from termtide.session import spread_in_time


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r["count"] for r in df.collect()}


def words(spark, listed):
    return spark.createDataFrame([(w,) for w in listed], "word string")


def test_word_count_and_order_independence(spark):
    listed = [random.Random(3).choice("abcde") for _ in range(200)]
    expected = {(w,): n for w, n in Counter(listed).items()}
    assert as_dict(word_count(words(spark, listed)), "word") == expected
    assert as_dict(word_count(words(spark, sorted(listed))), "word") == expected


def test_hot_word_counts(spark):
    """Half of all rows are one word; partial counts reach the exchange as one row per task."""
    rows = spark.range(100_000).selectExpr("IF(id % 2 = 0, 'hot', concat('w', id)) AS word")
    counts = word_count(rows)
    assert counts.where("word = 'hot'").first()["count"] == 50_000
    assert counts.count() == 50_001


def test_merge_equals_whole(spark):
    left, right = list("aabbc"), list("bccd")
    merged = merge_counts(*[word_count(words(spark, part)) for part in (left, right)])
    assert as_dict(merged, "word") == as_dict(word_count(words(spark, left + right)), "word")


def test_stop_lists(spark):
    table = words(spark, ["the", "for", "ours", "cat", ""])
    assert {r.word for r in drop_stop_words(table, STOP7).collect()} == {"for", "ours", "cat", ""}
    assert {r.word for r in drop_stop_words(table, STOP11).collect()} == {"ours", "cat", ""}
    assert {r.word for r in drop_stop_words(table, ENGLISH).collect()} == {"cat", ""}
    assert drop_stop_words(table, []).count() == 5


def test_stop_table(spark):
    table = words(spark, ["the", "the", "cat", "sat"])
    stops = spark.createDataFrame([("the",), ("the",), (None,), ("sat",)], "word string")
    kept = drop_stop_table(table, stops)
    assert [r.word for r in kept.collect()] == ["cat"]
    assert "ResolvedHint" not in kept._jdf.queryExecution().analyzed().toString()


def test_nth_key_sorts_few_keys(spark, monkeypatch):
    from termtide.operators import ranking

    monkeypatch.setattr(ranking, "MOST_SORTED", 20)
    monkeypatch.setattr(ranking, "PERCENTILE_ACCURACY", 50)
    rows = [(x * x % 10_007,) for x in range(4_000)] + [(77,)] * 300
    keys = spark.createDataFrame(rows, "k bigint").repartition(4)
    ordered = sorted(k for k, in rows)
    for n in (1, 2, 50, 777, 2_000, 4_299, 4_300):
        assert ranking.nth_key(keys, "k", n) == ordered[n - 1]
    assert ranking.nth_key(keys, "k", 4_301) is None


def test_message_without_time_and_infinity(spark):
    from termtide.functions.numbers import round_binary

    rows = spark.createDataFrame(
        [("r", "pos", None), ("s", "neg", "t")], "review string, sentiment string, created_at string"
    )
    sent = [r.value for r in build_messages(rows).collect()]
    assert all('"created_at":"' in value for value in sent) and '"created_at":"t"' in sent[1]
    values = spark.createDataFrame([(float("inf"),), (float("-inf"),), (0.145,)], "v double")
    got = [r.v for r in values.select(round_binary(F.col("v"), 2).alias("v")).collect()]
    assert got == [float("inf"), float("-inf"), 0.14]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels(spark):
    rows = spark.createDataFrame([("Pos",), ("pos",), (None,), ("$neg",)], "sentiment string")
    assert as_dict(label_counts(rows), "sentiment") == {
        ("Pos",): 1, ("pos",): 1, (None,): 1, ("$neg",): 1,
    }
    counts = label_counts(rows, normalize=True)
    assert as_dict(counts, "sentiment") == {("pos",): 2, ("",): 1, ("$neg",): 1}
    shares = {r.sentiment: (r["count"], r.percent) for r in label_share(counts).collect()}
    assert shares == {"pos": (2, 50.0), "": (1, 25.0), "\\$neg": (1, 25.0)}
    assert total_count(rows).first().total == 4


def test_label_share_needs_no_window(spark):
    counts = label_counts(spark.range(10).selectExpr("cast(id % 3 AS string) AS sentiment"))
    assert "Window" not in plan(label_share(counts))


def test_top_k_ties(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), ("d", 1)], "word string, count long")
    assert [r.word for r in top_k(counts, 2).collect()] == ["c", "a"]
    assert [r.word for r in by_count(counts, ["word"]).collect()] == ["c", "a", "b", "d"]
    assert "TakeOrderedAndProject" in plan(top_k(counts, 2))


def test_first_records(spark):
    rows = spark.range(100).select((F.lit(99) - F.col("id")).alias("key"), F.lit("t").alias("text"))
    assert sorted(r.key for r in first_records(rows, 7, "key").collect()) == list(range(7))
    assert first_records(rows, 100, "key").count() == 100
    assert first_records(rows, 1_000, "key").count() == 100
    assert first_records(rows, 0, "key").count() == 0


def test_nth_key_beyond_the_sketch(spark, monkeypatch):
    """A coarse sketch, so that the bounds are truly approximate; the result is exact."""
    rng = random.Random(11)
    values = rng.sample(range(10**9), 20_000)
    rows = spark.createDataFrame([(v,) for v in values], "key long").repartition(8)
    values.sort()
    for accuracy in (10, 100):
        monkeypatch.setattr(ranking, "PERCENTILE_ACCURACY", accuracy)
        for n in (1, 2, 777, 10_000, 19_999, 20_000):
            assert nth_key(rows, "key", n) == values[n - 1]
    assert nth_key(rows, "key", 20_001) is None


def test_sort_by_count_spreads_ties(spark):
    """Equal counts must not all fall into one task."""
    rows = spark.range(40_000).selectExpr("concat('w', id) AS word", "1L AS count")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = by_count(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 30_000


def test_messages_round_trip(spark):
    rows = spark.createDataFrame(
        [("a \"b\"\n\té漢", "pos", "2024-01-01T00:00:07Z"), ("", "neg", "x"), ("r", None, "x"),
         (None, "pos", "x")],
        "review string, sentiment string, created_at string",
    )
    values = [r.value for r in build_messages(rows).collect()]
    assert [json.loads(v) for v in values] == [
        {"review": "a \"b\"\n\té漢", "sentiment": "pos", "created_at": "2024-01-01T00:00:07Z"}
    ]
    back = with_event_time(parse_messages(build_messages(rows))).first()
    assert (back.review, back.sentiment) == ("a \"b\"\n\té漢", "pos")
    assert back.event_time == spark.sql("SELECT timestamp'2024-01-01 00:00:07'").first()[0]


def test_messages_always_carry_a_time(spark):
    rows = spark.createDataFrame([("a", "pos")], "review string, sentiment string")
    parsed = with_event_time(parse_messages(build_messages(rows))).first()
    assert parsed.event_time is not None


def test_bad_messages(spark):
    raw = spark.createDataFrame(
        [(b"garbage",), (b'{"review":"a","created_at":"nope"}',), (None,)], "value binary"
    )
    parsed = with_event_time(parse_messages(raw)).collect()
    assert [(r.review, r.sentiment, r.event_time) for r in parsed] == [
        (None, None, None), ("a", None, None), (None, None, None),
    ]
    assert as_dict(label_counts(parse_messages(raw)), "sentiment") == {(None,): 3}


def test_required(spark):
    rows = spark.createDataFrame([("a", ""), ("", "b"), (None, "b"), ("a", "b")], "x string, y string")
    assert required(rows, "x", "y").count() == 1


def test_text_expressions(spark):
    long = "é" * 81
    row = spark.createDataFrame(
        [(" \x1c　a b\t ", "x,y", long, "$5 $", "s3a://b/k/f.csv", "nope")],
        "a string, b string, c string, d string, e string, f string",
    ).select(
        X.strip(F.col("a")), X.first_field(F.col("b")), X.first_field(F.col("c")),
        X.preview(F.col("c")), X.preview(F.col("b")), X.preview(F.col("b"), always_mark=True),
        X.escape_dollar(F.col("d")), X.base_name(F.col("e")), X.event_time(F.col("f")),
        X.normal_label(F.lit(None).cast("string")),
        X.run_stamp(F.lit("2024-02-03 04:05:06").cast("timestamp")),
        X.iso_time(F.lit("2024-02-03 04:05:06").cast("timestamp")),
    ).first()
    assert list(row) == [
        "a b", "x", long, "é" * 80 + "...", "x,y", "x,y...", "\\$5 \\$", "f.csv", None, "",
        "20240203_040506", "2024-02-03T04:05:06.000Z",
    ]


def test_strip_matches_python(spark):
    texts = [c + "a" + c for c in map(chr, range(1, 0x3100)) if c.isprintable() or c.isspace()]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", X.strip(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [r.t.strip() for r in got]


def test_round_binary_matches_python(spark):
    rng = random.Random(5)
    values = [rng.randrange(10**6) / 1000 for _ in range(2_000)]
    values += [k / 8 for k in range(200)] + [rng.random() / 1000 for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", *[round_binary(F.col("v"), p).alias(f"p{p}") for p in (0, 1, 2, 4, 8)])
    for row in got.collect():
        assert [row[f"p{p}"] for p in (0, 1, 2, 4, 8)] == [round(row.v, p) for p in (0, 1, 2, 4, 8)]


def test_bench_tables(spark):
    log = spark.createDataFrame(
        [(1000, 1, 0.145), (1000, 4, 0.12), (5000, 1, 1.5), (10, 2, 0.0), (0, 2, 1.0)],
        "size bigint, workers int, time_s double",
    )
    fine = {(r["size"], r.workers): tuple(r)[2:] for r in bench_metrics(log).collect()}
    assert fine[1000, 4] == (0.12, round(1000 / 0.12, 2), round(0.12 / 1000, 8))
    assert fine[10, 2] == (0.0, None, 0.0) and fine[0, 2] == (1.0, 0.0, None)
    coarse = bench_metrics(log, COARSE_PLACES)
    assert coarse.where("size = 1000 AND workers = 1").first().time_s == round(0.145, 2)
    wide = {r["size"]: (r.w1, r.w2, r.w4) for r in bench_series(coarse, "time_s").collect()}
    assert wide[1000] == (0.14, None, 0.12) and wide[5000] == (1.5, None, None)
    assert bench_series(coarse, "time_s", [4]).columns == ["size", "w4"]
    assert [r.workers for r in distinct_keys(log, "workers").collect()] == [1, 2, 4]
    assert one_series(log, 1).count() == 2
    assert series_keys(log, "workers") == [1, 2, 4]
    moment = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert tuple(run_summary(log, 8, moment).first()) == ("20240102_030405", 5, 8)


# ---------------------------------------------------------------- windows and trends


def timed(spark, rows):
    return spark.createDataFrame(rows, "word string, s long").select(
        "word", F.timestamp_seconds("s").alias("event_time")
    )


def brute(rows, size, slide):
    found = Counter()
    for word, s in rows:
        if s is None:
            continue
        start = s // slide * slide
        while start > s - size:
            found[start, word] += 1
            start -= slide
    return dict(found)


def window_dict(df):
    flat = flat_window(df).select(F.unix_timestamp("window_start").alias("s"), "word", "count")
    return {(r.s, r.word): r["count"] for r in flat.collect()}


@pytest.mark.parametrize("size,slide", [(60, 20), (30, 10), (60, 30), (30, 30)])
def test_windows(spark, size, slide):
    rng = random.Random(size + slide)
    rows = [(rng.choice("abc"), 1_700_000_000 + rng.randrange(400)) for _ in range(150)]
    rows += [("late", None), ("edge", 1_700_000_040)]
    data = timed(spark, rows)
    step = None if size == slide else f"{slide} seconds"
    direct = windowed_count(data, "event_time", ["word"], f"{size} seconds", step)
    assert window_dict(direct) == brute(rows, size, slide)
    panes = windowed_count(data, "event_time", ["word"], f"{slide} seconds")
    slid = slide_panes(panes, ["word"], f"{size} seconds", f"{slide} seconds")
    assert window_dict(slid) == brute(rows, size, slide)
    assert slid.schema["window"].dataType.fieldNames() == ["start", "end"]
    total = sum(r["count"] for r in slid.collect())
    assert total == (len(rows) - 1) * size // slide


def test_durations():
    assert [seconds(d) for d in ("60 seconds", "1 minute", "2 hours", "1 day")] == [
        60, 60, 7200, 86400,
    ]
    with pytest.raises(ValueError):
        seconds("soon")


@pytest.mark.parametrize("size,slide", [(60, 20), (30, 10), (60, 30), (100, 20), (60, 25)])
def test_windows_in_blocks(spark, size, slide):
    """Sliding windows of a table equal Spark's own, and fewer rows than windows are shuffled."""
    rng = random.Random(size)
    rows = [
        (rng.choice([None, "a", "b"]), None if rng.random() < 0.05 else rng.randrange(-3 * 10**9, 3 * 10**9))
        for _ in range(2_000)
    ]
    data = spark.createDataFrame(rows, "word string, us bigint")
    data = data.select("word", F.timestamp_micros("us").alias("event_time"))
    lengths = f"{size} seconds", f"{slide} seconds"
    want = data.groupBy(F.window("event_time", *lengths).alias("window"), "word").count()
    got = windowed_count(data, "event_time", ["word"], *lengths)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    in_blocks = "pane_0" in got._jdf.queryExecution().executedPlan().toString()
    assert in_blocks == (size % slide == 0)
    if in_blocks:
        assert block_count(data, "event_time", ["word"], *lengths).count() * 5 < want.count()


def test_spread_in_time(spark):
    """Tasks hold spans of time, and equal times are dealt over several."""
    rows = spark.range(4_000).select(F.when(F.col("id") % 10 > 0, F.pmod("id", F.lit(7))).alias("n"))
    times = rows.select(F.timestamp_seconds(F.when(F.col("n") > 3, F.lit(3)).otherwise(F.col("n"))).alias("t"))
    parts = [[r.t for r in p] for p in spread_in_time(times, "t").rdd.glom().collect()]
    spans = [(min(p), max(p)) for p in parts if p]
    assert sum(map(len, parts)) == 3_600
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(map(len, parts)) < 2_000 < sum(r.t is not None and r.t.second == 3 for r in times.collect())


def test_uneven_slide_is_refused(spark):
    panes = windowed_count(timed(spark, [("a", 1)]), "event_time", ["word"], "40 seconds")
    with pytest.raises(ValueError):
        slide_panes(panes, ["word"], "60 seconds", "40 seconds")


def test_trends(spark):
    rows = [("the.end", 0), ("the.end", 5), ("a`b", 0), ("a`b", 65), ("z", 70), ("y", 1)]
    windows = windowed_count(timed(spark, rows), "event_time", ["word"], "60 seconds")
    top = recent_top_words(windows, 2)
    assert [(r.word, r["count"]) for r in top.collect()] == [("a`b", 2), ("the.end", 2)]
    trend = word_trend(windows, top)
    first, second = datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 1)
    plain = trend.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert as_dict(plain, "window_start", "word") == {
        (first, "the.end"): 2, (first, "a`b"): 1, (second, "a`b"): 1,
    }
    wide = wide_trend(trend, ["a`b", "the.end"]).orderBy("window_start").collect()
    assert [tuple(r)[1:] for r in wide] == [(1, 2), (1, 0)]


# ---------------------------------------------------------------- plans


def test_word_count_plan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = plan(drop_stop_words(word_count(tokenize(docs, "text", "nonword")), STOP11))
    assert "partial_count" in text and "Python" not in text
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<text:string>" in text


def test_required_filter_reaches_the_scan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert "PushedFilters: [IsNotNull(lang)" in plan(required(docs, "lang").select("doc_id"))
