"""Every registered query against its DuckDB counterpart."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

LLM = set(entry.llm_queries()[0])
QUERIES = {name: query for name, query in entry.queries().items() if name not in LLM}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name not in LLM}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def bag(rows, names):
    order = sorted(names)
    return Counter(tuple(row[names.index(n)] for n in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, small, name):
    got = QUERIES[name](spark, small)
    want = duck.execute(ORACLES[name])
    names = [column[0] for column in want.description]
    assert sorted(names) == sorted(got.columns)
    assert bag([tuple(r) for r in got.collect()], got.columns) == bag(want.fetchall(), names)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["word", "count"] and result.count() == 10


def test_saved_words_keep_no_state(spark, tmp_path, monkeypatch):
    """Windows that end come out whole, and no state store holds the vocabulary (F2)."""
    made = []
    monkeypatch.setattr(entry, "scratch_dir", lambda _, label: made.append(f"{tmp_path}/{label}") or made[-1])
    texts = [(0, "cat dog cat"), (2, "dog"), (8, "cow the"), (9, None), (13, "open"), (17, "d"), (None, "none")]
    rows = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in texts], entry.SCHEMAS["documents"])
    os.makedirs(f"{tmp_path}/in")
    rows.write.parquet(f"{tmp_path}/in/documents.parquet")
    got = entry.stream_words_saved(spark, f"{tmp_path}/in").collect()
    # Texts come 7 s apart, so the last at 119 s and the watermark at 59 s: the window that starts
    # at -30 s has ended, that at 0 s has not.
    found = {(r.window_start.isoformat(), r.word): r["count"] for r in got}
    assert found == {("2023-12-31T23:59:30", "cat"): 2, ("2023-12-31T23:59:30", "dog"): 2}
    assert made and not [path for path in made if os.path.exists(f"{path}/state")]


@pytest.mark.parametrize(
    "name, same_as",
    [
        ("stream_windows_ending", "win_words_60_20"),
        ("stream_words_event_time", "win_words_60_20"),
        ("stream_words_broker_time", "win_words_30_10"),
    ],
)
def test_word_windows_keep_no_state(spark, tmp_path, monkeypatch, name, same_as):
    """All windows of a stream come out, and no state store holds the vocabulary (F2, F3, F4)."""
    made = []
    monkeypatch.setattr(entry, "scratch_dir", lambda _, label: made.append(f"{tmp_path}/{label}") or made[-1])
    texts = [(n, f"cat dog w{n % 3}" if n % 9 else None, "en", "s", 0) for n in range(200)]
    rows = spark.createDataFrame([*texts, (77, "twice", "en", "s", 0)], entry.SCHEMAS["documents"])
    os.makedirs(f"{tmp_path}/in")
    rows.write.parquet(f"{tmp_path}/in/documents.parquet")
    got = entry.queries()[name](spark, f"{tmp_path}/in")
    want = entry.queries()[same_as](spark, f"{tmp_path}/in")
    assert bag([tuple(r) for r in got.collect()], got.columns) == bag([tuple(r) for r in want.collect()], want.columns)
    assert made and not [path for path in made if os.path.exists(f"{path}/state")]


def test_message_parts_are_batches_of_several_files(spark, small, tmp_path, monkeypatch):
    """No task writes or reads a whole part, and each part is one batch of the stream."""
    monkeypatch.setattr(entry, "scratch_dir", lambda _, label: str(tmp_path / label))
    ledger = entry.analysis(spark, small)
    assert [m.batch for m in ledger.marks()] == [0, 1, 2, 3]
    parts = sorted(glob.glob(f"{tmp_path}/analysis-messages/part=*"))
    assert len(parts) == 4 and all(len(glob.glob(f"{p}/*.txt")) > 1 for p in parts)
