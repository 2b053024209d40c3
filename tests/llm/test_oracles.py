"""The queries with a DuckDB counterpart, on whole tables and on a few odd rows."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from termtide.llm.oracles import ORACLE_SQL
from termtide.llm.queries import QUERIES

DOCS = [
    (3, "one two three four five six seven eight nine ten eleven " * 6, "en"),
    (5, "Zwölf ONE two three four five six seven eight nine ten é" + "ü" * 60, None),
    (9, "ü" * 60 + " a b a b a b\n\na b a b a b\nx#$", "de"),
    (11, None, "de"),
    (12, "", None),
    (20, " \n\t", "en"),
    (21, "abc" * 40 + "x" + "abc" * 40, "en"),
    (22, "one two three four five six seven eight nine ten eleven " * 6, "en"),
    (23, "just this", "fr"),
]
ITEMS = [(1, "two THREE four five six seven eight nine ten eleven one"), (10, "Just, this")]
ITEMS += [(2, "just this"), (4, ""), (5, None), (6, "A b a")]
PAGES = [(4, "u", "same"), (2, None, "same"), (7, "v", None), (9, "w", ""), (3, "u", "é")]
TURNS = [(1, 1, "user", "a b"), (1, 2, "assistant", "c d"), (1, 3, None, None)]
TURNS += [(2, 4, "assistant", "one two"), (2, 4, "assistant", "é z"), (2, 1, "user", "")]
VECTORS = [(i % 30, [(i * j % 17 - 8) / 20 for j in range(64)], i) for i in range(40)]
VECTORS += [(50, None, 0), (51, [], 0), (52, [None] * 64, 0), (None, [0.5] * 64, 0)]
VECTORS += [(53, [float("nan")] + [0.0] * 63, 0), (54, [-0.0] * 64, 0), (55, [float("inf")] * 64, 0)]
LABELS = [(3, 1, 0), (5, 0, 0), (9, 1, 1), (99, 1, 0), (12, None, None)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    # Enough good documents of one kind that cutoffs hold, and some that they reject.
    plain = [(100 + i, f"word{i} " + " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(3000)]
    wild = [(9000 + i, "#$%& " * 30 + " ".join(f"v{i}x{j}" for j in range(60)), "en") for i in range(5)]
    labels = LABELS + [(i, 1, 0) for i, _, _ in plain]
    tables = {
        "documents": (DOCS + plain + wild, "doc_id bigint, text string, lang string"),
        "benchmark": (ITEMS, "item_id bigint, text string"),
        "pages": (PAGES, "page_id bigint, url string, html string"),
        "conversations": (TURNS, "conv_id bigint, turn bigint, role string, text string"),
        "labels": (labels, "doc_id bigint, quality int, toxic int"),
        "embeddings": (VECTORS, "vec_id bigint, embedding array<float>, label int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def views(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def same_rows(spark, folder, name):
    got = QUERIES[name](spark, folder)
    want = views(folder).execute(ORACLE_SQL[name])
    names = [column[0] for column in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = Counter(map(tuple, got.select(*names).collect()))
    expected = Counter(want.fetchall())
    assert rows - expected == expected - rows == Counter()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_whole_tables(spark, small, name):
    same_rows(spark, small, name)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_odd_rows(spark, odd, name):
    same_rows(spark, odd, name)


def test_quality_rejects_on_plain_tables(spark):
    """Labels of the test table suffice for one language at least."""
    folder = "/root/testdata/sf0.01"
    same_rows(spark, folder, "op8_quality_rules")
    found = QUERIES["op8_quality_rules"](spark, folder).filter("NOT base_failed AND NOT kept")
    assert found.count() > 0


def test_cutoffs_reject_in_sql_too(odd):
    found = views(odd).execute(ORACLE_SQL["op8_quality_rules"]).fetchall()
    by = {row[0]: row[8] for row in found}
    # The signs are also 30 equal words one after another.
    assert by[9000] == "symbols_per_char,repeat_word_share" and by[100] == ""
