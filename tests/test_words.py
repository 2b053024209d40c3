"""The five word rules against plain Python."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from termtide.functions.words import RULES
from termtide.operators.counts import word_count
from termtide.operators.tokens import tokenize

ASCII = re.ASCII
PYTHON = {
    "ws_alpha": lambda t: [w.lower() for w in t.split() if w.isalpha()],
    "ascii_runs": lambda t: re.findall(r"\b[a-z]+\b", t.lower()),
    "nonword": lambda t: [w for w in re.split(r"\W+", t.lower(), flags=ASCII) if w],
    "nonword_cased": lambda t: [w for w in re.split(r"\W+", t, flags=ASCII) if w],
    "ws_raw": lambda t: re.split(r"[ \t\n\x0b\f\r]+", t.lower()),
}
EDGE = {
    "Don't stop naïve abc1 a_b": {
        "ws_alpha": ["stop", "naïve"],
        "ascii_runs": ["don", "t", "stop"],
        "nonword": ["don", "t", "stop", "na", "ve", "abc1", "a_b"],
        "nonword_cased": ["Don", "t", "stop", "na", "ve", "abc1", "a_b"],
        "ws_raw": ["don't", "stop", "naïve", "abc1", "a_b"],
    },
    "  lead": {
        "ws_alpha": ["lead"],
        "ascii_runs": ["lead"],
        "nonword": ["lead"],
        "nonword_cased": ["lead"],
        "ws_raw": ["", "lead"],
    },
    "A B\x1cC": {
        "ws_alpha": ["a", "b", "c"],
        "ascii_runs": ["a", "b", "c"],
        "nonword": ["a", "b", "c"],
        "nonword_cased": ["A", "B", "C"],
        "ws_raw": ["a b\x1cc"],
    },
    "": {"ws_alpha": [], "ascii_runs": [], "nonword": [], "nonword_cased": [], "ws_raw": [""]},
    None: {name: [] for name in RULES},
}
TRICKY = [
    "trailing blank ", " ", "\t\n", "good, bad", "É École İstanbul ΣΑΣ", "x²y ½a a½ b١ c",
    "日本 語 word漢 漢word", "áb é", "tab\x0bvt\x0cff\x85nel em　cjk",
    "a-b_c.d'e 1a a1 _a a_ A_B", "K K k", "line\r\nbreak\rmore sep", "ﬁ ŉ ǅ ß ẞ",
]


def spark_tokens(spark, texts, rule):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, review string")
    found = {n: [] for n in range(len(texts))}
    for row in tokenize(rows, "review", rule, keep=["n"]).collect():
        found[row.n].append(row.word)
    return [found[n] for n in range(len(texts))]


@pytest.mark.parametrize("rule", RULES)
def test_edge_rows(spark, rule):
    assert spark_tokens(spark, list(EDGE), rule) == [EDGE[t][rule] for t in EDGE]


@pytest.mark.parametrize("rule", RULES)
def test_tricky_texts(spark, rule):
    assert spark_tokens(spark, TRICKY, rule) == [PYTHON[rule](t) for t in TRICKY]


@pytest.mark.parametrize("rule", RULES)
def test_documents(spark, small, rule):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    expected = Counter()
    for row in docs.select("text").collect():
        expected.update(PYTHON[rule](row.text))
    counts = word_count(tokenize(docs, "text", rule)).collect()
    assert {r["word"]: r["count"] for r in counts} == dict(expected)


# Scripts settled long ago, so that Java's and Python's Unicode data agree.
TEXT = st.text(
    st.one_of(
        st.characters(max_codepoint=0x17F, blacklist_characters="\x00"),
        st.sampled_from(" \t\n  　\x1c,.'_-09αβЖя漢字"),
    ),
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=20, max_size=60))
def test_random_texts(spark, texts):
    for rule in RULES:
        assert spark_tokens(spark, texts, rule) == [PYTHON[rule](t) for t in texts]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        tokenize(spark.range(1).selectExpr("'a' AS review"), rule="nope")


def test_word_cannot_be_kept(spark):
    with pytest.raises(ValueError):
        tokenize(spark.range(1).selectExpr("'a' AS word"), "word", keep=["word"])
