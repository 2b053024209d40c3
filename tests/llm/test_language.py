"""The query of op10 against a plain version that shares no code with it."""

import math
import unicodedata
import zlib
from collections import Counter

import pytest

from termtide.llm.queries import op10_language


def plain_words(text):
    words, word = [], ""
    for sign in (text or "").lower() + " ":
        kind = unicodedata.category(sign)[0]
        if kind == "L" or kind == "M" and word:
            word += sign
        elif word:
            words.append(word)
            word = ""
    return words


def plain_parts(word, size):
    if size == 1:
        return list(word)
    ends = "<" + word + ">"
    return [ends[at : at + size] for at in range(len(ends)) if at + size <= len(ends)]


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def plain_languages(rows, sizes=(4, 3, 2, 1)):
    """`{(doc_id, text): (lang, score)}` from all rows that may be learned from."""
    seen, known = Counter(), {size: {} for size in (0, *sizes)}
    for doc_id, text, lang in rows:
        if is_held_out(doc_id) or text is None or lang is None:
            continue
        for word in plain_words(text):
            seen[lang] += 1
            known[0].setdefault(word, Counter())[lang] += 1
            for size in sizes:
                for part in plain_parts(word, size):
                    known[size].setdefault(part, Counter())[lang] += 1
    for size, counts in known.items():
        known[size] = {unit: by for unit, by in counts.items() if by.total() > 1}

    def log_frequency(size, unit, lang):
        return math.log((known[size][unit][lang] + 0.5) / (seen[lang] + 0.5 * len(known[size])))

    def score_of(word, lang):
        if word in known[0]:
            return log_frequency(0, word, lang)
        for step, size in enumerate(sizes, 1):
            parts = [part for part in plain_parts(word, size) if part in known[size]]
            if parts:
                total = sum(log_frequency(size, part, lang) for part in parts)
                return total / len(parts) / 2**step
        return 0.0

    made = {}
    for doc_id, text, _ in rows:
        words = plain_words(text)
        means = {
            lang: sum(score_of(word, lang) for word in words) / len(words)
            for lang in sorted(seen)
            if words
        }
        best = max(means, key=means.get, default="und")
        likely = 1 / sum(math.exp(x - means[best]) for x in means.values()) if means else 0.0
        made[doc_id, text] = best, likely
    return made


def compare(spark, folder, rows):
    want = plain_languages(rows)
    got = op10_language(spark, folder).collect()
    text_of = {doc_id: text for doc_id, text, _ in rows}
    assert sorted(r.doc_id for r in got) == sorted(doc_id for doc_id, _, _ in rows)
    for row in got:
        lang, score = want[row.doc_id, text_of[row.doc_id]]
        assert (row.lang_pred, row.held_out) == (lang, is_held_out(row.doc_id)), row
        assert row.score == pytest.approx(score, abs=1e-9), row
    return {row.lang_pred for row in got}


def test_whole_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    found = compare(spark, small, [tuple(row) for row in docs.collect()])
    assert len(found - {"und"}) == 4


def test_every_backoff_step(spark, folder):
    """Unseen words that share four, three, two and one letters with learned ones, and none."""
    taught = [("marlow tanset", "x"), ("marlow birkun", "x"), ("tolvek birkun", "y"), ("tolvek", "y")]
    asked = ["marlows", "tolvx tarb", "mq", "qkq", "zzz", "½ ²", "", None, "marlow zzz qo é"]
    learned = [i for i in range(1, 60) if not is_held_out(i)]
    rows = [(learned[k], *taught[k % len(taught)]) for k in range(8)]
    rows += [(100 + k, text, None) for k, text in enumerate(asked)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    table.write.parquet(f"{folder}/documents.parquet")
    assert compare(spark, folder, rows) == {"x", "y", "und"}
