"""Language identification by words first, then by ever shorter character n-grams.

Each language is a table of log frequencies of its words and of the character n-grams of its
words. A word that some language knows is scored by the word table. An unseen word falls back
to its longest n-grams that are known anywhere, averaged, with a lower weight at each step down.
A text's language has the highest mean score per word; the score is that language's share when
the means are turned into probabilities.

The model is fitted on about `docs_per_lang` labelled documents of each language, chosen by a
hash of their ids, and holds every word and n-gram that these have twice or more, with the counts
of all languages. The sample bounds its size, not the corpus. Prediction reads whole texts and all documents.

Defined results: a null text, or one without letters, is `und` with score 0, as is every text
if there is nothing to learn from; a tie goes to the alphabetically first language; repeated
documents give one row each.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import batch_of, columns_of, cut, let_go, small_batches, use_text_batches

UNKNOWN = "und"
DOCS_PER_LANG = 1_500
LONGEST_GRAM = 4
STEP_WEIGHT = 0.5
BATCH_ROWS = 500
REMEMBERED_WORDS = 100_000

# Letters and the marks that go with them, as Unicode has them; signs for numbers are neither.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
_COUNTS = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("unit", pa.string()), ("n", pa.int64())]
)
_COUNTS_DDL = "lang string, size int, unit string, n bigint"


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def grams_of(word: str, size: int) -> list[str]:
    """Character n-grams of a word with its ends marked; the marks alone are none."""
    marked = f"<{word}>" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


@dataclass
class Model:
    """Log frequencies by language; `units[0]` are words, `units[n]` the n-grams."""

    langs: list[str]
    units: list[dict[str, tuple[float, ...]]]
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _table: np.ndarray | None = field(default=None, repr=False)

    def word_scores(self, word: str) -> tuple[float, ...]:
        known = self.units[0].get(word)
        if known is not None:
            return known
        weight = 1.0
        for size in range(len(self.units) - 1, 0, -1):
            weight *= STEP_WEIGHT
            found = list(filter(None, map(self.units[size].get, grams_of(word, size))))
            if found:
                part = weight / len(found)
                return tuple([part * sum(column) for column in zip(*found)])
        return (0.0,) * len(self.langs)

    def _numbers(self, words: list[str]) -> list[int]:
        """Rows of the score table for these words; it starts anew when it is full."""
        rows = self._rows
        if self._table is None or len(rows) > REMEMBERED_WORDS:
            rows.clear()
            self._table = np.empty((1 << 15, len(self.langs)))
        fresh = list(set(words).difference(rows))
        first, last = len(rows), len(rows) + len(fresh)
        rows.update(zip(fresh, range(first, last)))
        while last > len(self._table):
            self._table = np.concatenate([self._table, np.empty_like(self._table)])
        if fresh:
            self._table[first:last] = [self.word_scores(word) for word in fresh]
        return list(map(rows.__getitem__, words))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0
        means = self._table_of(words).mean(axis=0)
        likely = np.exp(means - means.max())
        best = int(np.argmax(means))
        return self.langs[best], float(likely[best] / likely.sum())

    def _table_of(self, words: list[str]) -> np.ndarray:
        numbers = self._numbers(words)
        return self._table[numbers]


def _count_words(batches):
    for batch in small_batches(batches, BATCH_ROWS):
        counts: Counter = Counter()
        for lang, text in zip(*columns_of(batch, "lang", "text")):
            counts.update((lang, word) for word in words_of(text))
        rows = [(lang, 0, word, n) for (lang, word), n in counts.items()]
        yield batch_of(_COUNTS, zip(*rows) if rows else ([], [], [], []))


def _count_grams(longest: int):
    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for lang, word, n in zip(*columns_of(batch, "lang", "unit", "n")):
                for size in range(1, longest + 1):
                    for gram in grams_of(word, size):
                        counts[lang, size, gram] += n
            rows = [(*key, n) for key, n in counts.items()]
            yield batch_of(_COUNTS, zip(*rows) if rows else ([], [], [], []))

    return run


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG,
    longest_gram: int = LONGEST_GRAM,
) -> Model:
    """Learn from a bounded sample of the rows that have a label and a text."""
    use_text_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    # The part of the hash range that holds the wanted number of documents of each language.
    chosen = F.lit(False)
    for lang, size in sizes.items():
        part = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(size)) < docs_per_lang
        chosen = chosen | ((F.col("lang") == lang) & part)
    sample = rows.filter(chosen).select("text", "lang")

    def total(counts: DataFrame) -> DataFrame:
        return counts.groupBy("lang", "size", "unit").agg(F.sum("n").alias("n"))

    words = cut(total(sample.mapInArrow(_count_words, _COUNTS_DDL)), "language-words")
    grams = total(words.mapInArrow(_count_grams(longest_gram), _COUNTS_DDL))
    by_lang = words.groupBy("lang").agg(F.sum("n").alias("words")).collect()
    seen = {r["lang"]: r["words"] for r in by_lang}
    langs = sorted(seen)
    tables: list[dict[str, tuple[int, ...]]] = [{} for _ in range(longest_gram + 1)]
    by_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)) for lang in langs]
    for counts in (words, grams) if langs else ():
        whole = counts.groupBy("size", "unit").agg(F.sum("n").alias("n"), *by_lang)
        # A unit seen once says nothing.
        for size, unit, _, *row in whole.filter("n > 1").collect():
            tables[size][unit] = tuple(row)
    units = [
        {
            unit: tuple(
                math.log((n + 0.5) / (seen[lang] + 0.5 * len(table)))
                for lang, n in zip(langs, row)
            )
            for unit, row in table.items()
        }
        for table in tables
    ]
    return Model(langs, units)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of the documents with `lang_pred` and `score`, replacing columns so named."""
    use_text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(*{"lang_pred", "score"} - {text_col})
    names = [c for c in kept.columns if c not in ("lang_pred", "score")]
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        let_go()
        own = shared.value
        for batch in small_batches(batches, BATCH_ROWS):
            found = [own.predict(text) for text in columns_of(batch, text_col)[0]]
            scored = batch_of(added, zip(*found) if found else ([], []))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), *scored.columns], names=[*names, *added.names]
            )

    schema = kept.select(*names).schema.add("lang_pred", "string").add("score", "double")
    return kept.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """A fifth of the ids, which the contract keeps from learning; null ids are among them."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(True))
