"""From raw documents to token ids: language, near-duplicates, benchmark, personal data, tokens.

Each stage is a table written and read again, so a lost executor costs the tasks of the running
stage only. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import bpe, decontaminate, language, pii, simhash
from termtide.llm.common import carried, cut, read_table, restored
from termtide.llm.queries import PII_KEY, tokenizer_path

# A text of one language scores over 0.7 and an even mixture of two over 0.4; below that the
# words fit no language.
MIN_LANGUAGE_SCORE = 0.35

# No SQL counterpart: the language model, hashes and tokens are beyond it.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or in no known language; all stay if none is labelled.

    Null and empty texts have no letters. A tie between languages goes to the alphabetically
    first. Repeated rows fare alike. Columns are carried through as they are, whatever their names.
    """
    model = language.fit(docs.filter(~language.held_out()))
    if not model.langs:
        return docs
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    found = language.identify(carried(docs, "text"), model).filter(known)
    return found.select(*restored(docs.columns, "text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays, the one with the smallest id.

    Null ids come last. Null and empty texts are near-duplicates of each other. Of rows with the
    same id that with the smallest hash of its text stays, and of equal rows any one. Columns are
    carried through as they are, whatever their names.
    """
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a window of a benchmark item.

    Null and empty texts contain none and stay, and so do all if there are no items. Repeated rows
    fare alike. Columns are carried through as they are, whatever their names.
    """
    items = read_table(spark, sf_dir, "benchmark")
    found = decontaminate.benchmark_hits(docs, items, keep_row=True)
    return found.filter(F.size("hits") == 0).select("row.*")


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced in the text, and its length with it; no document goes.

    Null texts stay null, with a null length. Equal values get equal pseudonyms in all rows. Other
    columns are carried through as they are, whatever their names.
    """
    clean = pii.pseudonymize(docs, PII_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.char_length("text").cast(kind))
    return clean


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (`ids`), their number (`n_tokens`), and if they decode to it (`decodes`).

    A null text counts as empty: it has no tokens and decodes. Repeated rows give a row each.
    Columns of the documents that have one of these names come out with `doc_` before it, as often
    as it takes to be new; all others are carried through as they are.
    """
    made = ("ids", "n_tokens", "decodes")
    taken, names = {*docs.columns, *made}, []
    for name in docs.columns:
        new = name
        while name in made and new in taken:
            new = f"doc_{new}"
        taken.add(new)
        names.append(new)
    coded = bpe.encode(spark, carried(docs, "text"), tokenizer_path())
    return coded.select(
        *[old.alias(new) for old, new in zip(restored(docs.columns, "text"), names)],
        "ids",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymize),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
