"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Measures are taken from each whole text in place; nothing is exploded, so no text is shuffled.

A rule rejects a document when its measure is above the cutoff of the document's stratum. All
rules share one scale of levels, so a cutoff is one number and the settings are nested: a lower
cutoff rejects all that a higher one does. Cutoffs come from labelled documents. For each stratum
they are tested in a fixed order, from the highest down: the good documents that a cutoff would
reject are counted, and the exact binomial tail gives the chance of so few if the true rate were
as high as allowed. The first cutoff at which that chance is above the error level ends the
sequence; those before it have passed. A fixed order needs no correction for the number of
cutoffs, and rules are not tested apart; the error is divided by the number of strata alone. So
with confidence `1 - error` no cutoff that passed, in any stratum, falsely rejects more than
`max_rejected` of the good documents, and it is free which of them is used: of those that reject
most of the documents labelled bad, of these such as reject fewest good ones, the lowest.
Where labels are too few to show that, nothing is rejected: without rejections,
log(error / strata) / log(1 - max_rejected) good documents are needed, 217 for four strata.

Defined results: a null or empty text has no words and fails the base rule; null labels and
labels of unknown documents are ignored; a null stratum is one of its own; a document with
several labels counts as good for each good one; repeated documents give one row each; other
columns of either table are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_REJECTED = 0.02
ERROR = 0.05
LEVELS = 100

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t\n\x0B\f\r]+"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"
SYMBOLS = "#*$%&|<>"

# Rules by the measure they bound, in steps of 1 / LEVELS of the span given here.
RULES = {
    "symbols_per_char": 1.0,
    "dup_line_share": 1.0,
    "repeat_word_share": 1.0,
    "chars_per_word": 50.0,
}


def _without(text: Column, signs: str) -> Column:
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text


def measures(docs: DataFrame, id_col: str, text_col: str, stratum_col: str | None) -> DataFrame:
    """`(id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)`.

    Each step is a projection of its own, since an array that several expressions use would
    otherwise be made for each of them.
    """
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit("")
    rows = docs.select(
        F.col(id_col).alias("id"),
        stratum.alias("stratum"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_SPACE))
    rows = rows.select(
        "id",
        "stratum",
        F.char_length(_without(F.col("text"), SPACES)).cast("bigint").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS)))
        .cast("bigint")
        .alias("n_symbols"),
        lines.alias("lines"),
        F.array_remove(F.split("text", SPACE_RUN), "").alias("words"),
    )
    count = F.size("words")
    hashes = F.transform(
        F.sequence(F.lit(0), count - WINDOW),
        lambda at: F.xxhash64(*[F.get("words", at + k) for k in range(WINDOW)]),
    )
    rows = rows.select(
        "id",
        "stratum",
        count.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(count >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    # Most texts repeat no window, which a set tells; only the others are sorted.
    placed = F.transform("hashes", lambda h, at: F.struct(h.alias("hash"), at.alias("at")))
    kept = [c for c in rows.columns if c != "hashes"]
    rows = rows.select(
        *kept,
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(placed))
        .otherwise(F.array().cast("array<struct<hash:bigint,at:int>>"))
        .alias("windows"),
    )
    found_twice = F.filter(
        "windows",
        lambda w, i: (F.get("windows", i - 1)["hash"] == w["hash"])
        | (F.get("windows", i + 1)["hash"] == w["hash"]),
    )
    rows = rows.select(*kept, F.sort_array(F.transform(found_twice, lambda w: w["at"])).alias("at"))
    # Windows overlap, so each adds what lies before the next one.
    covered = F.aggregate(
        "at",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda state, at: F.struct(
            (state["n"] + (at + WINDOW - F.greatest(at, state["end"]))).alias("n"),
            (at + WINDOW).alias("end"),
        ),
        lambda state: state["n"],
    )
    return rows.select(*kept, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _levels() -> Column:
    """`(rule, level)` of a row of measures; levels are whole numbers from 0 to LEVELS."""
    share = {
        "symbols_per_char": F.try_divide("n_symbols", "word_chars"),
        "dup_line_share": F.try_divide("n_dup_lines", "n_lines"),
        "repeat_word_share": F.try_divide("n_repeat_words", "n_words"),
        "chars_per_word": F.try_divide("word_chars", "n_words"),
    }
    return F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.least(
                    F.lit(LEVELS), F.floor(F.coalesce(share[rule], F.lit(0.0)) / span * LEVELS)
                )
                .cast("int")
                .alias("level"),
            )
            for rule, span in RULES.items()
        ]
    )


def _log_factorial(n: Column) -> Column:
    """Stirling's series at n + 8, where it is exact to double precision, taken back 8 steps."""
    x = n + 8.0
    series = (
        (x + 0.5) * F.log(x)
        - x
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * x)
        - 1 / (360 * F.pow(x, F.lit(3)))
        + 1 / (1260 * F.pow(x, F.lit(5)))
        - 1 / (1680 * F.pow(x, F.lit(7)))
    )
    for step in range(8):
        series = series - F.log(x - step)
    return series


def lower_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial X with n trials, for k below the mean; 1 from the mean on.

    Terms fall from k downwards at least as fast as a geometric series, and the sum ends where
    they can no longer change a double.
    """
    k, n = k.cast("double"), n.cast("double")
    most = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
    most = F.exp(most + k * math.log(rate) + (n - k) * math.log1p(-rate))
    terms = F.least(k, F.ceil(F.sqrt(n) * 40) + 40).cast("int")
    odds = (1 - rate) / rate
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(state: Column, j: Column) -> Column:
        term = state["term"] * (k - j + 1) / (n - k + j) * odds
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, step, lambda state: state["sum"])
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), most * total))


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    max_rejected: float = MAX_REJECTED,
    error: float = ERROR,
) -> DataFrame:
    """`(stratum, cutoff, n_good, n_rejected)` for each stratum where rules may be used."""
    known = labels.filter(F.col(good_col).isNotNull()).select(
        F.col(label_id_col).alias("id"), (F.col(good_col) == 1).alias("good")
    )
    highest = F.array_max(F.transform(_levels(), lambda x: x["level"]))
    levels = (
        measured.join(known, "id")
        .groupBy("stratum", highest.alias("level"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # A map from level to documents for each stratum has at most LEVELS + 1 entries.
    spread = levels.groupBy("stratum").agg(
        F.sum("good").alias("n_good"),
        F.collect_list(F.struct("level", "good", "bad")).alias("by_level"),
    ).filter("n_good > 0")
    strata = spread.agg(F.count("*")).scalar()

    def above(kind: str) -> Column:
        return F.aggregate(
            F.filter("by_level", lambda x: x["level"] > F.col("cutoff")),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x[kind],
        )

    tried = (
        spread.withColumn("cutoff", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
        .withColumn("n_rejected", above("good"))
        .withColumn("n_caught", above("bad"))
    )
    tail = lower_tail(F.col("n_rejected"), F.col("n_good"), max_rejected)
    # Rejections only grow as the cutoff falls, and the tail with them, so the cutoffs that pass
    # are those before the first that fails.
    passed = tried.filter(tail <= F.lit(error) / strata)
    fewest = (-F.col("n_rejected")).alias("spared")
    best = F.struct("n_caught", fewest, (-F.col("cutoff")).alias("low"), "cutoff", "n_good", "n_rejected")
    found = passed.groupBy("stratum").agg(F.max(best).alias("best"))
    return found.select("stratum", "best.cutoff", "best.n_good", "best.n_rejected")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str | None = "lang",
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    max_rejected: float = MAX_REJECTED,
    error: float = ERROR,
) -> DataFrame:
    """Measures, `base_failed`, `kept` and the rules that reject (`rejected_by`) per document."""
    measured = cut(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    found = cutoffs(measured, labels, label_id_col, good_col, max_rejected, error)
    by_stratum = cut(found.select(F.col("stratum").alias("of"), "cutoff"), "quality-cutoffs")
    ruled = measured.join(by_stratum, F.col("stratum").eqNullSafe(F.col("of")), "left")
    rejecting = F.filter(_levels(), lambda x: x["level"] > F.col("cutoff"))
    names = F.array_join(F.transform(rejecting, lambda x: x["rule"]), ",")
    ruled = ruled.select(
        F.col("id").alias(id_col),
        *[c for c in measured.columns if c not in ("id", "stratum")],
        base_failed().alias("base_failed"),
        F.coalesce(names, F.lit("")).alias("rejected_by"),
    )
    kept = ~F.col("base_failed") & (F.col("rejected_by") == "")
    return ruled.select(
        *[c for c in ruled.columns if c != "rejected_by"], kept.alias("kept"), "rejected_by"
    )
