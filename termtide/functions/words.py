"""The five word rules. They differ on purpose and give different counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from termtide.functions.text import SPACES

# A lower-case ASCII word that is not part of a longer run of letters, digits or `_`
# of any script. Spelled out, since the reach of \b differs between Java versions.
WORD_CHAR = r"[\p{L}\p{N}_]"
ASCII_RUN = rf"(?<!{WORD_CHAR})[a-z]++(?!{WORD_CHAR})"
ALL_LETTERS = r"^\p{L}++$"


@dataclass(frozen=True)
class WordRule:
    """`pieces` turns a text into an array; `accept` and `shape` act on single pieces."""

    pieces: Callable[[Column], Column]
    accept: Callable[[Column], Column] | None = None
    shape: Callable[[Column], Column] | None = None


def not_blank(word: Column) -> Column:
    return word != ""


def all_letters(word: Column) -> Column:
    return word.rlike(ALL_LETTERS)


# Lowering comes after the letter test in `ws_alpha`: lower-casing can add a combining
# mark, which is not a letter.
RULES: dict[str, WordRule] = {
    "ws_alpha": WordRule(lambda t: F.split(t, SPACES), all_letters, F.lower),
    "ascii_runs": WordRule(
        lambda t: F.regexp_extract_all(F.lower(t), F.lit(ASCII_RUN), F.lit(0))
    ),
    "nonword": WordRule(lambda t: F.split(F.lower(t), r"\W+"), not_blank),
    "nonword_cased": WordRule(lambda t: F.split(t, r"\W+"), not_blank),
    "ws_raw": WordRule(lambda t: F.split(F.lower(t), r"\s+")),
}


def rule(name: str) -> WordRule:
    try:
        return RULES[name]
    except KeyError:
        raise ValueError(f"unknown word rule {name!r}; known: {', '.join(RULES)}") from None
