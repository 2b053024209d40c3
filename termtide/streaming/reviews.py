"""Windowed and running analyses of a review message stream.

Every function takes messages in a broker's shape, `(value, timestamp)`, and returns the
result; where it goes, how often and in which mode is the sink's business.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from termtide.functions.stopwords import STOP7, STOP11
from termtide.operators.counts import label_counts, total_count, word_count
from termtide.operators.messages import (
    checked_messages,
    parse_messages,
    unfit,
    with_arrival_time,
    with_broker_time,
    with_event_time,
)
from termtide.operators.tokens import drop_stop_words, tokenize
from termtide.operators.windows import block_count, block_windows, slide_panes, windowed_count
from termtide.sinks.ledger import Kept

DELAY = "1 minute"
WORD_WINDOWS = ("60 seconds", "20 seconds")
SAVED_WINDOWS = ("60 seconds", "30 seconds")
EVERY_FAST, EVERY_LABELS, EVERY_SAVED = "5 seconds", "10 seconds", "60 seconds"


def messages_at_event_time(messages: DataFrame) -> DataFrame:
    """Parsed messages with `event_time` from `created_at`."""
    return with_event_time(parse_messages(messages))


def event_tokens(timed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`(word, event_time)` of parsed messages, common words dropped, with further columns."""
    words = tokenize(timed, "review", "nonword", keep=["event_time", *keep])
    return drop_stop_words(words, STOP11)


def words_at_event_time(messages: DataFrame) -> DataFrame:
    """`(word, event_time)` on `created_at`, common words dropped."""
    return event_tokens(messages_at_event_time(messages))


def timed_messages(messages: DataFrame) -> DataFrame:
    """Parsed messages with `event_time` from `created_at` and `unparsed` where they do not fit."""
    return with_event_time(checked_messages(messages))


def words_in_windows(timed: DataFrame) -> DataFrame:
    """`words_by_event_time` of messages that are parsed already, without a watermark."""
    return windowed_count(event_tokens(timed), "event_time", ["word"], "60 seconds", "20 seconds")


def words_in_blocks(timed: DataFrame) -> DataFrame:
    """`words_in_windows` as the blocks that a ledger keeps in place of the windows."""
    return block_count(event_tokens(timed), "event_time", ["word"], *WORD_WINDOWS)


def labels_in_windows(timed: DataFrame, label: str = "sentiment") -> DataFrame:
    """Labels of parsed messages in 60-second windows every 20 seconds."""
    return windowed_count(timed, "event_time", [label], "60 seconds", "20 seconds")


# Results of one parsed stream, and how a ledger keeps them.
ANALYSIS = {"words": words_in_blocks, "labels": label_counts, "unfit": unfit}
ANALYSIS_KEPT = {
    "words": Kept(("window", "word"), delay=DELAY, blocks=WORD_WINDOWS),
    "labels": Kept(("sentiment",)),
    "unfit": Kept(("unparsed",)),
}


def words_at_broker_time(messages: DataFrame) -> DataFrame:
    """`(word, event_time)` on the broker's time, case kept."""
    return broker_tokens(with_broker_time(messages))


def broker_tokens(timed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`(word, event_time)` of parsed messages, case kept, with further columns."""
    return tokenize(timed, "review", "nonword_cased", keep=["event_time", *keep])


def words_by_event_time(messages: DataFrame) -> DataFrame:
    """60-second windows every 20 seconds on `created_at`."""
    words = words_at_event_time(messages)
    return windowed_count(words, "event_time", ["word"], "60 seconds", "20 seconds", DELAY)


def word_blocks_by_event_time(messages: DataFrame) -> DataFrame:
    """`words_by_event_time` as blocks, whose state ends when the last of their windows does."""
    return block_count(words_at_event_time(messages), "event_time", ["word"], *WORD_WINDOWS, DELAY)


def words_by_broker_time(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    """30-second windows every 10 seconds on the broker's time."""
    words = words_at_broker_time(messages)
    return windowed_count(words, "event_time", ["word"], "30 seconds", "10 seconds", watermark)


def panes(words: DataFrame, slide: str) -> DataFrame:
    """Tumbling counts to keep as state in place of sliding windows, complete mode."""
    return windowed_count(words, "event_time", ["word"], slide)


def windows_from(size: str, slide: str) -> Callable[[DataFrame], DataFrame]:
    """The step from stored panes to sliding windows, for a snapshot sink."""
    return lambda stored: slide_panes(stored, ["word"], size, slide)


def blocks(words: DataFrame, size: str, slide: str) -> DataFrame:
    """Counts of several panes in a row, to keep as state in place of `panes`, complete mode."""
    return block_count(words, "event_time", ["word"], size, slide)


def windows_from_blocks(size: str, slide: str) -> Callable[[DataFrame], DataFrame]:
    """The step from stored blocks to sliding windows, which shuffles nothing."""
    return lambda stored: block_windows(stored, ["word"], size, slide)


def saved_words(timed: DataFrame) -> DataFrame:
    """60-second windows every 30 seconds over raw words of `(review, event_time)`."""
    return windowed_count(saved_tokens(timed), "event_time", ["word"], *SAVED_WINDOWS, DELAY)


def saved_tokens(timed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The `(word, event_time)` that `saved_words` counts, with further columns."""
    words = tokenize(timed, "review", "ws_raw", keep=["event_time", *keep])
    return drop_stop_words(words, STOP7)


def saved_labels(timed: DataFrame, label: str = "sentiment") -> DataFrame:
    """30-second windows over labels of `(label, event_time)`."""
    return windowed_count(timed, "event_time", [label], "30 seconds", watermark=DELAY)


def words_by_arrival(messages: DataFrame) -> DataFrame:
    """`saved_words` timed by the moment of processing."""
    return saved_words(with_arrival_time(parse_messages(messages)))


def labels_by_arrival(messages: DataFrame) -> DataFrame:
    """`saved_labels` timed by the moment of processing."""
    return saved_labels(with_arrival_time(parse_messages(messages)))


def running_labels(messages: DataFrame, normalize: bool = False) -> DataFrame:
    """Label counts over everything so far."""
    return label_counts(parse_messages(messages), normalize=normalize)


def running_words(messages: DataFrame, stop_words: tuple[str, ...] = STOP7) -> DataFrame:
    """Counts of all-letter words over everything so far."""
    words = tokenize(parse_messages(messages), "review", "ws_alpha")
    return word_count(drop_stop_words(words, stop_words))


def running_total(messages: DataFrame) -> DataFrame:
    """Number of messages so far."""
    return total_count(messages)
