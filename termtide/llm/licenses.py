"""Licence scan: fuzzy search for short notices in whole documents.

A notice found with at most e edits contains one of its e + 1 pieces unchanged (pigeonhole), so
exact search for the pieces names the only places worth a look. Around each, the regex library's
bounded-error matching verifies the whole notice on word boundaries and reports its span and
edits. Spans of base notices without edits are the base; all others add labels.

Defined results: a null or empty text has no words, places or labels and scores 0; repeated
documents give one row each; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import columns_of, id_and_bytes, small_batches, spaced

BATCH_ROWS = 1_000


class Notice(NamedTuple):
    """A phrase of lower-case words, its label, the edits it may have, and if it is a base one.

    A first word of up to `EXACT_LETTERS` letters must stand unchanged: an edit there makes
    another word, as in "omit license" or "it license".
    """

    phrase: str
    label: str
    edits: int
    base: bool = False

    def parts(self) -> tuple[bytes, bytes]:
        """What must stand unchanged, and what may have edits."""
        first, _, rest = self.phrase.encode().partition(b" ")
        if rest and len(first) <= EXACT_LETTERS:
            return first + b" ", rest
        return b"", self.phrase.encode()


EXACT_LETTERS = 4
# Phrases, labels. Edits are one per ten characters, none for very short phrases.
NOTICES = (
    Notice("gnu general public license", "gpl", 2, True),
    Notice("apache license", "apache", 1, True),
    Notice("cc by", "cc-by", 0, True),
    Notice("mit license", "mit", 1, True),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("mozilla public license", "mpl", 2),
    Notice("eclipse public license", "epl", 2),
    Notice("boost software license", "bsl", 2),
    Notice("bsd license", "bsd", 1),
    Notice("isc license", "isc", 1),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("creative commons zero", "cc0", 2),
    Notice("permission is hereby granted free of charge", "mit", 4),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("spdx license identifier", "spdx", 2),
)

_SPANS = (
    "array<struct<first:bigint,last:bigint,label:string,edits:bigint,base:boolean,"
    "share:double,matched:string>>"
)


class _Search(NamedTuple):
    notice: Notice
    pieces: list[tuple[int, bytes]]
    pattern: regex.Pattern
    whole: list[regex.Pattern]

    def edits(self, matched: bytes) -> int:
        """The fewest edits that make the notice of this."""
        return next(e for e, pattern in enumerate(self.whole) if pattern.fullmatch(matched))


@lru_cache(maxsize=8)
def _searches(notices: tuple[Notice, ...]) -> list[_Search]:
    made = []
    for notice in notices:
        (fixed, loose), parts = notice.parts(), notice.edits + 1
        cuts = [len(loose) * i // parts for i in range(parts + 1)]
        pieces = [(len(fixed) + a, loose[a:b]) for a, b in zip(cuts, cuts[1:])]
        head, bare = (regex.escape(part, literal_spaces=True) for part in (fixed, loose))
        whole = [
            regex.compile(b"%b(?:%b)" % (head, bare) + (b"{e<=%d}" % e if e else b""))
            for e in range(parts)
        ]
        inside = regex.compile(b"(?<= )" + whole[-1].pattern + b"(?= )")
        made.append(_Search(notice, pieces, inside, whole))
    return made


def _regions(text: bytes, search: _Search) -> list[tuple[int, int]]:
    """Where a seed says that the notice may stand, with whole words at both ends."""
    size, edits = len(search.notice.phrase.encode()), search.notice.edits
    found = []
    for offset, piece in search.pieces:
        at = text.find(piece)
        while at >= 0:
            found.append((max(0, at - offset - edits), at - offset + size + edits))
            at = text.find(piece, at + 1)
    merged: list[tuple[int, int]] = []
    for low, high in sorted(found):
        low = max(0, text.rfind(b" ", 0, low + 1))
        high = text.find(b" ", min(high, len(text) - 1)) + 1 or len(text)
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


class _Taken:
    """Accepted spans in order; none is longer than `longest`."""

    def __init__(self, longest: int):
        self.longest, self.spans = longest, []

    def overlaps(self, first: int, last: int) -> bool:
        at = bisect_left(self.spans, (first - self.longest, 0))
        while at < len(self.spans) and self.spans[at][0] < last:
            if self.spans[at][1] > first:
                return True
            at += 1
        return False

    def add(self, first: int, last: int) -> None:
        insort(self.spans, (first, last))


def notice_spans(
    text: bytes, notices: tuple[Notice, ...]
) -> list[tuple[int, int, str, int, bool, float, str]]:
    """Spans `(first word, last word, label, edits, base, share, matched)` of a `spaced` text.

    Every exact place is reported. A span with edits is reported unless it overlaps a place of
    the same notice with fewer edits, or as many and further left. `share` is the part of the
    notice's characters that stand unchanged, and `base` tells exact places of base notices.
    """
    spans = []
    for search in _searches(notices):
        regions = _regions(text, search)
        if not regions:
            continue
        notice, matches = search.notice, []
        for low, high in regions:
            for match in search.pattern.finditer(text[low:high], overlapped=True):
                first, last = low + match.start(), low + match.end()
                matches.append((search.edits(match.group()), first, last))
        size = len(notice.phrase.encode())
        taken = _Taken(size + notice.edits)
        for edits, first, last in sorted(set(matches)):
            if edits and taken.overlaps(first, last):
                continue
            taken.add(first, last)
            base = notice.base and not edits
            spans.append((first, last, notice.label, edits, base, 1 - edits / size))
    if not spans:
        return []
    edges = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return [
        (
            int(np.searchsorted(edges, first)) - 1,
            int(np.searchsorted(edges, last)) - 1,
            *found,
            text[first:last].decode("utf-8", "replace"),
        )
        for first, last, *found in sorted(spans)
    ]


def _scan(notices: tuple[Notice, ...]):
    kind = pa.struct(
        [
            ("first", pa.int64()),
            ("last", pa.int64()),
            ("label", pa.string()),
            ("edits", pa.int64()),
            ("base", pa.bool_()),
            ("share", pa.float64()),
            ("matched", pa.string()),
        ]
    )
    names = [field.name for field in kind]

    def run(batches):
        for batch in small_batches(batches, BATCH_ROWS):
            counts, spans = [], []
            for raw in columns_of(batch, "raw")[0]:
                text = spaced(raw)
                counts.append(text.count(b" ") - 1)
                spans.append([dict(zip(names, s)) for s in notice_spans(text, notices)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(kind))],
                names=["id", "n_words", "spans"],
            )

    return run


def license_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: tuple[Notice, ...] = NOTICES,
) -> DataFrame:
    """`(id, n_words, spans)` per document; see `notice_spans`."""
    rows = id_and_bytes(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_scan(notices), f"id {kind}, n_words bigint, spans {_SPANS}")
    return found.select(F.col("id").alias(id_col), "n_words", "spans")


def license_report(spans: DataFrame) -> DataFrame:
    """Places, labels and score of each row of `license_spans`.

    Places and base labels are those of base notices without edits. The score is the share of
    its notice's characters that the best span left unchanged.
    """
    exact = F.filter("spans", lambda s: s.base)
    starts = F.transform(exact, lambda s: s["first"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s.label))), ",")

    best = F.array_max(F.transform("spans", lambda s: s.share))
    return spans.select(
        *[c for c in spans.columns if c != "spans"],
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.greatest(F.lit(0.0), F.coalesce(best, F.lit(0.0))).alias("score"),
    )
