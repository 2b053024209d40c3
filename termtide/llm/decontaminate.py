"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in documents.

Both sides become words with one space around each, so a window of words is one byte string
and an occurrence is a whole-word occurrence. Wu-Manber looks at the last block of bytes under
the search position: a table tells how far no pattern can end, and only where it says zero do
the buckets of suffix and prefix blocks name patterns that are compared directly. Patterns of
very different length are searched with tables of their own, since the shortest bounds the
skips of all.

Documents are read once and never shuffled. Patterns are dealt into tables of about `per_pass`
under the shared folder. A task holds a block of texts and searches it with one table after the
other, so a larger benchmark costs more time, not more memory, and no text is written again.

Defined results: a null or empty text has no words and no hits; an item without words gives no
window; repeated items count once by id; an item with a null id marks words as hit but is not
listed; repeated documents give one row each; other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.llm.common import batch_of, columns_of, cut, id_and_bytes, small_batches, spaced
from termtide.llm.common import carried, held, restored
from termtide.session import scratch_dir

WINDOW = 10
PER_PASS = 50_000
BLOCK_BYTES = 64 << 20
SHIFT_SLOTS = 1 << 22
BATCH_ROWS = 1_000

_ITEM_SCHEMA = "item string, pattern binary"
_FOUND = pa.schema(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())),
    ]
)
_FOUND_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class WuManber:
    """Search for many byte strings at once."""

    def __init__(self, patterns: tuple[bytes, ...]) -> None:
        by_size: dict[int, list[bytes]] = {}
        for pattern in set(patterns):
            by_size.setdefault(len(pattern).bit_length(), []).append(pattern)
        self._tables = [_ShiftTable(group) for _, group in sorted(by_size.items())]

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Every occurrence as (start, pattern)."""
        for table in self._tables:
            yield from table.search(text)


class _ShiftTable:
    def __init__(self, patterns: list[bytes]) -> None:
        self.shortest = min(map(len, patterns))
        # About two bits of information per byte of running text; the block must tell the
        # blocks of all patterns apart for skips to be long.
        places = 2 * self.shortest * len(patterns)
        self.block = min(self.shortest, max(2, math.ceil(math.log2(places) / 2)))
        self.furthest = min(255, self.shortest - self.block + 1)
        self.shifts = bytearray([self.furthest]) * SHIFT_SLOTS
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = {}
        mask, block, shortest = SHIFT_SLOTS - 1, self.block, self.shortest
        for pattern in patterns:
            for end in range(block, shortest + 1):
                slot = hash(pattern[end - block : end]) & mask
                self.shifts[slot] = min(self.shifts[slot], shortest - end)
            by_prefix = self.buckets.setdefault(pattern[shortest - block : shortest], {})
            by_prefix.setdefault(pattern[:block], []).append(pattern)

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        shifts, buckets = self.shifts, self.buckets
        mask, block, shortest = SHIFT_SLOTS - 1, self.block, self.shortest
        end, size = shortest, len(text)
        while end <= size:
            seen = text[end - block : end]
            shift = shifts[hash(seen) & mask]
            if shift:
                end += shift
                continue
            by_prefix = buckets.get(seen)
            if by_prefix:
                start = end - shortest
                for pattern in by_prefix.get(text[start : start + block], ()):
                    if text.startswith(pattern, start):
                        yield start, pattern
            end += 1


def item_windows(raw: bytes | None, window: int) -> list[bytes]:
    """The distinct windows of an item; a shorter item is one window."""
    words = spaced(raw).split()
    last = max(1, len(words) - window + 1) if words else 0
    spans = {b" " + b" ".join(words[i : i + window]) + b" " for i in range(last)}
    return sorted(spans)


def _searcher(folder: str, turn: int):
    """The search and the items of each pattern of a table; a worker keeps them for its next task."""
    files, root = fs.FileSystem.from_uri(folder)
    parts = files.get_file_info(fs.FileSelector(f"{root}/turn={turn}", allow_not_found=True))
    items: dict[bytes, list[str | None]] = {}
    for part in parts:
        if part.path.endswith(".parquet"):
            with files.open_input_file(part.path) as file:
                table = pq.ParquetFile(file).read(columns=["item", "pattern"])
            for item, pattern in zip(*columns_of(table, "item", "pattern")):
                items.setdefault(pattern, []).append(item)
    return WuManber(tuple(items)), items


def _hits(
    text: bytes, searcher: WuManber, items: dict[bytes, list[str | None]]
) -> tuple[list[int], set[str | None]]:
    words: set[int] = set()
    found: set[str | None] = set()
    edges = None
    for start, pattern in searcher.search(text):
        if edges is None:
            edges = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        first = int(np.searchsorted(edges, start))
        words.update(range(first, first + pattern.count(b" ") - 1))
        found.update(items[pattern])
    return sorted(words), found


def _windows_of(window: int):
    def run(batches):
        for batch in batches:
            ids, raws = columns_of(batch, "id", "raw")
            rows = [(i, p) for i, raw in zip(ids, raws) for p in item_windows(raw, window)]
            schema = pa.schema([("item", pa.string()), ("pattern", pa.binary())])
            yield batch_of(schema, zip(*rows) if rows else ([], []))

    return run


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches together until their texts have `size` bytes."""
    held, bytes_held = [], 0
    for batch in batches:
        held.append(batch)
        bytes_held += batch.column("raw").nbytes
        if bytes_held >= size:
            yield held
            held, bytes_held = [], 0
    if held:
        yield held


def _scan(folder: str, turns: int, kept: list[str]):
    def run(batches):
        # Just one table stays loaded, so only several of them need larger blocks.
        size = BLOCK_BYTES if turns > 1 else 0
        for block in _blocks(small_batches(batches, BATCH_ROWS), size):
            texts = [spaced(raw) for batch in block for raw in columns_of(batch, "raw")[0]]
            hits: dict[int, set[int]] = {}
            items: dict[int, set[str]] = {}
            for turn in range(turns):
                searcher, items_of = held(
                    ("benchmark", folder, turn), partial(_searcher, folder, turn)
                )
                for place, text in enumerate(texts):
                    words, found = _hits(text, searcher, items_of)
                    if words:
                        hits.setdefault(place, set()).update(words)
                        items.setdefault(place, set()).update(i for i in found if i is not None)
            place = 0
            for batch in block:
                places = range(place, place + batch.num_rows)
                place += batch.num_rows
                made = batch_of(
                    _FOUND,
                    (
                        [texts[i].count(b" ") - 1 for i in places],
                        [sorted(hits.get(i, ())) for i in places],
                        [sorted(items.get(i, ())) for i in places],
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [*map(batch.column, kept), *made.columns], names=[*kept, *_FOUND.names]
                )

    return run


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    per_pass: int = PER_PASS,
    keep_row: bool = False,
) -> DataFrame:
    """`(id, n_words, hits, items)` per document: hit word positions and the ids they are from.

    With `keep_row` the document's own columns come along, in the struct `row`.
    """
    # The documents' batches are bounded by this call too.
    raw_items = id_and_bytes(items, item_col, item_text_col)
    patterns = cut(
        raw_items.withColumn("id", F.col("id").cast("string"))
        .mapInArrow(_windows_of(window), _ITEM_SCHEMA)
        .distinct(),
        "benchmark-windows",
    )
    turns = math.ceil(patterns.count() / per_pass)
    folder = scratch_dir(docs.sparkSession, "benchmark-tables")
    if turns:
        dealt = F.pmod(F.xxhash64("pattern", "item"), F.lit(turns))
        # One file a table; what a task gets is bounded by the size of a table.
        tables = patterns.withColumn("turn", dealt).repartition(turns, "turn")
        tables.write.partitionBy("turn").parquet(folder)
    rows = carried(docs, text_col).select(
        (F.col("text") if id_col == text_col else F.col("row").getField(id_col)).alias("id"),
        F.col("text").cast("binary").alias("raw"),
        "row",
    )
    # Without `keep_row` neither the texts nor the other columns come back from Python.
    kept = ["id", "raw", "row"] if keep_row else ["id"]
    given = rows if keep_row else rows.select("id", "raw")
    schema = T.StructType([*given.select(*kept).schema, *_FOUND_FIELDS])
    found = given.mapInArrow(_scan(folder, turns, kept), schema)
    row = []
    if keep_row:
        found = found.withColumn("text", F.col("raw").cast("string"))
        row = [F.struct(*restored(docs.columns, text_col)).alias("row")]
    return found.select(F.col("id").alias(id_col), "n_words", "hits", "items", *row)
