"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit for each bit that is set in over half of its shingles' hashes. Documents
with equal fingerprints are one class from the start, so only distinct fingerprints are compared.

Every fingerprint gets its Hamming distances to a fixed set of reference fingerprints (pivots).
Two fingerprints that differ in at most d bits have distances to any pivot that differ by at
most d, so pairs with a larger coordinate difference are discarded without being compared, and
survivors are verified bit by bit.

To compare a fingerprint with a few others only, the pivots come in groups: those of a group
differ from the base pivot within one of `BLOCKS` bit ranges, so the distances to them, less the
distance to the base pivot, depend on that range alone. With d differing bits at least
BLOCKS - d ranges are untouched, and there all these differences of distances are equal. Each
fingerprint is therefore filed under the coordinates of every choice of BLOCKS - d groups, and
two fingerprints within distance d share at least one file.

A file yields a spanning forest of its links, never all pairs. A file with more rows than
`FILE_ROWS` is cut into parts, and each pair of parts is a task of its own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import column, columns_of, cut, id_and_bytes, join_spread
from termtide.llm.common import let_go, small_batches, whole_row
from termtide.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 6
FILE_ROWS = 4_096
COMPARE_ROWS = 512
BATCH_ROWS = 1_000
# A broadcast key takes some 200 bytes, so at most 40 MB are broadcast.
FEW_KEYS = 200_000

# The base pivot has no bit set; the others have the bits of one range counted off: its first
# bit, its first two, and so on. Distances to them fix each bit of the range.
_EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
PIVOT_GROUPS = [
    [sum(1 << bit for bit in range(low, last + 1)) for last in range(low, high)]
    for low, high in zip(_EDGES, _EDGES[1:])
]
BASE_PIVOT = 0
PIVOTS = np.array([BASE_PIVOT] + [p for group in PIVOT_GROUPS for p in group], np.uint64)


def fingerprint(raw: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles; zero for a text without words."""
    tokens = (raw or b"").lower().split()
    if not tokens:
        return 0
    text = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = (ends - [len(t) + 1 for t in tokens]).tolist()
    ends = (ends - 1).tolist()
    reach = min(words, len(tokens)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(starts, ends[reach:])]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
    over_half = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over_half).view(">u8")[0])


def pivot_distances(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of 64-bit fingerprints to every pivot, one row each."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def file_keys(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each choice of pivot groups a number that stands for the coordinates in them."""
    table = pivot_distances(prints)
    relative = table[:, 1:] - table[:, :1]
    sizes = np.cumsum([0] + [len(g) for g in PIVOT_GROUPS])
    by_group = []
    for low, high in zip(sizes, sizes[1:]):
        # Neighbouring pivots of a group differ in one bit, so steps are -1 or 1.
        steps = np.diff(relative[:, low:high], axis=1, prepend=0) < 0
        by_group.append(steps @ (1 << np.arange(high - low, dtype=np.int64)))
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - max_bits)):
        key = np.full(len(prints), number, np.int64)
        for group in chosen:
            key = (key << len(PIVOT_GROUPS[group])) | by_group[group]
        keys.append(key)
    return np.stack(keys, axis=1)


def _links(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions within `max_bits`, by pivot filter and verification."""
    near_left, near_right = pivot_distances(left), pivot_distances(right)
    # One pivot after another, so that most pairs are gone before most pivots are read.
    a, b = np.nonzero(np.abs(near_left[:, None, 0] - near_right[None, :, 0]) <= max_bits)
    for pivot in range(1, len(PIVOTS)):
        if not len(a):
            break
        keep = np.abs(near_left[a, pivot] - near_right[b, pivot]) <= max_bits
        a, b = a[keep], b[keep]
    keep = np.bitwise_count(left[a] ^ right[b]) <= max_bits
    return a[keep], b[keep]


def spanning_links(prints: np.ndarray, others: np.ndarray | None, max_bits: int) -> list[tuple]:
    """Links that connect what all links among `prints`, or between them and `others`, do."""
    nodes = prints if others is None else np.concatenate([prints, others])
    parent = np.arange(len(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    shift = 0 if others is None else len(prints)
    right_side = prints if others is None else others
    for i in range(0, len(prints), COMPARE_ROWS):
        for j in range(i if others is None else 0, len(right_side), COMPARE_ROWS):
            a, b = _links(prints[i : i + COMPARE_ROWS], right_side[j : j + COMPARE_ROWS], max_bits)
            for x, y in zip((a + i).tolist(), (b + j + shift).tolist()):
                first, second = root(x), root(y)
                if first != second:
                    parent[second] = first
                    forest.append((int(nodes[x].view(np.int64)), int(nodes[y].view(np.int64))))
    return forest


def _fingerprints(words: int):
    def run(batches):
        let_go()
        for batch in small_batches(batches, BATCH_ROWS):
            prints = [fingerprint(raw, words) for raw in columns_of(batch, "raw")[0]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["id", "print"],
            )

    return run


def _file(max_bits: int):
    def run(batches):
        let_go()
        for batch in batches:
            prints = batch.column("print").to_numpy(zero_copy_only=False)
            keys = file_keys(prints.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(prints, keys.shape[1]))],
                names=["file", "print"],
            )

    return run


def _group_links(max_bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["print"].to_numpy(np.int64).view(np.uint64)
        sides = rows["side"].to_numpy()
        if sides.any():
            found = spanning_links(prints[sides == 0], prints[sides == 1], max_bits)
        else:
            found = spanning_links(prints, None, max_bits)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _lists_links(max_bits: int):
    """Links within each row's list of fingerprints."""

    def run(batches):
        for batch in batches:
            found = []
            for prints in batch.column("prints"):
                values = prints.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found += spanning_links(values, None, max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links `(a, b)` that connect all of the distinct fingerprints within `max_bits`."""
    filed = prints.mapInArrow(_file(max_bits), "file bigint, print bigint")
    sizes = filed.groupBy("file").agg(F.count("*").alias("rows")).filter("rows > 1")
    sizes = cut(sizes, "simhash-sizes")
    shared = filed.join(sizes, "file")
    small = shared.filter(F.col("rows") <= FILE_ROWS)
    lists = small.groupBy("file").agg(F.collect_list("print").alias("prints")).select("prints")
    links = lists.mapInArrow(_lists_links(max_bits), "a bigint, b bigint")
    # Large files: each row goes to every pair of parts that holds its own part.
    parts = F.ceil(F.col("rows") / FILE_ROWS).cast("int")
    large = (
        shared.filter(F.col("rows") > FILE_ROWS)
        .withColumn("part", F.pmod(F.xxhash64("print"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "file",
            "print",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            (F.col("part") > F.col("other")).cast("int").alias("side"),
        )
    )
    apart = large.groupBy("file", "low", "high").applyInPandas(
        _group_links(max_bits), "a bigint, b bigint"
    )
    return links.union(apart).distinct()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """`(id, print)` per document, stored."""
    rows = id_and_bytes(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_fingerprints(words), f"id {kind}, print bigint")
    return cut(made, "simhash-prints")


def print_classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """`(print, root)`: fingerprints that links connect have the same root fingerprint."""
    distinct = cut(prints.select("print").distinct(), "simhash-distinct")
    nodes = connected_components(fingerprint_links(distinct, max_bits))
    placed = distinct.join(nodes.withColumnRenamed("node", "print"), "print", "left")
    return placed.select("print", F.coalesce("component", "print").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """`(id, fingerprint, component_id)` per document.

    Documents link when their fingerprints differ in at most `max_bits` bits; the component is
    the smallest id that can be reached over links. Null and empty texts have fingerprint zero
    and link like any other. Repeated documents give one row each. A null id is never the
    smallest unless all are null. Other columns are not read.
    """
    prints = fingerprints(docs, id_col, text_col, words)
    classes = cut(print_classes(prints, max_bits), "simhash-classes")
    least = prints.groupBy("print").agg(F.min("id").alias("id")).join(classes, "print")
    smallest = least.groupBy("root").agg(F.min("id").alias("component_id"))
    owners = cut(
        classes.join(smallest, "root").select("print", "component_id"), "simhash-components"
    )
    as_hex = F.lpad(F.lower(F.hex("print")), 16, "0")
    return prints.join(owners, "print").select(
        F.col("id").alias(id_col), as_hex.alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The documents, all columns, without those that link to one with a smaller id.

    One row of each component stays: that with the smallest id, null ids last, and of rows with
    equal ids that with the smallest hash of its text; of equal rows any one.
    """
    # The id and the text's hash tell rows apart; the fingerprint goes with the pair.
    key = F.struct(
        column(id_col).isNull().alias("no_id"),
        column(id_col).alias("own"),
        F.xxhash64(column(text_col)).alias("hash"),
    )
    keyed = docs.select(key.alias("key"), whole_row(docs).alias("row"))
    prints = fingerprints(keyed.select("key", F.col(f"row.`{text_col}`").alias("text")), "key", "text", words)
    classes = cut(print_classes(prints, max_bits), "simhash-classes")
    least = prints.groupBy("print").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    least = cut(least.join(classes, "print"), "simhash-least")
    first = least.groupBy("root").agg(F.min("id").alias("first"), F.count("*").alias("prints"))
    rows, distinct = least.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    owners = join_spread(least.select("root", "print", "n"), first, "root", distinct, "prints")
    owners = cut(owners.select("print", "n", "first"), "simhash-owners")
    # Only keys are joined and counted: those that lose, and those that come several times.
    apart = join_spread(prints, owners, "print", rows, "n").filter("id <> first")
    losers = cut(apart.select(F.col("id").alias("key")).distinct(), "simhash-losers")
    again = prints.groupBy(F.col("id").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    again = cut(again.select("key").join(losers, "key", "left_anti"), "simhash-again")
    kept = keyed.join(few_by_broadcast(losers), "key", "left_anti")
    if again.head(1):
        once = kept.join(few_by_broadcast(again), "key", "left_semi").dropDuplicates(["key"])
        kept = kept.join(few_by_broadcast(again), "key", "left_anti").unionByName(once)
    return kept.select("row.*")


def few_by_broadcast(keys: DataFrame) -> DataFrame:
    """A stored table of keys, to be broadcast if it has no more than `FEW_KEYS` rows.

    Beyond that Spark shuffles both sides of the join.
    """
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys

