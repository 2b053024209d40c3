"""Set similarity join on word n-grams by partitioning the universe of n-grams.

Two sets of r and s n-grams with a Jaccard similarity of p % differ in at most
(100 - p) (r + s) / (100 + p) elements. Sets are put in bands by size. For each band the universe
of n-grams is hashed into m segments, more than sets of that band and their partners may differ
in, so partners agree in the subset of some segment. Each set files the hash of its subset in
every segment of its own band (the index) and, as a larger partner, in those of the band below.

Which segments a set searches is allocated by cost. A segment searched for equal subsets counts
1; one searched for subsets that differ by one element at most, by way of one-deletion
neighbourhoods on both sides, counts 2. A set needs as many counts as it may have differences and
one more, and takes its cheapest: the cost of a segment is the number of sets filed under the
same subset, so those that many sets share (empty ones, common passages) are left out where
possible. How many segments of a band get neighbourhoods follows from the same costs, added up
over the band: they are filed only where that saves more than it adds.

Sets that share a searched file are candidates if sizes and parity sketches allow the similarity;
neither test loses a pair. Candidates are not emitted as pairs: each file gives a spanning forest,
and the n-grams of each candidate component are compared exactly, by text, in tasks of bounded
size. Only pairs that no chain of links connects yet are compared.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm import common
from termtide.llm.common import HOT_KEYS, columns_of, cut, id_and_bytes, small_batches
from termtide.llm.components import connected_components

SHINGLE_WORDS = 3
PERCENT = 90
BAND_RATIO = 1.5
# Segments of a band that may have neighbourhoods. Below 7, see `_FEW`.
MOST_NEIGHBOURHOODS = 4
# Cost of filing a subset, where finding one set in a file costs 1.
FILING_COST = 1.0
# Files above this size are linked as stars instead of by sketches; links are verified anyway.
FILE_ROWS = 512
# Rows and bytes of text that a task compares at once.
PART_ROWS = 1_024
PART_BYTES = 8 << 20
LEADERS = 8
SKETCH_WORDS = 4
BATCH_ROWS = 500
# So many n-grams can be numbered by the numbers of their words.
MOST_CODES = 1 << 62

# A filing is written node * 16 + lower * 8 + few, where `few` is the segment up to 6 and else 7.
_FEW = 7


def shingles(raw: bytes, words: int) -> set[bytes]:
    """Distinct n-grams of a text of words joined by spaces; the whole text if it has fewer."""
    tokens = raw.split(b" ")
    if len(tokens) <= words:
        return {raw}
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = [0, *ends[:-words].tolist()]
    return {raw[a : b - 1] for a, b in zip(starts, ends[words - 1 :].tolist())}


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


class Bands:
    """Size bands, their segments, and how many elements partners may differ in."""

    def __init__(self, percent: int = PERCENT, ratio: float = BAND_RATIO):
        if not 0 < percent <= 100:
            raise ValueError("percent must be over 0 and at most 100")
        self.percent = percent
        # A partner is at most one band below.
        self.ratio = max(ratio, 100 / percent)
        self.edges = [1]

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            low = self.edges[-1]
            self.edges.append(max(low + 1, math.ceil(low * self.ratio)))
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def largest(self, band: int) -> int:
        while len(self.edges) <= band + 1:
            self.band(self.edges[-1])
        return self.edges[band + 1] - 1

    def differences(self, size: int, other: int) -> int:
        return (100 - self.percent) * (size + other) // (100 + self.percent)

    def segments(self, band: int) -> int:
        largest = self.largest(band)
        return self.differences(largest, largest * 100 // self.percent) + 1

    def lower(self, size: int) -> int | None:
        """The band below, if it can hold partners."""
        band = self.band(size)
        if band and 100 * self.largest(band - 1) >= self.percent * size:
            return band - 1
        return None

    def needed(self, size: int, lower: bool) -> int:
        """Counts that a search among sets up to the own size, or in the band below, must reach."""
        other = self.largest(self.band(size) - 1) if lower else size
        return self.differences(size, other) + 1


def _segments_of(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(count)).astype(np.int64)


@functools.lru_cache(1_024)
def _all_seeds(band: int, count: int) -> np.ndarray:
    return _seeds(band, np.arange(count))


def _seeds(band: int, segments: np.ndarray) -> np.ndarray:
    return _mix(np.uint64(band << 32) + segments.astype(np.uint64) + np.uint64(1))


def subset_keys(hashes: np.ndarray, band: int, count: int, mixed: np.ndarray | None = None) -> np.ndarray:
    """The key of the subset in each segment. It is a sum, so one element less is a difference.

    `mixed` is `_mix(hashes)` where that is known.
    """
    place = _segments_of(hashes, count)
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, place, _mix(hashes) if mixed is None else mixed)
    return _mix(sums ^ _all_seeds(band, count)).view(np.int64)


def deletion_keys(hashes: np.ndarray, band: int, count: int, few: int) -> np.ndarray:
    """Keys of the subsets that lack one element, in the first `few` segments."""
    place = _segments_of(hashes, count)
    mixed = _mix(hashes)
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, place, mixed)
    chosen = place < few
    with np.errstate(over="ignore"):
        left = sums[place[chosen]] - mixed[chosen]
    return np.unique(_mix(left ^ _seeds(band, place[chosen])).view(np.int64))


def sketch_of(hashes: np.ndarray) -> bytes:
    """Parity of the elements at each of 256 places; sets differ in at least as many elements."""
    odd = np.bincount((hashes & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _digests(pieces: pa.Array) -> np.ndarray:
    """A hash of each of some byte strings."""
    if not len(pieces):
        return np.empty(0, np.uint64)
    _, ends, data = pieces.buffers()
    kind = np.int64 if pa.types.is_large_binary(pieces.type) else np.int32
    ends = np.frombuffer(ends, kind)[pieces.offset : pieces.offset + len(pieces) + 1].tolist()
    raw = data.to_pybytes() if data else b""
    made = map(xxhash.xxh64_intdigest, [raw[a:b] for a, b in zip(ends, ends[1:])])
    return np.fromiter(made, np.uint64, len(pieces))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted and without repeats; short arrays take a third of the time `np.unique` does."""
    values = np.sort(values)
    first = np.empty(len(values), bool)
    first[:1] = True
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def gram_hashes(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the number of its distinct n-grams, and their distinct hashes.

    N-grams are told apart by the numbers of their words, so the count is exact, and no n-gram is
    cut out as bytes. Equal hashes merge, which only adds candidates. A text of fewer words has one
    n-gram, itself.
    """
    pieces = pc.split_pattern(texts, " ")
    counts = pc.list_value_length(pieces).to_numpy().tolist()
    coded = pieces.flatten().dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    known = len(coded.dictionary)
    digests = _digests(coded.dictionary)
    starts = max(len(numbers) - words + 1, 0)
    hashes, codes = digests[numbers[:starts]], numbers[:starts]
    numbered = known**words <= MOST_CODES
    for k in range(1, words):
        word = numbers[k : starts + k]
        hashes = _mix(hashes) + digests[word]
        if numbered:
            codes = codes * known + word
    hashes = _mix(hashes)
    first = 0
    for place, count in enumerate(counts):
        if count < words:
            yield 1, np.array([xxhash.xxh64_intdigest(texts[place].as_py())], np.uint64)
        else:
            last = first + count - words + 1
            own = _distinct(hashes[first:last])
            size = len(own)
            # Hashes that all differ are of n-grams that do.
            if size < last - first:
                size = len(_distinct(codes[first:last]) if numbered else shingles(texts[place].as_py(), words))
            yield size, own
        first += count


# ---------------------------------------------------------------- documents and their classes


def _joined_words(raw: bytes | None) -> bytes | None:
    """Words joined by spaces, A-Z lower-cased; None if there are none."""
    tokens = (raw or b"").lower().split()
    return b" ".join(tokens) if tokens else None


def _keyed(keep_text: bool):
    def run(batches):
        for batch in small_batches(batches, BATCH_ROWS):
            texts = [_joined_words(raw) for raw in columns_of(batch, "raw")[0]]
            keys = [t and hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            arrays = [batch.column("id"), pa.array(keys, pa.binary())]
            if keep_text:
                arrays.append(pa.array(texts, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "key", "text"][: len(arrays)])

    return run


def _signed(words: int, percent: int):
    """Size, sketch and subset keys of each text."""

    def run(batches):
        bands = Bands(percent)
        for batch in small_batches(batches, BATCH_ROWS):
            sizes, sketches, own, low = [], [], [], []
            for size, hashes in gram_hashes(batch.column("text"), words):
                band, below = bands.band(size), bands.lower(size)
                sizes.append(size)
                sketches.append(sketch_of(hashes))
                mixed = _mix(hashes)
                own.append(subset_keys(hashes, band, bands.segments(band), mixed))
                low.append([] if below is None else subset_keys(hashes, below, bands.segments(below), mixed))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("key", "id", "copies", "text")],
                    pa.array(sizes, pa.int64()),
                    pa.array(sketches, pa.binary()),
                    pa.array(own, pa.list_(pa.int64())),
                    pa.array(low, pa.list_(pa.int64())),
                ],
                names=["key", "id", "copies", "text", "size", "sketch", "own", "low"],
            )

    return run


def join_spread(rows: DataFrame, table: DataFrame, on: str, total: int, count: str) -> DataFrame:
    return common.join_spread(rows, table, on, total, count, HOT_KEYS, FILE_ROWS)


def representatives(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per distinct sequence of words, stored under a number `node`."""
    kind = docs.schema["id"].dataType.simpleString()
    keyed = docs.mapInArrow(_keyed(True), f"id {kind}, key binary, text binary")
    classes = keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("text").alias("text")
    )
    signed = classes.select("key", "id", "copies", "text").mapInArrow(
        _signed(words, percent),
        f"key binary, id {kind}, copies bigint, text binary, size bigint, sketch binary, "
        "own array<bigint>, low array<bigint>",
    )
    return cut(signed.withColumn("node", F.monotonically_increasing_id()), "jaccard-sets")


# ---------------------------------------------------------------- files and their candidates


def _filings(sets: DataFrame) -> DataFrame:
    """`(key, filing)`: every subset of the own band and of the band below."""
    parts = []
    for lower, column in ((0, "own"), (1, "low")):
        rows = sets.select("node", F.posexplode(column).alias("pos", "key"))
        few = F.least("pos", F.lit(_FEW))
        parts.append(rows.select("key", (F.col("node") * 16 + lower * 8 + few).alias("filing")))
    return parts[0].unionAll(parts[1])


def _is_index(filing: str) -> Column:
    return F.col(filing).bitwiseAND(F.lit(8)) == 0


def _shared(filings: DataFrame, label: str, wanted: str = "true") -> tuple[DataFrame, int]:
    """Keys of files with two rows or more, one of them in the index: `(key, found, leader)`.

    One row must also be `wanted`.
    """
    index_node = F.min(F.when(_is_index("filing"), F.shiftright("filing", 4)))
    sizes = filings.groupBy("key").agg(
        F.count("*").alias("found"),
        index_node.alias("leader"),
        F.bool_or(F.expr(wanted)).alias("wanted"),
    )
    sizes = sizes.filter("found > 1 AND leader IS NOT NULL AND wanted").drop("wanted")
    stored = cut(sizes, label)
    return stored, stored.agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0]


def _spared(found: np.ndarray, few: np.ndarray, reserve: int, segments: int, needed: int) -> np.ndarray:
    """Which of a set's shared files it need not search.

    `reserve` segments are searched with neighbourhoods and count 2. Of the others, which count
    1, the cheapest are searched; those without other sets cost nothing and come first.
    """
    plain = np.nonzero(few >= reserve)[0]
    unused = max(0, (segments - reserve) - max(0, needed - 2 * reserve))
    dear = plain[np.argsort(-found[plain], kind="stable")[:unused]]
    spared = np.zeros(len(found), bool)
    spared[dear] = True
    return spared


def _hit_rows(batch: pa.RecordBatch, bands: Bands) -> Iterator[tuple]:
    names = ("node", "lower", "size", "hits")
    for node, lower, size, hits in zip(*columns_of(batch, *names)):
        found = np.array([h["found"] for h in hits], np.int64)
        few = np.array([h["few"] for h in hits], np.int64)
        band = bands.band(size) - lower
        yield node, lower, size, hits, found, few, band


def _costs(percent: int):
    """By band and number of segments with neighbourhoods: sets found, and filings added."""

    def run(batches):
        bands, total = Bands(percent), {}
        for batch in batches:
            for _, lower, size, _, found, few, band in _hit_rows(batch, bands):
                segments, needed = bands.segments(band), bands.needed(size, bool(lower))
                for reserve in range(min(MOST_NEIGHBOURHOODS, segments) + 1):
                    spared = _spared(found, few, reserve, segments, needed)
                    key = (band, reserve)
                    total[key] = total.get(key, 0.0) + float(found[~spared].sum() - (~spared).sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in total], pa.int32()),
                pa.array([k[1] for k in total], pa.int32()),
                pa.array(list(total.values()), pa.float64()),
            ],
            names=["band", "reserve", "cost"],
        )

    return run


def _sizes_by_band(percent: int):
    def run(batches):
        bands, total = Bands(percent), {}
        for batch in batches:
            for size in columns_of(batch, "size")[0]:
                for band in {bands.band(size), bands.lower(size)} - {None}:
                    before = total.get(band, 0.0)
                    total[band] = before + 1 + 2 * size / bands.segments(band)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64())],
            names=["band", "filings"],
        )

    return run


def neighbourhoods(hits: DataFrame, sets: DataFrame, percent: int) -> dict[int, int]:
    """For each band the number of segments with neighbourhoods that makes searches cheapest.

    The driver gets some rows per band; bands grow with the logarithm of the largest set.
    """
    costs = hits.mapInArrow(_costs(percent), "band int, reserve int, cost double")
    filed = sets.select("size").mapInArrow(_sizes_by_band(percent), "band int, filings double")
    filed = {r.band: r.f for r in filed.groupBy("band").agg(F.sum("filings").alias("f")).collect()}
    by_band: dict[int, dict[int, float]] = {}
    for row in costs.groupBy("band", "reserve").agg(F.sum("cost").alias("cost")).collect():
        by_band.setdefault(row.band, {})[row.reserve] = row.cost
    chosen = {}
    for band, cost in by_band.items():
        for reserve in cost:
            cost[reserve] += FILING_COST * reserve * filed.get(band, 0.0)
        chosen[band] = min(cost, key=lambda reserve: (cost[reserve], reserve))
    return {band: reserve for band, reserve in chosen.items() if reserve}


def _asked(percent: int, reserves: dict[int, int]):
    """A row for each file that a set searches or is to be found in."""

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            sketches = columns_of(batch, "sketch")[0]
            rows = []
            for sketch, (node, lower, size, hits, found, few, band) in zip(
                sketches, _hit_rows(batch, bands)
            ):
                segments, needed = bands.segments(band), bands.needed(size, bool(lower))
                reserve = min(reserves.get(band, 0), segments)
                spared = _spared(found, few, reserve, segments, needed).tolist()
                for hit, skip in zip(hits, spared):
                    if not (lower and skip):
                        rows.append((hit["key"], hit["found"], node, size, sketch, not skip, not lower))
            yield _file_batch(rows)

    return run


FILE_SCHEMA = pa.schema(
    [
        ("key", pa.int64()),
        ("found", pa.int64()),
        ("node", pa.int64()),
        ("size", pa.int64()),
        ("sketch", pa.binary()),
        ("asks", pa.bool_()),
        ("answers", pa.bool_()),
    ]
)
_FILE = "key bigint, found bigint, node bigint, size bigint, sketch binary, asks boolean, answers boolean"


def _file_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in FILE_SCHEMA]
    arrays = [pa.array(c, t) for c, t in zip(columns, FILE_SCHEMA.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=FILE_SCHEMA)


def _neighbour_filings(percent: int, reserves: dict[int, int], words: int):
    """Subsets and one-deletion subsets in the segments that have neighbourhoods.

    `asks` tells the former. Each is filed once as own and once as lower band.
    """

    def run(batches):
        bands = Bands(percent)
        for batch in small_batches(batches, BATCH_ROWS):
            rows, chosen = [], []
            sizes = columns_of(batch, "size")[0]
            for place, size in enumerate(sizes):
                places = {bands.band(size): 0, bands.lower(size): 1}
                wanted = {b: lower for b, lower in places.items() if reserves.get(b)}
                if wanted:
                    chosen.append((place, wanted))
            batch = batch.take(pa.array([place for place, _ in chosen], pa.int64()))
            made = gram_hashes(batch.column("text"), words)
            found = zip(*columns_of(batch, "node", "size", "sketch"), chosen, made)
            for node, size, sketch, (_, wanted), (_, hashes) in found:
                for band, lower in wanted.items():
                    count = bands.segments(band)
                    few = min(reserves[band], count)
                    full = subset_keys(hashes, band, count)[:few].tolist()
                    gone = deletion_keys(hashes, band, count, few).tolist()
                    for keys, whole in ((full, True), (gone, False)):
                        rows += [(k, node * 16 + lower * 8, size, sketch, whole) for k in keys]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["key", "filing", "size", "sketch", "asks"],
            )

    return run


class _Forest:
    """Labels of connected rows; joining relabels the rows of one side."""

    def __init__(self, size: int):
        self.labels = np.arange(size)

    def join(self, a: int, b: int) -> None:
        self.labels[self.labels == self.labels[b]] = self.labels[a]


def _may_link(sizes: np.ndarray, sketches: np.ndarray, i: int, percent: int) -> np.ndarray:
    """Rows whose size and sketch allow a link with row i."""
    least, most = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
    ok = 100 * least >= percent * most
    apart = np.bitwise_count(sketches ^ sketches[i]).sum(axis=1, dtype=np.int64)
    return ok & (apart <= (100 - percent) * (sizes + sizes[i]) // (100 + percent))


def _sketch_matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(-1, SKETCH_WORDS)


def _list_links(percent: int, across: bool):
    """Spanning forests of the candidates in each file.

    A candidate pair has one row that asks and another that answers. In files of neighbourhoods
    (`across`) `asks` tells whole subsets, and a pair needs one whole and one lacking an element.
    """

    def run(batches):
        for batch in batches:
            found = []
            for members in columns_of(batch, "members")[0]:
                nodes = [m["node"] for m in members]
                sizes = np.array([m["size"] for m in members], np.int64)
                sketches = _sketch_matrix([m["sketch"] for m in members])
                asks = np.array([m["asks"] for m in members], bool)
                answers = np.array([m["answers"] for m in members], bool)
                forest = _Forest(len(nodes))
                for i in range(len(nodes) - 1):
                    apart = forest.labels != forest.labels[i]
                    apart[: i + 1] = False
                    if not apart.any():
                        continue
                    if across:
                        ok = (asks != asks[i]) & (answers | answers[i])
                    else:
                        ok = (asks & answers[i]) | (answers & asks[i])
                    ok &= apart & _may_link(sizes, sketches, i, percent)
                    for j in np.nonzero(ok)[0].tolist():
                        if forest.labels[i] != forest.labels[j]:
                            forest.join(i, j)
                            found.append((nodes[i], nodes[j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def _file_links(rows: DataFrame, leaders: DataFrame, total: int, percent: int, across: bool) -> DataFrame:
    """Candidate links of all files, few enough that no file gives more than it has rows."""
    member = F.struct("node", "size", "sketch", "asks", "answers")
    small = rows.filter(F.col("found") <= FILE_ROWS)
    lists = small.groupBy("key").agg(
        F.collect_list(member).alias("members"), F.bool_or("asks").alias("asked")
    )
    lists = lists.filter("asked AND size(members) > 1").select("members")
    links = lists.mapInArrow(_list_links(percent, across), "a bigint, b bigint")
    large = rows.filter(F.col("found") > FILE_ROWS).select("key", F.col("node").alias("a"))
    large_leaders = leaders.filter(F.col("found") > FILE_ROWS)
    stars = join_spread(large, large_leaders, "key", total, "found")
    return links.unionAll(stars.select("a", F.col("leader").alias("b")).filter("a <> b"))


def candidate_links(sets: DataFrame, words: int, percent: int) -> DataFrame:
    """Links `(a, b)` between nodes that connect every pair of similar sets; some come repeatedly."""
    filings = _filings(sets)
    shared, total = _shared(filings, "jaccard-files")
    hits = join_spread(filings, shared.drop("leader"), "key", total, "found")
    # At most a row per segment of a set, so lists are as long as the set allows.
    hit = F.struct("key", "found", F.col("filing").bitwiseAND(F.lit(7)).alias("few"))
    hits = hits.groupBy(F.shiftright("filing", 3).alias("asking")).agg(F.collect_list(hit).alias("hits"))
    hits = hits.select(
        F.shiftright("asking", 1).alias("node"),
        F.col("asking").bitwiseAND(F.lit(1)).cast("int").alias("lower"),
        "hits",
    )
    hits = cut(hits.join(sets.select("node", "size", "sketch"), "node"), "jaccard-hits")
    reserves = neighbourhoods(hits, sets, percent)
    rows = hits.mapInArrow(_asked(percent, reserves), _FILE)
    links = _file_links(rows, shared, total, percent, False)
    if reserves:
        near = sets.select("node", "size", "sketch", "text").mapInArrow(
            _neighbour_filings(percent, reserves, words),
            "key bigint, filing bigint, size bigint, sketch binary, asks boolean",
        )
        # Files without a whole subset have no pair that differs by one element.
        own, own_total = _shared(near.select("key", "filing", "asks"), "jaccard-near", "asks")
        rows = join_spread(near, own.drop("leader"), "key", own_total, "found").select(
            "key",
            "found",
            F.shiftright("filing", 4).alias("node"),
            "size",
            "sketch",
            "asks",
            _is_index("filing").alias("answers"),
        )
        links = links.unionAll(_file_links(rows, own, own_total, percent, True))
    return links


# ---------------------------------------------------------------- exact comparison


class _Sets:
    """N-gram sets of the rows of a group, made when first needed, as numbers given in the group."""

    def __init__(self, texts: list[bytes], words: int):
        self.texts, self.words = texts, words
        self.numbers: dict[bytes, int] = {}
        self.made: dict[int, frozenset[int]] = {}

    def __getitem__(self, i: int) -> frozenset[int]:
        if i not in self.made:
            numbers = self.numbers
            grams = shingles(self.texts[i], self.words)
            self.made[i] = frozenset([numbers.setdefault(g, len(numbers)) for g in grams])
        return self.made[i]

    def link(self, i: int, j: int, percent: int) -> bool:
        common = len(self[i] & self[j])
        return 100 * common >= percent * (len(self[i]) + len(self[j]) - common)


def exact_links(
    nodes: list[int],
    sizes: np.ndarray,
    sketches: np.ndarray,
    texts: list[bytes],
    groups: np.ndarray,
    words: int,
    percent: int,
) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of equal `groups`; others are not compared."""
    sets, forest, found = _Sets(texts, words), _Forest(len(nodes)), []
    for i in range(len(nodes)):
        ok = (groups == groups[i]) & (forest.labels != forest.labels[i])
        ok[: i + 1] = False
        if not ok.any():
            continue
        ok &= _may_link(sizes, sketches, i, percent)
        for j in np.nonzero(ok)[0].tolist():
            if forest.labels[i] != forest.labels[j] and sets.link(i, j, percent):
                forest.join(i, j)
                found.append((nodes[i], nodes[j]))
    return found


def _links_table(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({name: pa.array([x[k] for x in found], pa.int64()) for k, name in enumerate("ab")})


def _compare(words: int, percent: int):
    """Links within the components, or within the part and with the leaders, of a group."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rank", "ascending"), ("node", "ascending")])
        nodes = table.column("node").to_pylist()
        found = exact_links(
            nodes,
            table.column("size").to_numpy(),
            _sketch_matrix(table.column("sketch").to_pylist()),
            table.column("text").to_pylist(),
            table.column("component").to_numpy(),
            words,
            percent,
        )
        return _links_table(found)

    return run


def _label_pairs(sides: np.ndarray, labels: np.ndarray, i: int) -> np.ndarray:
    """Rows to compare with row i: of another label, and of the other side if there are two."""
    ok = labels != labels[i]
    if sides.any():
        ok &= sides != sides[i]
    ok[: i + 1] = False
    return ok


def _meeting(percent: int):
    """The rows of a pair of parts that size and sketch allow a link with one of another label."""

    def run(table: pa.Table) -> pa.Table:
        sides = table.column("side").to_numpy()
        labels = table.column("label").to_numpy()
        sizes = table.column("size").to_numpy()
        sketches = _sketch_matrix(table.column("sketch").to_pylist())
        meets = np.zeros(len(sides), bool)
        for i in range(len(sides)):
            ok = _label_pairs(sides, labels, i)
            if ok.any():
                ok &= _may_link(sizes, sketches, i, percent)
                meets |= ok
                meets[i] |= ok.any()
        kept = table.select(["first", "second", "component", "side", "label", "node", "size", "sketch"])
        return kept.filter(pa.array(meets))

    return run


def _compare_across(words: int, percent: int):
    """Links between labels in a pair of parts."""

    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        sides, labels = table.column("side").to_numpy(), table.column("label").to_numpy()
        sizes = table.column("size").to_numpy()
        sketches = _sketch_matrix(table.column("sketch").to_pylist())
        sets, joined, found = _Sets(table.column("text").to_pylist(), words), labels.copy(), []
        for i in range(len(nodes)):
            ok = _label_pairs(sides, labels, i) & (joined != joined[i])
            if not ok.any():
                continue
            ok &= _may_link(sizes, sketches, i, percent)
            for j in np.nonzero(ok)[0].tolist():
                if joined[i] != joined[j] and sets.link(i, j, percent):
                    joined[joined == joined[j]] = joined[i]
                    found.append((nodes[i], nodes[j]))
        return _links_table(found)

    return run


_LINK = "a bigint, b bigint"


def verified_links(sets: DataFrame, placed: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that hold exactly and connect all similar sets of each candidate component."""
    columns = ["node", "size", "sketch", "text"]
    members = placed.join(sets.select(*columns), "node")
    members = cut(members.select("component", *columns), "jaccard-members")
    sizes = members.groupBy("component").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")
    )
    parts = F.greatest(F.ceil(F.col("rows") / PART_ROWS), F.ceil(F.col("bytes") / PART_BYTES))
    sizes = cut(sizes.withColumn("parts", parts.cast("int")), "jaccard-sizes")
    rows, volume = sizes.agg(F.sum("rows"), F.sum("bytes")).first()
    if not rows:
        return sets.sparkSession.createDataFrame([], _LINK)
    sized = join_spread(members, sizes.select("component", "rows", "parts"), "component", rows, "rows")
    # Whole components of one part share a task with others up to about a part's size.
    packs = max(1, math.ceil(volume / PART_BYTES), math.ceil(rows / PART_ROWS))
    whole = sized.filter("parts = 1").withColumn("rank", F.lit(0))
    whole = whole.withColumn("pack", F.pmod(F.xxhash64("component"), F.lit(packs)))
    links = whole.groupBy("pack").applyInArrow(_compare(words, percent), _LINK)
    if not sizes.filter("parts > 1").head(1):
        return links
    large = sized.filter("parts > 1").drop("rows")
    first = cut(_links_to_leaders(large, sizes, sets, words, percent), "jaccard-first")
    # Stars join what these links join, and leave later rounds of components less to do.
    labelled = connected_components(first)
    stars = labelled.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return links.unionAll(stars).unionAll(_links_between(large, labelled, words, percent))


def _links_to_leaders(
    large: DataFrame, sizes: DataFrame, sets: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links within each part of a large component, and with a few rows that all parts get.

    Most rows of a group of near copies link to one of those, so what remains is little.
    """
    least = [
        F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"l{k}") for k in range(LEADERS)
    ]
    leaders = large.groupBy("component").agg(*least)
    leaders = leaders.select(
        "component", F.explode(F.array_distinct(F.array([f"l{k}" for k in range(LEADERS)]))).alias("node")
    )
    leaders = leaders.join(sets.select("node", "size", "sketch", "text"), "node")
    leaders = leaders.join(sizes.select("component", "parts"), "component").select(
        "component",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "node",
        "size",
        "sketch",
        "text",
        F.lit(0).alias("rank"),
    )
    own = large.select(
        "component",
        F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
        "node",
        "size",
        "sketch",
        "text",
        F.lit(1).alias("rank"),
    )
    # A leader is in its own part as a member too; equal rows link at once.
    both = own.unionByName(leaders)
    return both.groupBy("component", "part").applyInArrow(_compare(words, percent), _LINK).filter("a <> b")


def _links_between(large: DataFrame, labelled: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between rows of a large component that the first links do not connect.

    Rows are put in parts anew: those of a large label in parts of their own, which are not
    compared with one another, the rest in mixed parts. Pairs of parts compare sketches first,
    and only rows that meet another there are sent with their texts.
    """
    slim = large.select("component", "node", "size", "sketch")
    slim = slim.join(labelled.select("node", F.col("component").alias("label")), "node", "left")
    slim = cut(slim.withColumn("label", F.coalesce("label", "node")), "jaccard-labels")
    counts = slim.groupBy("component", "label").agg(F.count("*").alias("n"))
    counts = cut(counts, "jaccard-label-sizes")
    several = counts.groupBy("component").agg(
        F.count("*").alias("labels"),
        F.sum(F.when(F.col("n") < PART_ROWS // 2, F.col("n")).otherwise(0)).alias("mixed"),
    )
    several = several.filter("labels > 1")
    counts = counts.join(several.select("component", "mixed"), "component")
    pure = F.col("n") >= PART_ROWS // 2
    counts = counts.select(
        "component",
        "label",
        "n",
        F.when(pure, F.col("label")).otherwise(F.lit(-1)).alias("tag"),
        F.ceil(F.when(pure, F.col("n")).otherwise(F.col("mixed")) / PART_ROWS).alias("of"),
    )
    total = slim.count()
    placed = join_spread(slim, counts.drop("component"), "label", total, "n")
    spread = F.when(F.col("tag") == -1, F.xxhash64("label")).otherwise(F.xxhash64("node"))
    placed = placed.withColumn("part", F.pmod(spread, F.col("of"))).drop("n", "of")
    # Labels are unique to a component, so tags and parts name a part together with it.
    parts = counts.select("component", "tag", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("part"))
    parts = parts.distinct().withColumn("own", F.xxhash64("component", "tag", "part"))
    parts = cut(parts, "jaccard-parts")
    placed = placed.withColumn("own", F.xxhash64("component", "tag", "part")).drop("tag", "part")
    left = parts.select("component", F.col("own").alias("first"), F.col("tag").alias("t1"))
    right = parts.select("component", F.col("own").alias("second"), F.col("tag").alias("t2"))
    pairs = left.join(right, "component").filter(
        "first < second AND (t1 <> t2 OR t1 = -1) OR first = second AND t1 = -1"
    )
    pairs = cut(pairs.select("first", "second"), "jaccard-pairs")
    one = placed.join(pairs, placed["own"] == pairs["first"]).withColumn("side", F.lit(0))
    two = placed.join(pairs.filter("first <> second"), placed["own"] == F.col("second"))
    both = one.unionByName(two.withColumn("side", F.lit(1)))
    names = ["first", "second", "component", "side", "label", "node", "size", "sketch"]
    schema = (
        "first bigint, second bigint, component bigint, side int, label bigint, node bigint, "
        "size bigint, sketch binary"
    )
    meeting = both.select(*names).groupBy("first", "second").applyInArrow(_meeting(percent), schema)
    meeting = cut(meeting, "jaccard-meeting")
    texts = large.select("node", "text")
    return (
        meeting.join(texts, "node")
        .groupBy("first", "second")
        .applyInArrow(_compare_across(words, percent), _LINK)
    )


# ---------------------------------------------------------------- the join


def similar_sets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """`(id, n_shingles, component_id)` per document.

    Documents link when their sets of word n-grams have a Jaccard similarity of `percent` or
    more; the component is the smallest id that links reach. A text of fewer words is one n-gram
    as a whole. Null texts and texts without words have empty sets and link with nothing, not
    even each other. Repeated rows and ids give a row each, and equal texts are linked. Null ids
    are never the smallest unless all ids of a component are null. Other columns are not read.
    """
    rows = id_and_bytes(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    sets = representatives(rows, words, percent)
    links = candidate_links(sets, words, percent)
    placed = cut(connected_components(links), "jaccard-candidates")
    linked = connected_components(verified_links(sets, placed, words, percent))
    # Roots of nodes that link to others; all others are roots themselves.
    owned = sets.select("node", "key", "id", "copies", "size").join(linked, "node", "left")
    owned = cut(
        owned.select("key", "id", "copies", "size", F.coalesce("component", "node").alias("root")),
        "jaccard-owners",
    )
    per_root = owned.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    count, total = owned.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    owned = join_spread(owned.drop("id"), per_root, "root", count, "n").drop("n", "root")
    keyed = rows.mapInArrow(_keyed(False), f"id {kind}, key binary")
    empty = keyed.filter(F.col("key").isNull()).select(
        F.col("id"), F.lit(0).cast("bigint").alias("size"), F.col("id").alias("component_id")
    )
    found = join_spread(keyed.filter(F.col("key").isNotNull()), owned, "key", total, "copies")
    return found.select("id", "size", "component_id").unionAll(empty).select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id"
    )
