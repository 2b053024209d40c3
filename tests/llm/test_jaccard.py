"""The n-gram join against brute force, on every path, and the lemmas it rests on."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termtide.llm import jaccard
from termtide.llm.queries import op12_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string"


def brute_set(text, size=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, percent=90):
    sets = [brute_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids, default=None)
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rnd.randrange(len(words))
        change = rnd.randrange(3)
        if change == 0:
            words[at] = f"e{rnd.randrange(50)}"
        elif change == 1:
            del words[at]
        else:
            words.insert(at, f"e{rnd.randrange(50)}")
    return words


def near_texts(seed=1, families=12):
    """Families of texts on both sides of the threshold, chains of edits, and short texts."""
    rnd = random.Random(seed)
    made = []
    for family in range(families):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([4, 9, 20, 40, 80, 150, 300]))]
        made.append(base)
        last = base
        for _ in range(rnd.randrange(1, 12)):
            made.append(edited(rnd, base, rnd.randrange(0, 1 + len(base) // 25 + 1)))
            last = edited(rnd, last, rnd.randrange(0, 1 + len(base) // 40 + 1))
            made.append(last)
    # Texts that share most of their words and little else.
    shared = [f"s{i}" for i in range(60)]
    for i in range(20):
        made.append(shared + [f"own{i}x{j}" for j in range(rnd.randrange(3, 14))])
    rnd.shuffle(made)
    return [" ".join(words) for words in made]


def odd_rows():
    texts = near_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "Just this"), (1004, "just\tTHIS")]
    rows += [(1005, "one"), (1006, "a b c"), (1007, "a b c a b c a b c"), (None, texts[0])]
    rows += [(None, "only null here now"), (None, "only null  here now"), (5, texts[5]), (5, texts[5])]
    rows += [(1008, "long " * 30_000), (1009, "long " * 20_000 + "end"), (1010, "É é x y")]
    rows += [(1011, " ".join(f"n{i}" for i in range(9_000)))]
    rows += [(1012, " ".join(f"n{i}" for i in range(9_400)))]
    rows += [(1013, " ".join(f"n{i}" for i in range(10_500)))]
    return rows


def null_last(row):
    return [(x is None, x or 0) for x in row]


def same(got, want):
    assert sorted(map(null_last, map(tuple, got))) == sorted(map(null_last, want))


@pytest.fixture(scope="module")
def odd(spark):
    table = spark.createDataFrame([(i, t, "en") for i, t in odd_rows()], DOCS).repartition(3)
    for name in ("id", "raw", "key", "node", "size", "component_id", "n_shingles", "copies"):
        table = table.withColumn(name, F.lit("clash"))
    return table


PATHS = {
    "usual": {},
    "stars": {"FILE_ROWS": 2},
    "hot": {"FILE_ROWS": 2, "HOT_KEYS": 2_000},
    "neighbourhoods": {"FILING_COST": -1e9},
    "neighbourhoods in stars": {"FILING_COST": -1e9, "FILE_ROWS": 2},
    "parts": {"PART_ROWS": 4, "FILE_ROWS": 1, "LEADERS": 1},
    "bytes": {"PART_BYTES": 2_000},
}


@pytest.mark.parametrize("path", PATHS)
def test_similar_sets(odd, monkeypatch, path):
    for name, value in PATHS[path].items():
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.similar_sets(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    same(got.collect(), brute_components(odd_rows()))


@pytest.mark.parametrize("percent", [100, 75, 50])
def test_other_similarities(spark, percent):
    rows = [(i, t) for i, t in enumerate(near_texts(seed=percent, families=8))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(jaccard.similar_sets(table, percent=percent).collect(), brute_components(rows, percent))


def test_one_group_of_near_copies(spark, monkeypatch):
    """Many texts that differ in a word each, in several parts, beside others just too far."""
    monkeypatch.setattr(jaccard, "PART_ROWS", 40)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 120] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows.append((350, " ".join(base)))
    for i in range(100):
        words = list(base)
        for at in range(5 + i % 20, 120, 60 if i % 2 else 40):
            words[at] = f"y{i}x{at}"
        rows.append((400 + i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = jaccard.similar_sets(table).collect()
    want = brute_components(rows)
    same(got, want)
    assert len({c for _, _, c in want}) == 51


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], DOCS)
    assert jaccard.similar_sets(nothing).count() == 0
    blank = spark.createDataFrame([(2, None, None), (1, "", None), (None, " ", "x")], DOCS)
    same(jaccard.similar_sets(blank).collect(), [(2, 0, 2), (1, 0, 1), (None, 0, None)])


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_jaccard_join(spark, small).collect()
    same(got, brute_components(rows))
    assert max(Counter(r.component_id for r in got).values()) > 1


def test_partners_share_a_searched_segment():
    """Whatever a set leaves out, a partner agrees with it in a segment that it searches."""
    rnd = random.Random(9)
    bands = jaccard.Bands()
    for _ in range(400):
        size = rnd.randrange(1, 200)
        elements = rnd.sample(range(10**6), size + 60)
        most = bands.differences(size, size * 100 // 90)
        changed = rnd.randrange(0, most + 1)
        gone = rnd.randrange(0, min(changed, size) + 1)
        one, two = set(elements[:size]), set(elements[gone : size + changed - gone])
        common = len(one & two)
        if not two or 100 * common < 90 * len(one | two):
            continue
        large, less = (one, two) if len(one) >= len(two) else (two, one)
        lower = bands.band(len(large)) != bands.band(len(less))
        band = bands.band(len(less))
        assert bands.band(len(large)) - band in (0, 1)
        if lower:
            assert bands.lower(len(large)) == band
        count, needed = bands.segments(band), bands.needed(len(large), lower)
        assert needed <= count
        hashes = [jaccard._mix(np.array(sorted(s), np.uint64)) for s in (large, less)]
        keys = [jaccard.subset_keys(h, band, count) for h in hashes]
        found = np.array([rnd.randrange(2, 100) for _ in range(count)])
        places = np.minimum(np.arange(count), jaccard._FEW)
        for reserve in range(min(jaccard.MOST_NEIGHBOURHOODS, count) + 1):
            spared = jaccard._spared(found, places, reserve, count, needed)
            hit = bool(((keys[0] == keys[1]) & ~spared).any())
            if reserve:
                near = [set(jaccard.deletion_keys(h, band, count, reserve).tolist()) for h in hashes]
                whole = [set(k[:reserve].tolist()) for k in keys]
                hit = hit or bool(near[0] & whole[1] or near[1] & whole[0])
            assert hit


def test_sketches_bound_differences():
    rnd = random.Random(3)
    for _ in range(200):
        one, two = ({rnd.randrange(300) for _ in range(rnd.randrange(1, 200))} for _ in range(2))
        sketches = [jaccard.sketch_of(np.array(sorted(s), np.uint64)) for s in (one, two)]
        a, b = jaccard._sketch_matrix(sketches)
        assert np.bitwise_count(a ^ b).sum() <= len(one ^ two)


@pytest.mark.parametrize("most", [1 << 62, 0])
def test_grams_hashed_by_word(monkeypatch, most):
    """Counts are exact and hashes the same in every batch, without cutting n-grams out as bytes (F1)."""
    monkeypatch.setattr(jaccard, "MOST_CODES", most)
    rng = random.Random(5)
    texts = [b"a", b"a b", b"a b c", b"a b c d", b"a a a a a", b"b a a a", "naïve ß x ß".encode(), b"\xff \xfe \xff \xfe \xff"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60))).encode() for _ in range(40)]
    texts += [b"c b a"]
    for words in (1, 3, 4):
        whole = list(jaccard.gram_hashes(pa.array(texts, pa.binary()), words))
        parts = [x for t in texts for x in jaccard.gram_hashes(pa.array([b"other", t], pa.binary()).slice(1), words)]
        grams = [jaccard.shingles(t, words) for t in texts]
        assert [n for n, _ in whole] == [n for n, _ in parts] == [len(g) for g in grams]
        assert all((a == b).all() for (_, a), (_, b) in zip(whole, parts, strict=True))
        sets = [set(h.tolist()) for _, h in whole]
        assert all(len(a & b) == len(x & y) for a, x in zip(sets, grams) for b, y in zip(sets, grams))
    assert list(jaccard.gram_hashes(pa.array([], pa.binary()), 3)) == []


def test_signing_cuts_no_grams(monkeypatch):
    """Sizes and keys of texts are made without a byte string for each n-gram (F1)."""
    monkeypatch.setattr(jaccard, "shingles", None)
    texts = [b"a b c d", b"x", b" ".join(b"w%d" % (n % 50) for n in range(400))]
    columns = {"key": texts, "id": [1, 2, 3], "copies": [1, 1, 1], "text": texts}
    batch = pa.RecordBatch.from_pydict(columns, pa.schema([("key", pa.binary()), ("id", pa.int64()), ("copies", pa.int64()), ("text", pa.binary())]))
    (made,) = jaccard._signed(3, 90)([batch])
    assert made.column("size").to_pylist() == [2, 1, 50]
