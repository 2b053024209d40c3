"""Byte-level BPE: encoding by a depth-first walk over a trie of distinct words, and decoding.

The BPE encoding of a string ends in exactly one token, and what comes before that token is
itself the encoding of a shorter prefix. So the last token of each prefix is all the state that
is needed: the last token of a prefix is the one vocabulary entry that ends it and that the
merges leave standing after the last token of what precedes it. Words that share a prefix share
these states. A sorted list of words is a trie in depth-first order, so a stack of states is
kept as deep as the next word agrees with the previous one, and only new letters are computed.

Texts are cut into words as GPT-2's pattern does and encoded with the results for the distinct
words of a block of text. Results are kept for later blocks up to a fixed number of words and of
bytes. Vocabulary files with settings that would need other steps are refused.

Defined results: a null or empty text has no tokens and decodes to the empty text; special
tokens of the file found in a text become their ids; repeated documents give one row each.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from termtide.llm.common import columns_of, held, use_text_batches

BLOCK_BYTES = 4 << 20
KEPT_WORDS = 100_000
KEPT_BYTES = 32 << 20
KEPT_PAIRS = 200_000

# The pattern of byte-level BPE with its classes, and white space as Unicode has it.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^{space}{both}]+"
    r"|[{space}]+(?![^{space}])|[{space}]+"
)
_ANY = regex.compile(
    _PATTERN.format(letter=r"\p{L}", number=r"\p{N}", both=r"\p{L}\p{N}", space=_SPACE)
)
_ASCII = re.compile(
    _PATTERN.format(letter="[A-Za-z]", number="[0-9]", both="A-Za-z0-9", space=r"\t-\r ")
)


def split_words(text: str) -> list[str]:
    return (_ASCII if text.isascii() else _ANY).findall(text)


def _byte_of_char() -> dict[str, int]:
    """The file spells bytes as printable characters; the rest are numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _check_settings(spec: dict) -> None:
    """Raise `ValueError` for settings of a file that change ids and are not built here."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {
        "model type": model.get("type", "BPE") == "BPE",
        "dropout": not model.get("dropout"),
        "continuing_subword_prefix": not model.get("continuing_subword_prefix"),
        "end_of_word_suffix": not model.get("end_of_word_suffix"),
        "byte_fallback": not model.get("byte_fallback"),
        "ignore_merges": not model.get("ignore_merges"),
        "normalizer": spec.get("normalizer") is None,
        "pre_tokenizer": before.get("type") == "ByteLevel" and before.get("use_regex", True),
        "add_prefix_space": not before.get("add_prefix_space", True),
        "decoder": (spec.get("decoder") or {}).get("type") == "ByteLevel",
        "added_tokens": not any(
            token.get(rule)
            for token in spec.get("added_tokens", [])
            for rule in ("single_word", "lstrip", "rstrip")
        ),
        "vocabulary without all bytes": _byte_of_char().keys() <= model["vocab"].keys(),
    }
    refused = [name for name, fine in plain.items() if not fine]
    if refused:
        raise ValueError(f"settings of the vocabulary file that are not supported: {refused}")


class _Index(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class ByteBpe:
    """Encoder and decoder for a byte-level BPE vocabulary in the tokenizers library's format."""

    def __init__(self, file: str) -> None:
        spec = json.loads(file)
        _check_settings(spec)
        byte_of = _byte_of_char()

        def raw(spelled: str) -> bytes:
            return bytes(byte_of[c] for c in spelled)

        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: raw(s) for s, i in vocab.items() if s not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self._table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special_split = (
            re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        )
        ids = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        self._rank = dict.fromkeys(ids.values(), -1)
        self._merged: dict[tuple[int, int], int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[raw(left)], ids[raw(right)]
            whole = ids[raw(left) + raw(right)]
            self._merged[pair] = whole
            self._halves[whole] = pair
            self._rank[whole] = rank
        self._follows: dict[int, bool] = {}  # pairs tried, as one number
        # A token that its own merges never make cannot end a prefix.
        self._ids = {
            b: i
            for b, i in ids.items()
            if i not in self._halves or self._stands(*self._halves[i], self._rank[i])
        }
        self._sizes = self._sizes_by_ending()
        self._index = _Index()
        self._encoded: list[bytes] = []
        self._kept_bytes = 0

    def _sizes_by_ending(self) -> dict[bytes, tuple[int, ...]]:
        """Sizes of the entries that can end a prefix, by its last two bytes (or its only one)."""
        found: dict[bytes, set[int]] = {bytes([b]): {1} for b in range(256)}
        found |= {bytes([a, b]): {1} for a in range(256) for b in range(256)}
        for raw in self._ids:
            if len(raw) > 1:
                found[raw[-2:]].add(len(raw))
        return {ending: tuple(sorted(sizes)) for ending, sizes in found.items()}

    def _stands(self, left: int, right: int, before: int) -> bool:
        """Whether the merges made before rank `before` keep two neighbours apart.

        Goes back in time: the later of the two tokens' own merges is undone, and the parts
        that touch then must not have been merged earlier than that.
        """
        rank, merged, halves = self._rank, self._merged, self._halves
        while True:
            whole = merged.get((left, right))
            if whole is not None and rank[whole] < before:
                return False
            if rank[left] > rank[right]:
                before = rank[left]
                left = halves[left][1]
            elif rank[right] >= 0:
                # Equal merges are made from left to right, so an equal one counts as earlier.
                before = rank[right] + 1
                right = halves[right][0]
            else:
                return True

    def learn(self, words: list[str]) -> list[bytes]:
        """Encode distinct words, which share the work for common prefixes."""
        ids, sizes_at, follows, ranks = self._ids, self._sizes, self._follows, len(self._rank)
        spelled = [w.encode() for w in words]
        encoded: list[bytes] = [b""] * len(spelled)
        tokens: list[int] = []  # the last token of each prefix, and how long it is
        sizes: list[int] = []
        previous = b""
        for place in sorted(range(len(spelled)), key=spelled.__getitem__):
            raw = spelled[place]
            shared, most = 0, min(len(raw), len(previous))
            while shared < most and raw[shared] == previous[shared]:
                shared += 1
            del tokens[shared:], sizes[shared:]
            # Just one entry fits, so they may be tried in any order; short ones are frequent.
            for end in range(shared + 1, len(raw) + 1):
                for size in sizes_at[raw[end - 2 : end] if end > 1 else raw[:1]]:
                    token = ids.get(raw[end - size : end]) if size < end else None
                    if token is not None:
                        pair = tokens[end - size - 1] << 32 | token
                        fits = follows.get(pair)
                        if fits is None:
                            fits = follows[pair] = self._stands(pair >> 32, token, ranks)
                        if fits:
                            break
                else:
                    size, token = end, ids[raw[:end]]
                tokens.append(token)
                sizes.append(size)
            previous = raw
            made, end = [], len(raw)
            while end:
                made.append(tokens[end - 1])
                end -= sizes[end - 1]
            made.reverse()
            encoded[place] = array("I", made).tobytes()
        return encoded

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self._index) > KEPT_WORDS or self._kept_bytes > KEPT_BYTES:
            self._index, self._encoded, self._kept_bytes = _Index(), [], 0
        if len(self._follows) > KEPT_PAIRS:
            self._follows.clear()
        number = self._index.__getitem__
        numbered = [array("I", map(number, self._words(text))) for text in texts]
        fresh = list(islice(self._index, len(self._encoded), None))
        plain = [w for w in fresh if w not in self.special]
        results = dict(zip(plain, self.learn(plain)))
        made = [
            results[w] if w in results else array("I", [self.special[w]]).tobytes() for w in fresh
        ]
        self._encoded += made
        self._kept_bytes += sum(map(len, fresh)) + sum(map(len, made))
        encoded = self._encoded.__getitem__
        return [b"".join(map(encoded, numbers)) for numbers in numbered]

    def _words(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return split_words(text)
        parts = self._special_split.split(text)
        return [w for p in parts for w in ([p] if p in self.special else split_words(p))]

    def decode(self, ids: bytes) -> str:
        """Text of little-endian unsigned 32-bit ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self._table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterable[pa.RecordBatch]:
    """The rows in slices whose texts have about `size` bytes."""
    for batch in batches:
        start, held = 0, 0
        for row, text in enumerate(batch.column(column).to_pylist()):
            held += len(text or "")
            if held >= size:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def tokenizer_file(path: str) -> str:
    """A vocabulary file; it is read on the driver and sent to the executors (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(spark: SparkSession, docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """All columns of the documents, `ids` (binary, 4 bytes each) and `decoded`.

    A file whose settings are not supported raises `ValueError` here, before any task. Columns of the documents with these two names are replaced.
    """
    use_text_batches(spark)
    file = tokenizer_file(path)
    _check_settings(json.loads(file))
    shared = spark.sparkContext.broadcast(file)
    kept = docs.drop(*{"ids", "decoded"} - {text_col})
    names = [c for c in kept.columns if c not in ("ids", "decoded")]

    def run(batches):
        collects = gc.isenabled()
        gc.disable()  # millions of strings and no cycles
        try:
            file = shared.value
            coder = held(("bpe", file), lambda: ByteBpe(file))
            for batch in blocks(batches, text_col, BLOCK_BYTES):
                ids = coder.encode_batch([t or "" for t in columns_of(batch, text_col)[0]])
                decoded = pa.array([coder.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*map(batch.column, names), pa.array(ids, pa.binary()), decoded],
                    names=[*names, "ids", "decoded"],
                )
        finally:
            if collects:
                gc.enable()  # the worker goes on to other tasks

    schema = kept.select(*names).schema.add("ids", "binary").add("decoded", "string")
    return kept.mapInArrow(run, schema)
