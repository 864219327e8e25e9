"""Byte-level BPE: encoding by a queue of merge ranks over a doubly linked list, decoding by concatenation.

A text is cut at added tokens, then by the pattern of the byte-level pre-tokenizer into words.  The
bytes of a word are the symbols of a doubly linked list.  Every pair of neighbours that has a
merge waits in a priority queue by (rank, place).  The first entry is taken; it is stale, and
skipped, when one of its two symbols has been merged away or changed since; otherwise the pair
becomes one symbol and the two new pairs around it enter the queue.  A word of n bytes takes
O(n log n) steps, however long it is.  Decoding concatenates the byte strings of the ids.

Words recur, so each worker remembers the ids of up to ``memo_words`` words of up to 64 characters
and starts anew when they are more; that changes no result.  No row meets another one, so the
work needs no shuffle and a lost task is simply run again.

Defined cases: a null or empty text has no ids, and no ids decode to the empty text (null ids
too); an id that the vocabulary lacks, or a null one, is left out by ``decode``; bytes that are not
UTF-8 decode to U+FFFD; rows with equal text have equal ids; an empty table gives an empty
result; other columns stay, except that ``n_tokens``, ``ids`` and the decoded column replace columns of
the same names (in any case of letters).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMO_WORDS = 150_000  # some 30 MB
LONG_WORD = 64
WORDS_AT_ONCE = 1 << 18
IDS_AT_ONCE = 1 << 21

# Fixed value: the pattern of the byte-level pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


_words = regex.compile(WORDS)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache
def _newer_letters() -> frozenset[str]:
    """Letters and numbers of ``regex`` that are newer than Python's Unicode tables; the pre-tokenizer lacks them, too."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


def _split_words(text: str) -> Iterator[str]:
    """Lazily, the words of a text with letters that are no letters for the pre-tokenizer."""
    newer = _newer_letters()
    # An unassigned code point, which is neither a letter nor white space, stands in for each of them.
    plain = "".join(["\u0378" if c in newer else c for c in text])
    for found in _words.finditer(plain):
        yield text[found.start() : found.end()]


def words_of(text: str) -> Iterator[str]:
    """The words of the pre-tokenizer, lazily if the text is long."""
    if not text.isascii() and not _newer_letters().isdisjoint(text):
        return _split_words(text)
    if len(text) <= WORDS_AT_ONCE:
        return iter(_words.findall(text))
    return (found.group() for found in _words.finditer(text))


@dataclass
class Vocabulary:
    """Byte strings by id, merges by pair of ids, and the tokens that are cut out before anything else."""

    tokens: dict[int, bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    added: dict[str, int]
    bytes_to_ids: list[int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, cutter = whole["model"], whole["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        by_bytes = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"]
        added = whole.get("added_tokens") or []
        exact = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        if model["type"] != "BPE" or whole["normalizer"] or not (plain and by_bytes and exact):
            raise ValueError(f"{path}: only byte-level BPE without normalizer, prefixes, suffixes and dropout")
        letters, vocabulary = _byte_letters(), model["vocab"]
        lack = [c for c in letters if c not in vocabulary]
        if lack:
            raise ValueError(f"{path}: {len(lack)} bytes have no token")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = {(vocabulary[a], vocabulary[b]): (r, vocabulary[a + b]) for r, (a, b) in enumerate(pairs)}

        def spelled(token: str) -> bytes:
            known = all(c in letters for c in token)
            return bytes(letters[c] for c in token) if known else token.encode()

        tokens = {i: spelled(t) for t, i in vocabulary.items()} | {t["id"]: spelled(t["content"]) for t in added}
        by_byte = sorted(letters, key=letters.get)
        return cls(tokens, merges, {t["content"]: t["id"] for t in added}, [vocabulary[c] for c in by_byte])


def merge(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge neighbours, lowest rank first and leftmost first, until no pair has a merge."""
    size = len(symbols)
    if size < 2:
        return symbols
    find = merges.get
    queue = []
    for place, pair in enumerate(zip(symbols, symbols[1:])):
        known = find(pair)
        if known:
            queue.append((known[0], place, pair, known[1]))
    if not queue:
        return symbols
    heapify(queue)
    symbols = symbols.copy()
    after = list(range(1, size + 1))  # ``size``: none
    before = list(range(-1, size - 1))  # -1: none
    while queue:
        _, place, pair, merged = heappop(queue)
        second = after[place]
        if symbols[place] != pair[0] or second == size or symbols[second] != pair[1]:
            continue  # stale
        third = after[second]
        symbols[place], symbols[second] = merged, -1
        after[place] = third
        if third < size:
            before[third] = place
            pair = (merged, symbols[third])
            known = find(pair)
            if known:
                heappush(queue, (known[0], place, pair, known[1]))
        first = before[place]
        if first >= 0:
            pair = (symbols[first], merged)
            known = find(pair)
            if known:
                heappush(queue, (known[0], first, pair, known[1]))
    return [s for s in symbols if s >= 0]


class Encoder(dict):
    """Ids of words, as little-endian 32-bit integers; a dictionary that works out what it lacks."""

    def __init__(self, vocabulary: Vocabulary, memo_words: int = MEMO_WORDS, added_as_text: bool = False):
        self._vocabulary, self._memo_words = vocabulary, memo_words
        contents = [] if added_as_text else sorted(vocabulary.added, key=len, reverse=True)
        self._added = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")") if contents else None

    def __missing__(self, word: str) -> bytes:
        letters = self._vocabulary.bytes_to_ids
        ids = merge([letters[b] for b in word.encode()], self._vocabulary.merges)
        packed = np.array(ids, "<u4").tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= self._memo_words:
                self.clear()
            self[word] = packed
        return packed

    def _parts(self, text: str) -> Iterator[bytes]:
        parts = self._added.split(text) if self._added else [text]
        for number, part in enumerate(parts):
            if number % 2:
                yield self._vocabulary.added[part].to_bytes(4, "little")
            else:
                words = words_of(part)
                while some := list(islice(words, WORDS_AT_ONCE)):
                    yield b"".join([self[word] for word in some])

    def encode(self, text: str | None) -> bytes:
        return b"".join(self._parts(text)) if text else b""


def _batches(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where ``sizes`` add up to ``most``; a row of any size stays whole."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def _without(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c.lower() not in names]


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    memo_words: int = MEMO_WORDS,
    added_as_text: bool = False,
) -> DataFrame:
    """All columns but the text, then ``n_tokens`` and ``ids``.

    With ``added_as_text`` the strings of added tokens (such as an end of text) are ordinary text.
    """
    kept = _without(docs, "n_tokens", "ids", text.lower())
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias("ids"))
    numbers = [T.StructField("n_tokens", T.LongType(), False), T.StructField("ids", T.ArrayType(T.IntegerType()), False)]
    fields = T.StructType([*rows.schema.fields[:-1], *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, memo_words, added_as_text)
        for whole in batches:
            lengths = pc.fill_null(pc.binary_length(whole.column("ids")), 0).to_numpy()
            for batch in _batches(whole, lengths, IDS_AT_ONCE):
                packed = [encoder.encode(t) for t in batch.column("ids").to_pylist()]
                counts = np.array([len(p) // 4 for p in packed], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array(counts), ids], [*kept, "n_tokens", "ids"]
                )

    return rows.mapInArrow(run, fields)


def decode(
    encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """All columns, or all but ``ids``, and the text of ``ids``."""
    kept = _without(encoded, text.lower(), *([] if keep_ids else [ids.lower()]))
    rows = encoded.select(*[F.col(f"`{c}`") for c in kept], *([] if keep_ids else [F.col(f"`{ids}`")]))
    fields = [f for f in rows.schema.fields if f.name in kept]
    tokens = vocabulary.tokens

    def string_of(numbers: np.ndarray) -> str:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        parts = []
        for start in range(0, len(numbers), WORDS_AT_ONCE):
            some = numbers[start : start + WORDS_AT_ONCE].tolist()
            try:
                spelled = b"".join([tokens[i] for i in some])
            except KeyError:
                spelled = b"".join([tokens.get(i, b"") for i in some])
            parts.append(decoder.decode(spelled))
        return "".join(parts) + decoder.decode(b"", True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.fill_null(pc.list_value_length(whole.column(ids)), 0).to_numpy()
            for batch in _batches(whole, lengths, IDS_AT_ONCE):
                column = batch.column(ids)
                bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0))])
                flat = pc.fill_null(column.flatten(), -1).to_numpy()
                texts = [string_of(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, text]
                )

    return rows.mapInArrow(run, T.StructType([*fields, T.StructField(text, T.StringType(), False)]))


def ids_digest(ids: str = "ids"):
    """SHA-256, in hexadecimal, of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def digest(column: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat = column.flatten().to_numpy().astype("<u4", copy=False)
        digests = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.array(digests, pa.string())

    return digest(F.col(ids))
