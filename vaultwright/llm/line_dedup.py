"""Fuzzy duplicates among lines, by runs of words that similar lines must share.

A line is normalised (lower case, ASCII punctuation becomes space, white space one space).
Lines are similar by edit distance over words: 1 - distance / words of the longer.  k edits leave
a longer line of n words with at most k + 1 untouched runs, one of which has
(n - k) / (k + 1) words or more.  A line's keys are minimizers: of every so many neighbouring
windows of words the one with the smallest hash, so many that a run of that length holds all of
them.  So two lines within the threshold always share a key, whatever the edits are and wherever they
stand.  Shorter runs choose a superset of what longer ones choose, so lines of different lengths meet.

Lines with an equal key are candidates (see ``linking`` for how pairs of large groups are avoided).  The windows of
keys are short, so common phrases make large groups.  There the whole shared run takes the key's place: its
smallest window is the key of both lines, so they share each run of that many words around it.
An edit changes two bits at most of a bitmap of the words; candidates whose bitmaps or lengths differ by
more than the allowed edits are not verified.  Lines too short for an edit match when equal.

Connected lines are a group; of each group the first occurrence (by doc_id, text, line
number) stays.  Lines with fewer than ``least_words`` words, by default those without a word, are always kept.

Defined cases: null and empty texts have no lines to remove; a text whose every line with a
word is removed is dropped by ``dedup``; rows with equal doc_id and text count as one text
and are treated alike; a null doc_id comes last; empty tables give empty results; other
columns stay as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultwright.llm import linking
from vaultwright.llm.common import free_shuffles, hash_words, mix, stage, staged_for_now, word_spans
from vaultwright.llm.linking import Close, Finer, Near, Packed, classes

BROADCAST_KEYS = 500_000  # of 24 bytes
LONGEST = 256  # words of a line, beyond which the length of shared runs no longer matters
BITS = 256  # of a line's bitmap of words
LINES = 1024  # of a block in which lines of a large key are compared; each block is sent to every other one
MOST_BITS = 28  # of the bitmap of large keys, 32 MB; of 16 bits a key if they are fewer
PART = 1 << 19  # characters of lines that are hashed at a time
# Bytes of UTF-8: everything in ASCII but letters, digits and the line feed becomes a space.
_PLAIN = bytes(b if b >= 128 or b == 10 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.85
    least_words: int = 1
    seeds: int = 2


def _plain(text: str) -> str:
    return text.lower().encode("utf-8", "replace").translate(_PLAIN).decode()


def normalise(line: str) -> str:
    return " ".join(_plain(line).split())


def allowed_edits(words: int, similarity: float) -> int:
    return int(words * (1 - similarity) + 1e-9)


@lru_cache
def runs(similarity: float) -> tuple[int, np.ndarray]:
    """Words per window, and by the number of a line's words how many neighbouring windows choose one (0: equal lines only).

    Numbers beyond the table are treated like its last one: the run grows with the edits.
    """
    edits = [allowed_edits(n, similarity) for n in range(2 * LONGEST)]
    run = [-(-(n - k) // (k + 1)) for n, k in enumerate(edits)]
    shared = np.zeros(LONGEST, np.int64)
    for words in range(1, LONGEST):
        # The longer line of a pair may have this many words.
        longer = [n for n in range(words, 2 * LONGEST) if n - edits[n] <= words and edits[n]]
        shared[words] = min((run[n] for n in longer), default=0)
    window = max(1, int(min(shared[shared > 0], default=1)))
    return window, np.where(shared > 0, shared - window + 1, 0)


@lru_cache
def run_lengths(similarity: float) -> dict[int, np.ndarray]:
    """Lengths of shared runs, and by the number of a line's words whether a run of that length is one it may share.

    A pair shares runs of the longer line's edits; of the lengths that each line alone knows of, the smaller counts.
    """
    window, choices = runs(similarity)
    shared = np.where(choices > 0, choices + window - 1, 0)
    out = {int(n): np.zeros(LONGEST, bool) for n in np.unique(shared[shared > 0])}
    for longer in range(1, 2 * LONGEST):
        for words in range(longer - allowed_edits(longer, similarity), longer + 1):
            m, n = min(words, LONGEST - 1), min(longer, LONGEST - 1)
            if shared[m] and shared[n]:
                out[int(min(shared[m], shared[n]))][[m, n]] = True
    return out


def _words(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash and the line of each word, and the places of the lines' first words."""
    buffer = np.frombuffer("\n".join(lines).encode("utf-8", "replace"), np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(buffer == 10) + 1, [len(buffer) + 1]])
    starts, ends = word_spans(buffer)
    words = hash_words(buffer, starts, ends)
    first = np.searchsorted(starts, edges)
    return words, np.repeat(np.arange(len(lines)), np.diff(first)), first


def _parts(lines: list[str]) -> Iterator[list[str]]:
    """The lines in parts of about ``PART`` characters; arrays of hashes are many times larger than their text."""
    start = size = 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= PART:
            yield lines[start : i + 1]
            start, size = i + 1, 0
    if start < len(lines) or not lines:
        yield lines[start:]


def word_bits(lines: list[str]) -> np.ndarray:
    """Per line the number of its words and a bitmap of them, as longs."""
    words, line, first = _words(lines)
    bits = np.zeros((len(lines), BITS), bool)
    bits[line, (mix(words) >> np.uint64(40)).astype(np.int64) % BITS] = True
    return np.column_stack([np.diff(first)[: len(lines)], np.packbits(bits, axis=1).view(np.int64).reshape(len(lines), BITS // 64)])


def _grams(words: np.ndarray, window: int) -> np.ndarray:
    gram, n = np.zeros(len(words), np.uint64), len(words)
    for k in range(window):
        after = np.zeros(n, np.uint64)
        after[: n - k] = words[k:]
        gram = mix(gram ^ after)
    return gram


def long_runs(lines: list[str], similarity: float, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line and hash of each run that may be shared and whose smallest window is a key ``marked`` in a bitmap."""
    window, _ = runs(similarity)
    words, line, first = _words(lines)
    count, n = np.diff(first), len(words)
    gram = _grams(words, window)
    left = first[1:][line] - np.arange(n)
    least, reach, owners, keys = gram.copy(), 1, [], []
    for length, may_be in sorted(run_lengths(similarity).items()):
        for k in range(reach, length - window + 1):
            np.minimum(least[: n - k], gram[k:], out=least[: n - k])
        reach = max(reach, length - window + 1)
        place = least & np.uint64(8 * len(marked) - 1)
        hit = (marked[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        at = np.flatnonzero(hit & (left >= length) & may_be[np.minimum(count, LONGEST - 1)][line])
        run = np.full(len(at), length, np.uint64)
        for k in range(length):
            run = mix(run ^ words[at + k])
        owners.append(line[at])
        keys.append(run)
    return np.concatenate(owners), np.concatenate(keys).view(np.int64)


def minimizers(lines: list[str], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each line's keys, and the keys."""
    window, choices = runs(similarity)
    words, line, first = _words(lines)
    count, n = np.diff(first), len(words)
    gram = _grams(words, window)
    left = first[1:][line] - np.arange(n)  # words from here to the line's end
    of = choices[np.minimum(count, LONGEST - 1)][line]
    chosen = np.zeros(n, bool)
    for w in np.unique(of[of > 0]).tolist():
        least = gram.copy()
        for k in range(1, w):
            np.minimum(least[: n - k], gram[k:], out=least[: n - k])
        whole = (of == w) & (left >= window + w - 1)
        for k in range(w):
            chosen[k:] |= whole[: n - k] & (gram[k:] == least[: n - k])
    at = np.flatnonzero(chosen)
    return np.searchsorted(line[at], np.arange(len(lines) + 1)).astype(np.int32), gram[at].view(np.int64)


def keys_of(lines: list[str], settings: Settings) -> list[list[int]]:
    """The keys of normalised lines."""
    offsets, keys = minimizers(lines, settings.similarity)
    return [keys[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])]


def _split(text: str | None, least_words: int) -> list[tuple[int, str]]:
    """Numbered normalised lines that take part."""
    out = []
    for number, line in enumerate(_plain(text).split("\n") if text else ()):
        words = line.split()
        if words and len(words) >= least_words:
            out.append((number, " ".join(words)))
    return out


class _Known(dict):
    """The characters of words, as far as they were asked for."""

    def __missing__(self, word: str) -> str:
        self[word] = code = chr(0x4E00 + zlib.crc32(word.encode("utf-8", "replace")) % 20_000)
        return code


def _codes(clean: str, known: _Known | None = None) -> str:
    """One character per word, one of 20,000, so that edit distances count words."""
    known = _Known() if known is None else known
    return "".join([known[w] for w in clean.split(" ")])


def _digests(lines: list[str], salt: int) -> np.ndarray:
    """Two longs per line: its node, and what tells apart lines of one node."""
    salted = salt.to_bytes(16, "big")
    whole = b"".join(hashlib.blake2b(c.encode("utf-8", "replace"), digest_size=16, salt=salted).digest() for c in lines)
    return np.frombuffer(whole, ">i8").astype(np.int64).reshape(len(lines), 2)


def _text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Neighbouring texts of about 4 MB, and where they start; no more than these become Python's strings at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = min(len(texts), int(np.searchsorted(ends, before + (4 << 20))) + 1)
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def lines(docs: DataFrame, settings: Settings, salt: int = 0) -> DataFrame:
    """One row per distinct text of a doc_id and line that takes part: doc_id, doc, line, node, other, fact.

    Lines are equal if both node and other are; see ``line_kinds``.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _text_key().alias("doc"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _pieces(batch.column("text")):
                found = [_split(t, settings.least_words) for t in texts]
                owner = pa.array(np.repeat(np.arange(start, start + len(texts)), [len(f) for f in found]))
                flat = [line for f in found for line in f]
                clean = [c for _, c in flat]
                facts = np.concatenate([word_bits(part) for part in _parts(clean)])
                places = np.arange(0, facts.size + 1, facts.shape[1], dtype=np.int32)
                digests = _digests(clean, salt)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(owner),
                        batch.column("doc").take(owner),
                        pa.array([n for n, _ in flat], pa.int32()),
                        pa.array(digests[:, 0].copy()),
                        pa.array(digests[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(facts.ravel())),
                    ],
                    names=["doc_id", "doc", "line", "node", "other", "fact"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(cut, f"doc_id {kind}, doc binary, line int, node long, other long, fact array<long>")


def line_keys(docs: DataFrame, settings: Settings, salt: int = 0) -> DataFrame:
    """(node, key): the keys of lines."""

    def of(part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        offsets, keys = minimizers(part, settings.similarity)
        return np.repeat(np.arange(len(part)), np.diff(offsets)), keys

    return _keyed(docs, of, settings, salt)


def run_keys(docs: DataFrame, large: DataFrame, settings: Settings, salt: int = 0) -> DataFrame:
    """(node, key): the runs around ``large`` keys."""
    bits = docs.sparkSession.sparkContext.broadcast(key_bitmap(large))
    return _keyed(docs, lambda part: long_runs(part, settings.similarity, np.frombuffer(bits.value, np.uint8)), settings, salt)


def key_bitmap(keys: DataFrame) -> bytes:
    """The low bits of keys, whose high ones are small by choice; a false hit adds a run, none is lost."""
    n = min(max((16 * keys.count()).bit_length(), 15), MOST_BITS)
    chunk = 1 << 15  # bits of one bitmap of Spark
    place = F.col("key").bitwiseAND(F.lit((1 << n) - 1))
    found = keys.select(place.alias("place")).groupBy(F.floor(F.col("place") / chunk).alias("chunk"))
    whole = bytearray((1 << n) // 8)
    for row in found.agg(F.bitmap_construct_agg(F.col("place") % chunk).alias("bitmap")).toLocalIterator():
        whole[row.chunk * chunk // 8 : (row.chunk + 1) * chunk // 8] = row.bitmap
    return bytes(whole)


def _keyed(
    docs: DataFrame, of: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], settings: Settings, salt: int
) -> DataFrame:
    """(node, key): of some lines, the line and key of each key."""
    rows = docs.select(F.col("text").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _pieces(batch.column("text")):
                clean = list({c for t in texts for _, c in _split(t, settings.least_words)})
                for part in _parts(clean):
                    owner, keys = of(part)
                    order = np.lexsort((keys, owner))
                    owner, keys = owner[order], keys[order]
                    once = np.append(True, (np.diff(owner) != 0) | (np.diff(keys) != 0))[: len(keys)]
                    nodes = _digests(part, salt)[:, 0][owner[once]]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys[once])], names=["node", "key"])

    return rows.mapInArrow(cut, "node long, key long")


def line_texts(docs: DataFrame, wanted: DataFrame, settings: Settings, salt: int = 0, packed: bool = False) -> DataFrame:
    """(node, codes) of the lines at the wanted places (node, doc_id, doc); ``packed``: codes as bytes, two each.

    The places only spare the texts without a wanted line; where they are many, all texts are cut rather than shuffled.
    """
    few = wanted.count() <= BROADCAST_KEYS
    hint = F.broadcast if few else (lambda df: df)
    rows = docs.select(F.col("text").cast("string").alias("text"), _text_key().alias("doc"))
    if few:
        rows = rows.join(hint(wanted.select("doc").distinct()), "doc", "left_semi")
    rows = rows.select("text")
    kind = pa.binary() if packed else pa.string()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _pieces(batch.column("text")):
                clean = list({c for t in texts for _, c in _split(t, settings.least_words)})
                known = _Known()
                codes = [_codes(c, known).encode("utf-16-le") if packed else _codes(c, known) for c in clean]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(clean, salt)[:, 0].copy()), pa.array(codes, kind)], names=["node", "codes"]
                )

    found = rows.mapInArrow(cut, f"node long, codes {'binary' if packed else 'string'}")
    return found.join(hint(wanted.select("node").distinct()), "node", "left_semi").dropDuplicates(["node"])


def similar(threshold: float):
    """Edit similarity of the columns ca and cb of at least ``threshold``."""
    longer = F.greatest(F.length("ca"), F.length("cb"))
    allowed = F.floor(longer * F.lit(1 - threshold) + F.lit(1e-9)).cast("int")
    distance = F.expr("levenshtein(ca, cb, allowed)")
    return lambda pairs: (
        pairs.withColumn("allowed", allowed)
        .filter(F.abs(F.length("ca") - F.length("cb")) <= F.col("allowed"))
        .filter(distance >= 0)
    )


def _distances(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Edit distances of pairs of sequences of codes, all at once."""
    n, m = (np.array([len(x) for x in side]) for side in (first, second))
    a, b = (np.full((len(side), max(size.max(), 1)), fill, np.int32) for side, size, fill in ((first, n, -1), (second, m, -2)))
    for table, side in ((a, first), (b, second)):
        for i, x in enumerate(side):
            table[i, : len(x)] = x
    steps = np.arange(b.shape[1] + 1, dtype=np.int32)
    row = np.tile(steps, (len(a), 1))
    out = m.copy()
    for i in range(1, a.shape[1] + 1):
        best = np.minimum(row[:, :-1] + (b != a[:, i - 1 : i]), row[:, 1:] + 1)
        row = np.concatenate([np.full((len(a), 1), i, np.int32), best], axis=1)
        row = np.minimum.accumulate(row - steps, axis=1) + steps
        ends = np.flatnonzero(n == i)
        out[ends] = row[ends, m[ends]]
    return out


def _numbered(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each code, and the code with how often it stood in the sequence before."""
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    word = np.concatenate(codes).astype(np.int64)
    order = np.lexsort((word, owner))
    owner, word = owner[order], word[order]
    at = np.arange(len(word))
    fresh = np.append(True, (np.diff(owner) != 0) | (np.diff(word) != 0))[: len(word)]
    return owner, word << 32 | at - np.maximum.accumulate(np.where(fresh, at, 0))


def _common(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """The number of common words, repeated ones as often as both have them, for every two sequences."""
    (of_a, a), (of_b, b) = _numbered(first), _numbered(second)
    kinds = np.intersect1d(a, b)
    out = np.zeros((len(first), len(second)), np.float32)
    for start in range(0, len(kinds), 4096):
        some = kinds[start : start + 4096]
        tables = []
        for of, words, n in ((of_a, a, len(first)), (of_b, b, len(second))):
            at = np.minimum(np.searchsorted(some, words), len(some) - 1)
            here = some[at] == words
            table = np.zeros((n, len(some)), np.float32)
            table[of[here], at[here]] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _plausible_pairs(
    first: np.ndarray, second: np.ndarray, roots: tuple[np.ndarray, np.ndarray], similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of first and of second, and which of their pairs are of two classes and may be within the threshold.

    Rows are lines: the number of their words and a bitmap of them, as longs.  Pairs left out are neither.
    """
    one, two = np.argsort(first[:, 0], kind="stable"), np.argsort(second[:, 0], kind="stable")
    lengths = second[two, 0]
    for start in range(0, len(one), 128):
        some = one[start : start + 128]
        # Beyond these lengths no line is within the threshold of some.
        reach = first[some[0], 0] * similarity - 1, first[some[-1], 0] / similarity + 1
        others = two[np.searchsorted(lengths, reach[0]) : np.searchsorted(lengths, reach[1], "right")]
        a, b = first[some], second[others]
        longer = np.maximum(a[:, :1], b[None, :, 0])
        allowed = np.floor(longer * (1 - similarity) + 1e-9)
        differing = np.zeros(longer.shape, np.uint16)
        for k in range(1, first.shape[1]):
            # Of signed numbers it would be the bits of their absolute value.
            differing += np.bitwise_count((a[:, k : k + 1] ^ b[None, :, k]).view(np.uint64))
        may_be = (differing <= 2 * allowed) & (np.abs(a[:, :1] - b[None, :, 0]) <= allowed)
        yield some, others, may_be & (roots[0][some][:, None] != roots[1][others][None, :])


def near_lines(similarity: float) -> Near:
    """Lines whose facts don't rule out that one of another class is within the threshold."""

    def near(first: np.ndarray, second: np.ndarray, roots: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = np.zeros(len(first), bool), np.zeros(len(second), bool)
        for some, others, may_be in _plausible_pairs(first, second, roots, similarity):
            found[0][some] |= may_be.any(axis=1)
            found[1][others] |= may_be.any(axis=0)
        return found

    return near


def close_lines(similarity: float) -> Close:
    """Pairs of lines within the threshold that link classes; elements are the 16-bit codes of their words.

    k edits leave all but k words of the longer line in common.  A pair whose classes are already linked by pairs
    before it is left out.
    """

    def close(first: list[Packed], second: list[Packed], roots: tuple[np.ndarray, np.ndarray], same: bool) -> Iterator[tuple[int, int]]:
        one, two = ([np.frombuffer(codes, np.uint16) for codes, _ in side] for side in (first, second))
        n_a, n_b = (np.array([len(x) for x in side]) for side in (one, two))
        longer = np.maximum(n_a[:, None], n_b[None, :])
        allowed = np.floor(longer * (1 - similarity) + 1e-9).astype(np.int64)
        may_be = (np.abs(n_a[:, None] - n_b[None, :]) <= allowed) & (roots[0][:, None] != roots[1][None, :])
        if may_be.any():
            may_be &= longer - _common(one, two) <= allowed
        pairs = np.argwhere(np.triu(may_be) if same else may_be)
        pairs = pairs[np.argsort(longer[pairs[:, 0], pairs[:, 1]], kind="stable")]  # alike lengths are compared together
        linked: dict[int, int] = {}

        def root(x: int) -> int:
            while x in linked:
                x = linked[x]
            return x

        step = 64
        for start in range(0, len(pairs), step):
            left = [(i, j) for i, j in pairs[start : start + step].tolist() if root(roots[0][i]) != root(roots[1][j])]
            if not left:
                continue
            found = _distances([one[i] for i, _ in left], [two[j] for _, j in left])
            for (i, j), distance in zip(left, found.tolist()):
                x, y = root(roots[0][i]), root(roots[1][j])
                if distance <= allowed[i, j] and x != y:
                    linked[x] = y
                    yield i, j

    return close


def repeated_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Lines that are not the first of their group: doc_id, doc (digest of the text), line, node, root."""
    spark = docs.sparkSession
    for salt in count():
        with staged_for_now(spark):
            found = stage(lines(docs, settings, salt), "lines", outlive=True)
            distinct = stage(line_kinds(found), "line-kinds")
            free_shuffles(spark)
            if distinct.filter("several").isEmpty():
                repeated = stage(line_groups(docs, distinct, settings, salt), "line-groups", outlive=True)
                break
    free_shuffles(spark)
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "line")
    return (
        found.select("doc_id", "doc", "line", "node")
        .join(repeated, "node")
        .filter(~here.eqNullSafe(F.col("kept")))
        .select("doc_id", "doc", "line", "node", "root")
    )


def line_kinds(found: DataFrame) -> DataFrame:
    """Per node its first place, number of lines and fact; ``several``: different lines have it, so another salt is due.

    A node has 64 bits: over 150 million different lines one salt in 1,600 is refused.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "line")
    return found.groupBy("node").agg(
        F.min(place).alias("first"),
        F.count("*").alias("n"),
        F.first("fact").alias("fact"),
        (F.min("other") != F.max("other")).alias("several"),
    )


def brief(fact: Column) -> Column:
    """A line's words (up to 65,535) and its bitmap folded to 48 bits, in one long.

    Folding by exclusive or, bits that differ are never more than those of the bitmaps.
    """
    bits = reduce(lambda x, y: x.bitwiseXOR(y), [fact[k] for k in range(1, 1 + BITS // 64)])
    low = F.lit((1 << 48) - 1)
    folded = bits.bitwiseAND(low).bitwiseXOR(F.shiftrightunsigned(bits, 48))
    return F.shiftleft(F.least(fact[0], F.lit(65_535)), 48).bitwiseOR(folded)


def likely(similarity: float) -> Callable[[Column, Column], Column]:
    """Lines whose briefs don't rule out that they are within the threshold."""

    def condition(a: Column, b: Column) -> Column:
        n_a, n_b = F.shiftrightunsigned(a, 48), F.shiftrightunsigned(b, 48)
        most = F.greatest(n_a, n_b)
        allowed = F.floor(most * F.lit(1 - similarity) + F.lit(1e-9))
        differing = F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit((1 << 48) - 1)))
        return (most == F.lit(65_535)) | ((F.abs(n_a - n_b) <= allowed) & (differing <= 2 * allowed))

    return condition


def line_members(docs: DataFrame, distinct: DataFrame, settings: Settings, salt: int = 0) -> DataFrame:
    """(node, key, brief): the keys of lines that some other line has as well, one of those that have the same lines.

    Large keys all stay, as each of them has runs of its own.
    """
    return _shared(line_keys(docs, settings, salt), distinct, F.when(F.col("n") > linking.SMALL_KEY, F.col("key")))


def _shared(keys: DataFrame, distinct: DataFrame, *apart: Column) -> DataFrame:
    """(node, key, brief) of the keys of two lines or more; of those with the same lines one, for each value of ``apart``."""
    spark = keys.sparkSession
    # Most keys are in one line only; the others are kept, with one exchange for both sides.
    keyed = keys.repartition("key")
    shared = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    kept = stage(keyed.join(shared.hint("shuffle_hash"), "key").select("node", "key").distinct(), "line-keys")
    free_shuffles(spark)
    # 128 bits tell sets of nodes apart.
    sets = kept.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two")
    )
    keys = stage(sets.groupBy("n", "one", "two", *apart).agg(F.min("key").alias("kept")).select(F.col("kept").alias("key")), "line-sets")
    free_shuffles(spark)
    of = distinct.select("node", brief(F.col("fact")).alias("brief"))
    return kept.join(keys, "key").join(of, "node").select("node", "key", "brief")


def line_groups(docs: DataFrame, distinct: DataFrame, settings: Settings, salt: int = 0) -> DataFrame:
    """(node, root, kept) of the lines in groups of two or more; kept is the place of the first."""
    spark = docs.sparkSession
    with staged_for_now(spark):
        members = stage(line_members(docs, distinct, settings, salt), "line-members", outlive=True)
    free_shuffles(spark)

    def texts_of(nodes: DataFrame, packed: bool = False) -> DataFrame:
        wanted = stage(
            distinct.select("node", "first.doc_id", "first.doc").join(nodes, "node", "left_semi"), "line-places"
        )
        return line_texts(docs, wanted, settings, salt, packed)

    def verify(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        texts = stage(texts_of(nodes), "line-texts")
        of = lambda n: texts.select(F.col("node").alias(n), F.col("codes").alias(f"c{n}"))
        return similar(settings.similarity)(pairs.join(of("a"), "a").join(of("b"), "b"))

    def plausible(a: Column, b: Column) -> Column:
        allowed = F.floor(F.greatest(a[0], b[0]) * F.lit(1 - settings.similarity) + F.lit(1e-9))
        differing = sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(1, 1 + BITS // 64)), F.lit(0))
        return (F.abs(a[0] - b[0]) <= allowed) & (differing <= 2 * allowed)

    def elements(nodes: DataFrame) -> DataFrame:
        return texts_of(nodes, packed=True).select("node", F.col("codes").alias("elements"), F.lit(b"").alias("weights"))

    def refine(large: DataFrame) -> DataFrame:
        with staged_for_now(spark):
            found = _shared(run_keys(docs, large, settings, salt), distinct)
            found = stage(found, "line-runs", outlive=True)
        free_shuffles(spark)
        return found

    facts = distinct.select("node", "fact")
    labels, _ = classes(
        members,
        verify,
        settings.seeds,
        elements,
        facts=facts,
        plausible=plausible,
        likely=likely(settings.similarity),
        close=close_lines(settings.similarity),
        block=LINES,
        finer=Finer(refine, near_lines(settings.similarity)),
    )
    rooted = distinct.select("node", "first", "n").join(labels, "node", "left")
    rooted = rooted.select("node", "first", "n", F.coalesce("root", "node").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("lines")).filter("lines > 1")
    return rooted.join(firsts, "root").select("node", "root", "kept")


def removals(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, doc, removed): the sorted numbers of the lines that a text loses."""
    return (
        repeated_lines(docs, settings)
        .groupBy("doc_id", "doc")
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))
    )


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_lines (with a word), n_removed, removed."""
    counted = docs.select(
        "doc_id",
        _text_key().alias("doc"),
        F.size(
            F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        ).alias("n_lines"),
    )
    lost = removals(docs, settings)
    same = counted["doc_id"].eqNullSafe(lost["doc_id"]) & (counted["doc"] == lost["doc"])
    return counted.join(lost, same, "left").select(
        counted["doc_id"],
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without repeated lines; n_chars, where there is one, follows the text."""
    names = docs.columns
    whole = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["doc_id"].alias("_id"), _text_key().alias("_doc"))
    lost = removals(docs, settings).select(F.col("doc_id").alias("_lost_id"), F.col("doc").alias("_lost"), "removed")
    joined = whole.join(lost, (F.col("_doc") == F.col("_lost")) & F.col("_id").eqNullSafe(F.col("_lost_id")), "left")

    @F.pandas_udf("string")
    def rest(texts, removed):
        def cut(text, gone):
            if gone is None or text is None:
                return text
            gone = set(gone.tolist())
            return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)

        return pd.Series([cut(t, r) for t, r in zip(texts, removed)], dtype=object)

    untouched = F.col("removed").isNull()
    out = joined.withColumn("_text", rest(F.col("_row")["text"].cast("string"), F.col("removed"))).filter(
        untouched | F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    )
    changed = {"text": F.col("_text")}
    if "n_chars" in names:
        changed["n_chars"] = F.when(untouched, F.col("_row")["n_chars"]).otherwise(F.length("_text"))
    kinds = dict(docs.dtypes)
    return out.select(
        *[changed[c].cast(kinds[c]).alias(c) if c in changed else F.col("_row")[c].alias(c) for c in names]
    )
