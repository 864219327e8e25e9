"""Collocations by the stripes pattern: each prefix keys a counter of the words that follow it.

A text is cut at punctuation into pieces and those into words.  A prefix of one to three words owns a
stripe: how often each next word follows it, and how often nothing worth counting does (the rest).
Tasks build stripes in memory, as sorted numbers, and hand them on at ``entries_at_once`` entries.  Stripes of
one prefix are merged elementwise after a shuffle: they arrive sorted by prefix and are added up
one prefix at a time.  From merged stripes follow

* extensions: phrase = prefix + next word, with its count;
* prefix totals: the sum of a stripe with its rest is the count of the prefix itself;
* subsumption maxima: the largest entry of a stripe is the most frequent extension to the right; grouped by
  the phrase without its first word, entries give the most frequent extension to the left.

A phrase is a candidate with ``least`` occurrences, and then all its parts are.  So stripes are built length by
length: a prefix enters only if it may be that frequent, and a next word only if the phrase that it
ends may be.  The tests are bitmaps of hashed phrases, built by Spark from the counts of the pass before.  Their size
follows the number of entries up to ``2^most_bits`` bits; a false hit costs shuffle volume and never a result.  Stripes of a prefix
that starts with more than a thousandth of all words (so at most a thousand) are dealt to ``hot_parts`` parts by
next word, so no task holds the stripe of a hot prefix alone.

Defined cases: a null text is empty, a null language is ``und``; an empty table and texts without words give an
empty result; equal texts count as often as they occur; ties in score go to the larger count, then to the smaller phrase
in bytes; other columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultwright.llm.common import stage

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BREAK = b"\xff"  # stands for the end of a piece; no byte of UTF-8
# Upper case to lower case, tab to space, ends of pieces to BREAK.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + BREAK * len(_BREAKS))
STRIPE = "lang string, prefix string, part int, rest long, nexts array<string>, counts array<long>"
HOT_SHARE = 1000
BITS_PER_ENTRY = 64
RANKING_PARTS = 64
WORDS_AT_ONCE = 1 << 20
# Odd factors of the checksums of a phrase's words.
_FACTORS = (0x2545F, 0x1B873, 0x6A09F)
_ID_BITS = 31


def tokens(text: str) -> list[bytes]:
    """The words of a text, and BREAK between pieces."""
    # Only spaces are left of the bytes at which split() cuts.
    return text.encode().translate(_PLAIN).replace(BREAK, b" " + BREAK + b" ").split()


class Bitmap:
    """Phrases that may be frequent, by their language and the checksums of their words."""

    def __init__(self, bits: bytes, size: int):
        self._bits, self._mask = np.frombuffer(bits, np.uint8), size - 1

    def has(self, lang: int, checksum: int) -> bool:
        """For one word, with the checksum of its language."""
        place = lang + checksum * _FACTORS[0] & self._mask
        return self._bits[place >> 3] >> (place & 7) & 1 == 1

    def hits(self, lang: bytes, *checksums: np.ndarray) -> np.ndarray:
        place = np.full(len(checksums[0]), crc32(lang), np.int64)
        for checksum, factor in zip(checksums, _FACTORS):
            place += checksum * factor
        place &= self._mask
        return (self._bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(frequent: DataFrame, most_bits: int) -> Bitmap:
    """A bitmap of (lang, phrase) with up to three words, built in Spark; at most 2^most_bits bits reach the driver."""
    entries = frequent.count()
    bits = min(max(ceil(log2(max(1, entries * BITS_PER_ENTRY))), 15), most_bits)
    checksum = lambda c: F.crc32(c.cast("binary"))
    words = F.split("phrase", " ")
    place = checksum(F.col("lang"))
    for i, factor in enumerate(_FACTORS):
        place = place + F.coalesce(checksum(F.get(words, F.lit(i))) * factor, F.lit(0))
    placed = frequent.select(place.bitwiseAND(F.lit((1 << bits) - 1)).alias("place"))
    chunk = 1 << 15  # bits of one bitmap of Spark
    found = placed.groupBy(F.floor(F.col("place") / chunk).alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("place") % chunk).alias("bitmap")
    )
    whole = bytearray((1 << bits) // 8)
    for row in found.toLocalIterator():
        whole[row.chunk * chunk // 8 : (row.chunk + 1) * chunk // 8] = row.bitmap
    return Bitmap(bytes(whole), 1 << bits)


class Words(dict):
    """Numbers of the words of a language that may be frequent, from 1; 0 for all else."""

    def __init__(self, lang: bytes, known: Bitmap, most_others: int = 200_000):
        self._lang, self._known, self._spare = crc32(lang), known, most_others
        self.names, self.checksums = [b""], [0]
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        checksum = crc32(word)
        if self._known.has(self._lang, checksum):
            self[word] = number = len(self.names)
            self.names.append(word)
            self.checksums.append(checksum)
            return number
        if self._spare:  # remembered as long as there is room
            self._spare -= 1
            self[word] = 0
        return 0


def unique_rows(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of some columns of small numbers, sorted, and how often (or with what sum) each occurs."""
    n_rows = len(columns[0])
    if not n_rows:
        return columns, np.zeros(0, np.int64)
    bits = [int(c.max()).bit_length() for c in columns]
    if sum(bits) <= 63:  # a row fits a number, and numbers sort much faster
        key = columns[0].astype(np.int64)
        for column, width in zip(columns[1:], bits[1:]):
            key = key << width | column
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key = key[starts]
        found = []
        for width in reversed(bits):
            found.append((key & ((1 << width) - 1)).astype(np.int32))
            key = key >> width
        found.reverse()
    else:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        starts = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))
        found, counts = [c[starts] for c in columns], None if counts is None else counts[order]
    if counts is None:
        return found, np.diff(np.append(starts, n_rows))
    return found, np.add.reduceat(counts, starts)


class Stripes:
    """Counts of (prefix, next word) of a language for prefixes of one length, as rows of word numbers."""

    def __init__(self, lang: bytes, length: int, known: Bitmap, phrases: Bitmap | None, hot: frozenset, hot_parts: int):
        self._lang, self._length, self._phrases, self._hot, self._hot_parts = lang, length, phrases, hot, hot_parts
        self.words = Words(lang, known)
        self._stream: list[int] = []
        self._rows: list[list[np.ndarray]] = []  # not counted yet
        self._counted: tuple[list[np.ndarray], np.ndarray] | None = None
        self._waiting = 0

    @property
    def entries(self) -> int:
        return 0 if self._counted is None else len(self._counted[1])

    def add(self, text: str) -> None:
        words = self.words
        self._stream += [words[word] for word in tokens(text)]
        self._stream.append(0)
        if len(self._stream) >= WORDS_AT_ONCE:
            self._take()

    def _take(self) -> None:
        """Turn the words that wait into rows: prefixes that may be frequent, and the word after if that phrase may be, too."""
        n = self._length
        ids = np.array([*self._stream, *[0] * (n + 1)], np.int32)
        self._stream = []
        often = ids > 0
        for i in range(1, n):
            often[:-i] &= ids[i:] > 0
        if self._phrases is not None:
            at = np.flatnonzero(often)
            checksums = np.array(self.words.checksums, np.int64)
            often[at] = self._phrases.hits(self._lang, *[checksums[ids[at + i]] for i in range(n)])
        at = np.flatnonzero(often)
        self._rows.append([*[ids[at + i] for i in range(n)], np.where(often[at + 1], ids[at + n], 0).astype(np.int32)])
        self._waiting += len(at)
        if self._waiting >= 4 * WORDS_AT_ONCE:
            self._count()

    def _count(self) -> None:
        found = unique_rows([np.concatenate(c) for c in zip(*self._rows)])
        self._rows, self._waiting = [], 0
        if self._counted is not None:
            both = [np.concatenate(c) for c in zip(self._counted[0], found[0])]
            found = unique_rows(both, np.concatenate([self._counted[1], found[1]]))
        self._counted = found

    def given(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; nothing may be added afterwards."""
        if self._stream:
            self._take()
        if self._rows:
            self._count()
        if not self.entries:
            return
        names = pa.array(self.words.names, pa.binary()).cast(pa.string())
        (*ids, following), counts = self._counted
        hot = np.array([name in self._hot for name in self.words.names])
        parts = np.array(self.words.checksums, np.int64) % self._hot_parts
        part = np.where(hot[ids[0]] & (following > 0), parts[following], 0)
        if hot.any():
            order = np.lexsort((following, part, *reversed(ids)))
            ids, part, following, counts = [i[order] for i in ids], part[order], following[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in (*ids, part)], axis=0)]))
        entry = following > 0
        offsets = np.concatenate([np.cumsum(entry) - entry, [entry.sum()]])[[*starts, len(part)]].astype(np.int32)
        texts = [names.take(pa.array(i[starts])) for i in ids]
        whole = pa.RecordBatch.from_arrays(
            [
                pa.array([self._lang.decode()] * len(starts), pa.string()),
                texts[0] if len(texts) == 1 else pc.binary_join_element_wise(*texts, " "),
                pa.array(part[starts].astype(np.int32)),
                pa.array(np.add.reduceat(np.where(entry, 0, counts), starts)),
                pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(following[entry]))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts[entry])),
            ],
            ["lang", "prefix", "part", "rest", "nexts", "counts"],
        )
        for i in range(0, whole.num_rows, 50_000):
            yield whole.slice(i, 50_000)


def count_words(docs: DataFrame, entries_at_once: int, parts: int) -> DataFrame:
    """Each task's stripes of the empty prefix, whose entries are the words, dealt to parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = defaultdict(Counter)

        def given(lang: str, counter: Counter) -> pa.RecordBatch:
            counter.pop(BREAK, None)
            stripes: list[tuple[list, list]] = [([], []) for _ in range(parts)]
            for word, count in counter.items():
                nexts, counts = stripes[crc32(word) % parts]
                nexts.append(word.decode())
                counts.append(count)
            counter.clear()
            return _merged([(lang, "", i, 0, *stripe) for i, stripe in enumerate(stripes)], "rest")

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                counter = counters[lang]
                counter.update(tokens(text.as_py() or ""))
                if len(counter) >= entries_at_once:
                    yield given(lang, counter)
        for lang, counter in counters.items():
            yield given(lang, counter)

    return docs.mapInArrow(run, STRIPE)


def build_stripes(
    docs: DataFrame, length: int, known: Bitmap, phrases: Bitmap | None, hot: dict, hot_parts: int, entries_at_once: int
) -> DataFrame:
    """Each task's stripes of prefixes of ``length`` words, those of two and more being in ``phrases``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, Stripes] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                stripes = by_lang.get(lang)
                if stripes is None:
                    name = lang.encode()
                    stripes = Stripes(name, length, known, phrases, hot.get(name, frozenset()), hot_parts)
                    by_lang[lang] = stripes
                stripes.add(text.as_py() or "")
                if stripes.entries >= entries_at_once or len(stripes.words.names) >= entries_at_once:
                    yield from by_lang.pop(lang).given()
        for stripes in by_lang.values():
            yield from stripes.given()

    return docs.mapInArrow(run, STRIPE)


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """One stripe per (lang, prefix, part), with its total; entries below ``least`` count in the total only."""

    def merged(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table | None]:
        """The finished stripes, and the one that may go on in the next batch."""
        keys = [rows.column(i).combine_chunks() for i in range(3)]
        differs = np.zeros(rows.num_rows, bool)
        differs[0] = True
        for key in keys:
            differs[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        starts, run_of = np.flatnonzero(differs), np.cumsum(differs) - 1
        nexts, counts = (rows.column(c).combine_chunks() for c in ("nexts", "counts"))
        lengths = pc.list_value_length(nexts).to_numpy()
        entries = pa.table({"run": np.repeat(run_of, lengths), "next": nexts.flatten(), "count": counts.flatten()})
        sums = entries.group_by(["run", "next"], use_threads=False).aggregate([("count", "sum")])
        run, count = sums.column("run").to_numpy(), sums.column("count_sum").to_numpy()
        totals = np.add.reduceat(rows.column("rest").to_numpy(), starts)
        n_done = len(starts) if last else len(starts) - 1

        def batch(runs: np.ndarray, kept: np.ndarray, numbers: np.ndarray, name: str) -> pa.RecordBatch:
            kept = kept[np.argsort(run[kept], kind="stable")]
            ends = np.searchsorted(run[kept], runs, side="right")
            offsets = pa.array(np.concatenate([[np.searchsorted(run[kept], runs[0])] if len(runs) else [0], ends]).astype(np.int32))
            words = sums.column("next").combine_chunks().take(pa.array(kept))
            lists = [pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(count[kept]))]
            columns = [*[key.take(pa.array(starts[runs])) for key in keys], pa.array(numbers), *lists]
            return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", name, "nexts", "counts"])

        whole = totals.copy()
        np.add.at(whole, run, count)
        done = batch(np.arange(n_done), np.flatnonzero((count >= least) & (run < n_done)), whole[:n_done], "total")
        if last:
            return done, None
        rest = batch(np.arange(n_done, n_done + 1), np.flatnonzero(run == n_done), totals[n_done:], "rest")
        return done, pa.Table.from_batches([rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_stripe = None
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                done, open_stripe = merged(pa.concat_tables([open_stripe, rows]) if open_stripe else rows, False)
                if done.num_rows:
                    yield done
        if open_stripe:
            yield merged(open_stripe, True)[0]

    keys = ["lang", "prefix", "part"]
    dealt = stripes.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, STRIPE.replace("rest", "total"))


def _merged(done: list[tuple], number: str = "total") -> pa.RecordBatch:
    columns = [[r[i] for r in done] for i in range(6)]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
    names = ["lang", "prefix", "part", number, "nexts", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _extensions(merged: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the entries."""
    return merged.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e")).select(
        "lang", F.concat_ws(" ", "prefix", "e.nexts").alias("phrase"), F.col("e.counts").alias("f")
    )


def stripes(
    docs: DataFrame,
    least: int = 30,
    text: str = "text",
    lang: str = "lang",
    hot_parts: int = 64,
    entries_at_once: int = 2_000_000,
    most_bits: int = 28,
) -> tuple[DataFrame, DataFrame]:
    """Merged stripes of prefixes of one to three words, and per language the number of words n."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))

    def built(parts: DataFrame, name: str) -> DataFrame:
        return stage(merge_stripes(parts, least), f"collocations-{name}")

    first = built(count_words(rows, entries_at_once // 8, hot_parts), "words")
    sizes = first.groupBy("lang").agg(F.sum("total").alias("n"))
    words = _extensions(first).select("lang", F.ltrim("phrase").alias("phrase"), "f")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot: dict[bytes, frozenset] = defaultdict(frozenset)
    for r in words.filter(F.col("f") * HOT_SHARE > total).collect():  # below HOT_SHARE rows
        hot[r.lang.encode()] |= {r.phrase.encode()}
    known = phrases = bitmap_of(words, most_bits)
    found = None
    for length in (1, 2, 3):
        parts = build_stripes(rows, length, known, phrases if length > 1 else None, hot, hot_parts, entries_at_once)
        merged = built(parts, f"{length}")
        phrases = bitmap_of(_extensions(merged), most_bits) if length < 3 else None
        found = merged if found is None else found.unionByName(merged)
    return found, sizes


def mine(
    docs: DataFrame,
    least: int = 30,
    most: int = 2000,
    scale: int = 2_000_000,
    subsumed: int = 80,
    text: str = "text",
    lang: str = "lang",
    **sizes,
) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase scores floor(scale * a / (l + r)) at the cut into two parts where that is lowest, l and r being the counts of
    the parts.  Phrases inside a longer candidate with at least ``subsumed`` percent of their count are dropped.
    """
    merged, words = stripes(docs, least, text, lang, **sizes)
    totals = merged.groupBy("lang", "prefix").agg(F.sum("total").alias("f")).filter(F.col("f") >= least)
    extensions = _extensions(merged)
    size = F.size(F.split("phrase", " "))
    longest = extensions.filter(size == 4)
    # The totals are the counts of phrases of up to three words; those of four are entries only.
    counts = totals.withColumnRenamed("prefix", "phrase").unionByName(longest)
    candidates = stage(counts.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 1), "collocations-candidates")

    longest_right = merged.filter(F.size("counts") > 0).groupBy("lang", F.col("prefix").alias("phrase")).agg(
        F.max(F.array_max("counts")).alias("f")
    )
    longest_left = extensions.select("lang", F.substring_index("phrase", " ", 1).alias("head"), "phrase", "f").select(
        "lang", F.expr("substring(phrase, char_length(head) + 2)").alias("phrase"), "f"
    )
    inside = longest_right.unionByName(longest_left).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    whole = (
        candidates.join(inside, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("f") * subsumed))
        .select("lang", "phrase", F.col("f").alias("a"), "words")
    )
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("second"),
    )
    of_first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    of_second = counts.select("lang", F.col("phrase").alias("second"), F.col("f").alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(19, 0)) * {scale}) DIV (CAST(l AS DECIMAL(19, 0)) + r)")
    scored = (
        cuts.join(of_first, ["lang", "first"])
        .join(of_second, ["lang", "second"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.crc32(F.col("phrase").cast("binary")), F.lit(RANKING_PARTS))
    leaders = (
        scored.withColumn("salt", salt)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        .filter(F.col("rank") <= most)
    )
    ranked = leaders.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (
        ranked.filter(F.col("rank") <= most)
        .join(words, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19, 0)")
