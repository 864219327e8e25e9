"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document's shingles of five lower-case words carry the weight 1 + log2(count).  Every
shingle sends a Poisson process of arrivals at the rate of its weight into the registers of
the signature; a register keeps its earliest arrival.  Arrivals come in rounds, one per
shingle, and a shingle stops as soon as it is later than every register, so a signature of
m registers costs about (shingles + m log m) arrivals.  Two registers agree with the
probability Jaccard similarity of the weights.  Signatures are cut into bands; documents
with an equal band are candidates and are verified on their exact shingles: similar are
those with a probability Jaccard or a plain Jaccard similarity of at least ``threshold``.

Exact copies are one node, whatever their number.  A class is a connected group of links.

Defined cases: texts of one to four words have one shingle, all of their words; null texts
and texts without a word are never similar to anything; ties (equal texts, repeated rows)
share a class, whose id and kept document is the smallest doc_id; a null doc_id is larger
than all others; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import hash_words, mix, stage, word_spans
from vaultwright.llm.linking import classes, packed

SMALL_NODES = 500_000  # of 16 bytes: broadcast up to this many
PIECE_BYTES = 1 << 20  # of text that are turned into shingles at once


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 4
    seeds: int = 4


def shingles(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: number of the text, hash, count; sorted by text and hash."""
    encoded = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    buffer = np.frombuffer(b"\n".join(encoded), np.uint8)
    starts, ends = word_spans(buffer)
    edges = np.cumsum([0] + [len(e) + 1 for e in encoded])
    first = np.searchsorted(starts, edges)  # words of text i: first[i] to first[i + 1]
    counts = np.diff(first)
    hashes = hash_words(buffer, starts, ends)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        joined = np.zeros(n, np.uint64)
        for k in range(words):
            after = np.zeros(n, np.uint64)
            after[: n - k] = hashes[k:]
            joined = mix(joined ^ after)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(n) - first[owner]
    whole = place + words <= counts[owner]
    owner, joined = owner[whole], joined[whole]
    for i in np.flatnonzero((counts > 0) & (counts < words)):  # short texts: all words are one shingle
        own = hashes[first[i] : first[i + 1]]
        value = np.uint64(len(own))
        for h in own:
            value = mix(np.array([value ^ h], np.uint64))[0]
        owner, joined = np.append(owner, i), np.append(joined, value)
    order = np.lexsort((joined, owner))
    owner, joined = owner[order], joined[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (joined[1:] != joined[:-1]))
    at = np.flatnonzero(new)
    return owner[at], joined[at], np.diff(np.append(at, len(joined)))


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log2(counts)


def signatures(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures, one row of ``registers`` hashes per text; zeros for a text without shingles."""
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(hashes))
    active, draw = np.arange(len(hashes)), np.uint64(0)
    while len(active):
        draw += np.uint64(1)
        random = mix(hashes[active] ^ mix(np.array([draw], np.uint64)))
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[active] -= np.log(uniform) / weight[active]
        register = (mix(random) % np.uint64(registers)).astype(np.int64) + owner[active] * registers
        now = time[active]
        np.minimum.at(earliest, register, now)
        won = earliest[register] == now
        winner[register[won]] = hashes[active[won]]
        latest = earliest.reshape(n, registers).max(axis=1)
        active = active[now < latest[owner[active]]]
    return winner.reshape(n, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger one of probability and plain Jaccard similarity of two (sorted hashes, weights)."""
    (ha, wa), (hb, wb) = a, b
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    plain = len(common) / (len(ha) + len(hb) - len(common))
    x, y = wa[ia], wb[ib]
    if (x == y).all() and len(common) == len(ha) == len(hb):
        return 1.0
    # Sum over all elements u of max(a_u / a_x, b_u / b_x), by the order of the ratios b_u / a_u.
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    sum_x = np.append(0, np.cumsum(x))
    sum_y = np.append(0, np.cumsum(y))
    upto = np.searchsorted(ratio, ratio, side="right")
    alone_a, alone_b = wa.sum() - sum_x[-1], wb.sum() - sum_y[-1]
    total = (alone_a + sum_x[upto]) / x + (alone_b + sum_y[-1] - sum_y[upto]) / y
    return max(plain, float((1 / total).sum()))


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= PIECE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _node() -> F.Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def band_keys(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, node, keys) of every document with a word; node is a digest of the text."""
    registers = settings.bands * settings.rows
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.filter(rows["text"].rlike(r"[^\x20\x09-\x0D]")).withColumn("node", _node())

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in _pieces(texts):
                owner, hashes, counts = shingles(texts[i:j], settings.words)
                signed = signatures(owner, hashes, weights(counts), j - i, registers)
                keys = np.zeros((j - i, settings.bands), np.uint64)
                for k in range(settings.rows):
                    keys = mix(keys ^ signed[:, k :: settings.rows])
                keys = mix(keys ^ np.arange(1, settings.bands + 1, dtype=np.uint64)).view(np.int64)
                part = batch.slice(i, j - i)
                offsets = pa.array(np.arange(0, keys.size + 1, settings.bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("node"), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                    names=["doc_id", "node", "keys"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(sign, f"doc_id {kind}, node binary, keys array<long>")


def shingle_table(docs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """(node, hashes, weights) of the texts whose node is in ``nodes``, one row per text."""
    if nodes.count() <= SMALL_NODES:  # then the texts are filtered where they are read
        nodes = F.broadcast(nodes)
    rows = docs.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    rows = rows.withColumn("node", _node()).join(nodes, "node", "left_semi").dropDuplicates(["node"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in _pieces(texts):
                owner, hashes, counts = shingles(texts[i:j], settings.words)
                offsets = pa.array(np.searchsorted(owner, np.arange(j - i + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(i, j - i).column("node"),
                        pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(weights(counts).astype(np.float32))),
                    ],
                    names=["node", "hashes", "weights"],
                )

    return rows.select("node", "text").mapInArrow(cut, "node binary, hashes array<long>, weights array<float>")


def elements(docs: DataFrame, settings: Settings):
    """Shingles of nodes and their weights, to look for links in large bands."""

    def of(nodes: DataFrame) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [batch.column(c) for c in ("hashes", "weights")]
                flat = [c.flatten().to_numpy(zero_copy_only=False) for c in lists]
                ends = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in lists]
                rows = [
                    packed(*(f[e[i] : e[i + 1]] for f, e in zip((flat[0].view(np.uint64), flat[1]), ends)))
                    for i in range(batch.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), *(pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))],
                    names=["node", "elements", "weights"],
                )

        return shingle_table(docs, nodes, settings).mapInArrow(pack, "node binary, elements binary, weights binary")

    return of


def verifier(docs: DataFrame, settings: Settings):
    def verify(pairs: DataFrame) -> DataFrame:
        nodes = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
        sets = stage(shingle_table(docs, nodes, settings), "shingles")
        of = lambda n: sets.select(
            F.col("node").alias(n), F.col("hashes").alias(f"h{n}"), F.col("weights").alias(f"w{n}")
        )

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = {n: batch.column(n) for n in ("ha", "wa", "hb", "wb")}
                flat = {n: c.flatten().to_numpy(zero_copy_only=False) for n, c in lists.items()}
                ends = {n: c.offsets.to_numpy() - c.offsets[0].as_py() for n, c in lists.items()}
                cut = lambda n, i: flat[n][ends[n][i] : ends[n][i + 1]]
                found = [
                    similarity(
                        (cut("ha", i).view(np.uint64), cut("wa", i).astype(float)),
                        (cut("hb", i).view(np.uint64), cut("wb", i).astype(float)),
                    )
                    for i in range(batch.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"]
                )

        both = pairs.join(of("a"), "a").join(of("b"), "b")
        scored = both.select("a", "b", "ha", "wa", "hb", "wb").mapInArrow(
            compare, "a binary, b binary, similarity double"
        )
        return scored.filter(F.col("similarity") >= settings.threshold)

    return verify


def document_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, node, class_id, class_size (documents), n_links (verified links of its text), kept."""
    texts = stage(
        band_keys(docs, settings)
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("keys").alias("keys")),
        "texts",
    )
    members = texts.select("node", F.explode("keys").alias("key"))
    labels, links = classes(
        members,
        verifier(docs, settings),
        settings.seeds,
        elements(docs, settings),
        similarity,
        settings.threshold,
    )
    degree = (
        links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    )
    rooted = stage(
        texts.join(labels, "node", "left")
        .join(degree, "node", "left")
        .select(
            "node",
            F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "node").alias("first"),
            "copies",
            F.coalesce("root", "node").alias("root"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "rooted",
    )
    whole = rooted.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("copies").alias("class_size"))
    of_text = rooted.join(whole, "root").select("node", "keeper", "class_size", "n_links")
    ids = docs.select("doc_id", _node_or_null().alias("node"))
    own = F.col("doc_id").eqNullSafe(F.col("keeper.first_id")) & (F.col("node") == F.col("keeper.node"))
    return ids.join(of_text, "node", "left").select(
        "doc_id",
        "node",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("keeper.first_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("class_size").isNull() | own).alias("kept"),
    )


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without all but one of each class, otherwise unchanged."""
    found = stage(document_classes(docs, settings).filter("class_size > 1").select("doc_id", "node", "kept"), "classes")
    gone = stage(found.filter("NOT kept").select("doc_id", "node").distinct(), "gone")
    repeated = stage(found.filter("kept").groupBy("doc_id", "node").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].alias("_id"), _node_or_null().alias("_node")
    )

    def these(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("_key_id"), F.col("node").alias("_key"))
        if keys.count() <= SMALL_NODES:
            keys = F.broadcast(keys)
        return rows.join(keys, (F.col("_node") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_key_id")), how)

    left = these(whole, gone, "left_anti")
    if not repeated.isEmpty():  # equal rows of one doc_id and text: one of them stays
        once = these(left, repeated, "left_semi").dropDuplicates(["_id", "_node"])
        left = these(left, repeated, "left_anti").union(once)
    return left.select("_row.*")


def _node_or_null() -> F.Column:
    text = F.col("text").cast("string")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(text.cast("binary"))))
