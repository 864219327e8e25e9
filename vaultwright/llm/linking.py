"""From shared keys to classes: star candidates, exact checks, connected components.

``members`` holds (key, node): nodes that share a key are candidates.  Instead of all pairs
of a key, each node is first compared with one node of every key it is in, chosen by a hash
that differs between keys.  That joins large groups of copies with as many pairs as there
are members.  What is left are keys whose nodes still lie in different classes: only there
are the remaining pairs across classes compared, so that no link that would join two
classes is lost, while no pair is made inside a class.

Large keys can be replaced by finer ones, ``Finer``, that similar nodes of a large key must share as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import discard, free_shuffles, stage, staged_for_now

Plausible = Callable[[Column, Column], Column]
Alike = Callable[[tuple, tuple], float]
Packed = tuple[bytes, bytes]
# Pairs of packed sets that link classes: of two blocks, the classes of their sets, and whether they are the same block.
Close = Callable[[list[Packed], list[Packed], tuple[np.ndarray, np.ndarray], bool], Iterator[tuple[int, int]]]
# Of two blocks, the facts of their nodes and their classes: which nodes have a plausible partner of another class.
Near = Callable[[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]

MAX_ROUNDS = 200
SMALL_KEY = 32
BLOCK = 384
NEAR = 4096  # nodes of a block whose facts are compared


@dataclass(frozen=True)
class Finer:
    """``refine``: from large keys to members (node, key, brief) of finer ones; ``near``: see ``Near``."""

    refine: Callable[[DataFrame], DataFrame]
    near: Near


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Labels move to neighbours and then jump to the label of their label, so that the number
    of rounds grows with the logarithm of a component's diameter.
    """
    edges = stage(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(),
        "links",
    )
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    for _ in range(MAX_ROUNDS):
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        moved = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        jumped = stage(
            moved.join(ahead, "next", "left").select(
                "node", F.least("next", F.coalesce("beyond", "next")).alias("root"), F.col("root").alias("before")
            ),
            "labels",
        )
        labels = jumped.select("node", "root")
        if jumped.filter("root <> before").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")


def star_pairs(members: DataFrame, seeds: int) -> DataFrame:
    """Distinct pairs (a, b), a < b: each member of a key with the key's chosen node."""
    order = F.xxhash64("node", F.pmod("key", F.lit(seeds)))
    chosen = (
        members.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct(order.alias("order"), F.col("node").alias("node"))).alias("first"))
        .filter("n > 1")
        .select("key", F.col("first.node").alias("chosen"))
    )
    return _distinct_pairs(members.join(chosen, "key"))


def likely_pairs(members: DataFrame, seeds: int, likely: Plausible) -> DataFrame:
    """Those of ``star_pairs`` that are ``likely`` by the column brief of members, a long as their node is."""
    order = F.xxhash64("node", F.pmod("key", F.lit(seeds)))
    chosen = (
        members.groupBy("key")
        .agg(F.count("*").alias("n"), F.min_by("node", order).alias("chosen"), F.min_by("brief", order).alias("chosen_brief"))
        .filter("n > 1")
        .drop("n")
    )
    return _distinct_pairs(members.join(chosen.hint("shuffle_hash"), "key").filter(likely(F.col("brief"), F.col("chosen_brief"))))


def _distinct_pairs(rows: DataFrame) -> DataFrame:
    pairs = rows.filter("node <> chosen")
    return pairs.select(F.least("node", "chosen").alias("a"), F.greatest("node", "chosen").alias("b")).distinct()


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, root, n) of the keys whose n nodes are not all in one class, and their brief if they have one."""
    more = [c for c in members.columns if c == "brief"]
    rooted = members.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"), *more)
    open_keys = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
        .filter("lo <> hi")
    )
    return stage(rooted.join(open_keys.select("key", "n"), "key").select("key", "node", "root", "n", *more), "open-keys")


def across(
    rows: DataFrame, tested: DataFrame, facts: DataFrame | None, plausible: Plausible | None, likely: Plausible | None = None
) -> DataFrame:
    """The untested pairs of nodes that share a key but not a class, plausible by the nodes' facts and ``likely`` by their briefs."""
    if facts is not None:
        rows = rows.join(facts, "node")
    # Both sides are made alike, so that one exchange serves them.
    one, two = (
        rows.select(F.col("key").alias(f"key_{n}"), F.col("node").alias(n), F.col("root").alias(f"root_{n}"), *_facts(rows, n))
        for n in "ab"
    )
    meet = (F.col("key_a") == F.col("key_b")) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
    if facts is not None:
        meet = meet & plausible(F.col("fact_a"), F.col("fact_b"))
    if likely is not None:
        meet = meet & likely(F.col("brief_a"), F.col("brief_b"))
    return one.join(two, meet).select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")


def _facts(rows: DataFrame, side: str) -> list[Column]:
    return [F.col(c).alias(f"{c}_{side}") for c in ("fact", "brief") if c in rows.columns]


def _only_plausible(pairs: DataFrame, facts: DataFrame | None, plausible: Plausible | None) -> DataFrame:
    if facts is None:
        return pairs
    of = lambda n: facts.select(F.col("node").alias(n), F.col("fact").alias(f"fact_{n}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return stage(both.filter(plausible(F.col("fact_a"), F.col("fact_b"))).select("a", "b"), "pairs")


Weighted = tuple[np.ndarray, np.ndarray]  # hashes, sorted, and weights of at least 1


def _upper(first: list[Weighted], second: list[Weighted]) -> np.ndarray:
    """For every two sets at least their plain and their probability Jaccard similarity.

    Of weights a and b the latter is at most the sum of max(a, b) over common elements, over that of all: an
    element u adds at least max(a_u, b_u) / max(a_x, b_x) to the sum of x.  Sums of min(a, b) are taken from
    below, by whole steps, which is exact where one of the weights is 1.
    """
    sides = (first, second)
    hashes = np.concatenate([h for side in sides for h, _ in side])
    weight = np.concatenate([w for side in sides for _, w in side])
    owner = [np.repeat(np.arange(len(side)), [len(h) for h, _ in side]) for side in sides]
    kinds, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
    edge = len(owner[0])
    heavy = np.zeros(len(kinds), bool)
    heavy[number[weight > 1]] = True
    shape = (len(first), len(second))
    common, more, least = (np.zeros(shape) for _ in range(3))
    for columns in (np.flatnonzero((times > 1) & heavy), np.flatnonzero((times > 1) & ~heavy)):
        place = np.full(len(kinds), -1)
        place[columns] = np.arange(len(columns))
        for start in range(0, len(columns), 4096):  # of a table of sets by elements
            width = min(4096, len(columns) - start)
            tables = []
            for of, part, n in zip(owner, (slice(None, edge), slice(edge, None)), shape):
                at = place[number[part]] - start
                here = (at >= 0) & (at < width)
                table = np.zeros((n, width), np.float32)
                table[of[here], at[here]] = weight[part][here]
                tables.append(table)
            a, b = tables
            in_a, in_b = (a > 0).astype(np.float32), (b > 0).astype(np.float32)
            common += in_a @ in_b.T
            if heavy[columns[0]]:
                more += np.maximum(a - 1, 0) @ in_b.T + in_a @ np.maximum(b - 1, 0).T
                for step in range(2, int(min(a.max(), b.max())) + 1):
                    least += (a >= step).astype(np.float32) @ (b >= step).astype(np.float32).T
    n_a, n_b = (np.array([len(h) for h, _ in side], float) for side in sides)
    w_a, w_b = (np.array([w.sum() for _, w in side], float) for side in sides)
    plain = common / np.maximum(n_a[:, None] + n_b[None, :] - common, 1)
    return np.maximum(plain, (common + more - least) / np.maximum(w_a[:, None] + w_b[None, :] - common - least, 1))


def _close(
    first: list[Weighted], second: list[Weighted], roots: tuple[np.ndarray, np.ndarray], alike: Alike, threshold: float, same: bool
) -> Iterator[tuple[int, int]]:
    """Pairs of sets at least as similar as ``threshold``, one for each two classes; ``same``: first is second."""
    may_be = (_upper(first, second) >= threshold - 1e-4) & (roots[0][:, None] != roots[1][None, :])
    found = set()
    for i, j in np.argwhere(np.triu(may_be) if same else may_be).tolist():
        two = frozenset((int(roots[0][i]), int(roots[1][j])))
        if two not in found and alike(first[i], second[j]) >= threshold:
            found.add(two)
            yield i, j


def packed(hashes: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes]:
    """The elements and weights of a node for ``close_sets``: those with weights above 1 first, and these weights."""
    heavy = weights > 1
    return np.append(hashes[heavy], hashes[~heavy]).tobytes(), weights[heavy].astype(np.float32).tobytes()


def _unpacked(elements: bytes, weights: bytes) -> Weighted:
    hashes, heavy = np.frombuffer(elements, np.uint64), np.frombuffer(weights, np.float32)
    order = np.argsort(hashes)
    return hashes[order], np.append(heavy, np.ones(len(hashes) - len(heavy), np.float32))[order].astype(float)


def close_sets(alike: Alike, threshold: float) -> Close:
    """Pairs that ``alike`` finds similar by ``threshold``, of sets that are ``packed``."""

    def close(first: list[Packed], second: list[Packed], roots: tuple[np.ndarray, np.ndarray], same: bool) -> Iterator[tuple[int, int]]:
        one, two = ([_unpacked(*row) for row in side] for side in (first, second))
        return _close(one, two, roots, alike, threshold, same)

    return close


def _met(rows: DataFrame, size: int) -> DataFrame:
    """(key, i, j, block, node, root): each block of a key, of about ``size`` nodes, meets every other one, and itself."""
    blocks = F.ceil(F.col("n") / size).cast("int")
    placed = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "node",
        "root",
    )


def _together(met: DataFrame) -> DataFrame:
    """Blocks that meet are put into one partition; partitions of few bytes are much work, so they are not merged."""
    return met.repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "i", "j")


def near_members(rows: DataFrame, facts: DataFrame, near: Near) -> DataFrame:
    """(key, node, root, n): the n nodes of a key that have a partner of another class by ``near``.

    Facts are short and quickly compared, so that what is long goes to blocks for these nodes only.
    """
    kinds = dict(rows.dtypes)

    def compare(group: pa.Table) -> pa.Table:
        block = group.column("block").to_numpy()
        of = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column("fact").chunks]).reshape(len(block), -1)
        roots = np.unique(np.array(group.column("root").to_pylist(), dtype=object), return_inverse=True)[1]
        low, high = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        one, two = near(of[low], of[high], (roots[low], roots[high]))
        return group.select(["key", "node", "root"]).take(pa.array(np.union1d(low[one], high[two])))

    found = (
        _together(_met(rows, NEAR).join(facts, "node"))
        .groupBy("key", "i", "j")
        .applyInArrow(compare, f"key {kinds['key']}, node {kinds['node']}, root {kinds['root']}")
        .distinct()
    )
    found = stage(found, "near")
    return found.join(found.groupBy("key").agg(F.count("*").alias("n")), "key")


def across_blocks(rows: DataFrame, sets: DataFrame, close: Close, size: int | None = None) -> DataFrame:
    """Pairs (a, b) that link classes within large keys: those that ``close`` finds.

    ``sets`` has (node, elements, weights), both in bytes: see ``packed`` for those of ``close_sets``.
    Blocks of about ``size`` nodes meet in one place.
    """
    met = _met(rows, size or BLOCK)
    kind = dict(rows.dtypes)["node"]

    def compare(group: pa.Table) -> pa.Table:
        nodes, block = group.column("node").to_pylist(), group.column("block").to_numpy()
        roots = np.unique(np.array(group.column("root").to_pylist(), dtype=object), return_inverse=True)[1]
        sets_ = list(zip(group.column("elements").to_pylist(), group.column("weights").to_pylist()))
        low, high = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        found = close([sets_[k] for k in low], [sets_[k] for k in high], (roots[low], roots[high]), block.min() == block.max())
        pairs = [(nodes[low[i]], nodes[high[j]]) for i, j in found]
        pairs = [(min(p), max(p)) for p in pairs]
        types = group.schema.field("node").type
        return pa.table({"a": pa.array([a for a, _ in pairs], types), "b": pa.array([b for _, b in pairs], types)})

    return (
        _together(met.join(sets, "node"))
        .groupBy("key", "i", "j")
        .applyInArrow(compare, f"a {kind}, b {kind}")
        .distinct()
    )


def finer_pairs(
    rows: DataFrame,
    labels: DataFrame,
    tested: DataFrame,
    facts: DataFrame,
    plausible: Plausible,
    likely: Plausible,
    finer: Finer,
    elements: Callable[[DataFrame], DataFrame],
    close: Close,
    block: int | None,
) -> DataFrame:
    """Pairs (a, b) to verify among the open ``rows``: of small keys, and of finer keys in the place of large ones.

    Each step removes what only it reads, so that shuffles and staged tables of two of them never add up.
    """
    spark = rows.sparkSession
    few = [stage(across(rows.filter(F.col("n") <= SMALL_KEY), tested, None, None, likely), "pairs")]
    free_shuffles(spark)
    blocks = []
    large = stage(rows.filter(F.col("n") > SMALL_KEY).select("key").distinct(), "large-keys")
    discard(rows)
    if not large.isEmpty():
        members = finer.refine(large)
        rows = open_members(members, labels)
        discard(members)
        free_shuffles(spark)
        few.append(stage(across(rows.filter(F.col("n") <= SMALL_KEY), tested, None, None, likely), "pairs"))
        free_shuffles(spark)
        hot = stage(near_members(rows.filter(F.col("n") > SMALL_KEY), facts, finer.near), "near-keys")
        discard(rows)
        free_shuffles(spark)
        if not hot.isEmpty():
            sets = stage(elements(hot.select("node").distinct()), "elements")
            free_shuffles(spark)
            blocks.append(stage(across_blocks(hot, sets, close, block), "pairs"))
            discard(sets)
            free_shuffles(spark)
    pairs = few[0] if len(few) == 1 else few[0].union(few[1]).distinct()
    rest = _only_plausible(pairs, facts, plausible)
    return rest.union(blocks[0]).distinct() if blocks else rest


def classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    seeds: int = 4,
    elements: Callable[[DataFrame], DataFrame] | None = None,
    alike: Alike | None = None,
    threshold: float = 1.0,
    facts: DataFrame | None = None,
    plausible: Plausible | None = None,
    likely: Plausible | None = None,
    close: Close | None = None,
    block: int | None = None,
    finer: Finer | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(node, root) of all linked nodes, and the verified links (a, b) that were needed to find them.

    ``verify`` takes pairs (a, b) and returns those that are similar enough.  ``elements`` gives the
    sets of nodes for ``across_blocks``, which looks for pairs that ``close`` finds, or that ``alike`` finds similar by
    ``threshold``, as ``verify`` does; without it large keys join their pairs as small ones do.  ``facts`` (node, fact) and
    ``plausible``, a condition on the facts of two nodes, leave out pairs before they are verified, and ``likely``, one
    on the members' column brief, before they are made distinct.  ``block`` is the size of the blocks.  With ``finer``,
    which needs all of these, large keys are refined first, and ``members`` are removed once they are read.
    """
    if elements is not None and close is None:
        close = close_sets(alike, threshold)
    spark = members.sparkSession
    tested = stage(star_pairs(members, seeds) if likely is None else likely_pairs(members, seeds, likely), "pairs")
    free_shuffles(spark)
    with staged_for_now(spark):
        links = stage(verify(_only_plausible(tested, facts, plausible)).select("a", "b"), "verified", outlive=True)
    free_shuffles(spark)
    labels = components(links)
    rows = open_members(members, labels)
    if finer is not None:
        discard(members)
    free_shuffles(spark)
    if finer is not None:
        rest = finer_pairs(rows, labels, tested, facts, plausible, likely, finer, elements, close, block)
    else:
        rest = across(rows if elements is None else rows.filter(F.col("n") <= SMALL_KEY), tested, facts, plausible)
    if elements is not None and finer is None:
        large = stage(rows.filter(F.col("n") > SMALL_KEY), "large-keys")
        if not large.isEmpty():
            sets = stage(elements(large.select("node").distinct()), "elements")
            free_shuffles(spark)
            rest = rest.union(across_blocks(large, sets, close, block)).distinct()
    rest = stage(rest, "pairs")
    free_shuffles(spark)
    if not rest.isEmpty():
        more = stage(verify(rest).select("a", "b"), "verified")
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
    return labels, links
