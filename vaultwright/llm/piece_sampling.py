"""SentencePiece encoding and decoding, with segmentations sampled without replacement.

A text is escaped as SentencePiece does (a space becomes U+2581, one is put in front); every
way to cut it into pieces of the vocabulary is a path through a lattice.  Characters without
a piece of their own are written as bytes, and so is a U+2581 of the text itself, so that
decoding gives back every text exactly.  A piece of rank r weighs ``-temperature * ln(r + 10)``;
the backward sums of the lattice turn weights into exact conditional probabilities.

``k`` distinct segmentations are drawn by Gumbel top-k.  The perturbed log-probability of a
subtree is a Gumbel variable at the subtree's log mass, conditioned on the value of its
parent.  A* takes the open subtree with the largest value, follows the branch that holds its
maximum to a leaf, and opens the other branches on the way with their own truncated
values, in stretches that are split up only when they are the best.  The heuristic, the
exact mass below a node, is the backward sum.  The value of the next open subtree is the
threshold from which inclusion scores follow:
ln P(included) = ln(1 - exp(-exp(log_prob - threshold))).

All noise is a hash of the row key, the number of the sample and the place in the text, so a
row has the same samples in any partition.  As no piece continues over a line feed or from
another character into U+2581, the lattice is kept per unit between those places, once
per distinct unit; masses and paths are those of the whole text.

Defined cases: null stays null (no pieces, zero samples); the empty text has no pieces and
one segmentation; when a text has fewer than ``k`` segmentations, all are returned; rows with
equal key and text have equal samples; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, expm1, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import SpanHashes, hash_words, mix, mix_one

UNIT_BYTES = 1 << 19  # of text that is sampled at a time
CACHED_UNITS = 60_000  # some 100 MB
SPACE = "▁".encode()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces by id (bytes), byte pieces by value, and a hash table from a piece to its id."""

    pieces: list[bytes]
    ranks: np.ndarray
    byte_ids: np.ndarray
    temperature: float = 1.0
    slots: np.ndarray = field(init=False)
    slot_ids: np.ndarray = field(init=False)
    lengths: list[int] = field(init=False)

    def __post_init__(self):
        self.weights = -self.temperature * np.log(self.ranks + 10.0)
        self.byte_weight = -self.temperature * (np.log(len(self.pieces) + 10.0) + 2.0)
        is_byte = np.zeros(len(self.pieces), bool)
        is_byte[self.byte_ids] = True
        shown = [p if b else p.replace(SPACE, b" ") for p, b in zip(self.pieces, is_byte)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)  # what pieces decode to, one after the other
        self.shown_size = np.array([len(p) for p in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        ids = np.array([i for i, p in enumerate(self.pieces) if p and not is_byte[i]])
        words = [self.pieces[i] for i in ids]
        self.lengths = sorted({len(w) for w in words})
        joined = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        hashes = hash_words(joined, ends - [len(w) for w in words], ends)
        # Beginnings of pieces as well, with the id -1, to give up places where no longer piece can follow.
        known = set(words)
        shorter = [w for w in {w[:n] for w in words for n in self.lengths if n < len(w)} if w not in known]
        begun = np.frombuffer(b"".join(shorter), np.uint8)
        begun_ends = np.cumsum([len(w) for w in shorter])
        begun_hashes = hash_words(begun, begun_ends - [len(w) for w in shorter], begun_ends) if shorter else hashes[:0]
        self.slots, self.slot_ids = self._table(
            np.concatenate([hashes, begun_hashes]), np.concatenate([ids, np.full(len(shorter), -1)])
        )

    @staticmethod
    def _table(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Open addressing; some 80,000 entries, -2 for free slots."""
        size = 1 << 18
        slots, slot_ids = [0] * size, [-2] * size
        for h, i in zip(hashes.tolist(), ids.tolist()):
            at = h & (size - 1)
            while slot_ids[at] != -2:
                at = (at + 1) & (size - 1)
            slots[at], slot_ids[at] = h, i
        slots, slot_ids = np.array(slots, np.uint64), np.array(slot_ids, np.int32)
        return slots, slot_ids

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.ranks, self.byte_ids, self.temperature)

    @staticmethod
    def load(path: str, temperature: float = 1.0) -> "Vocabulary":
        """Pieces of a SentencePiece model; their weights follow the order of merges."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        byte_ids = np.full(256, -1, np.int32)
        pieces = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            pieces.append(piece.encode() if plain[i] and not model.is_byte(i) else b"")
        first = int(byte_ids.max()) + 1
        for value, i in enumerate(byte_ids):
            pieces[i] = bytes([value])
        return Vocabulary(pieces, np.maximum(0, np.arange(n) - first).astype(float), byte_ids, temperature)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by hash, -1 for what only begins one, -2 for the rest."""
        mask = np.uint64(len(self.slots) - 1)
        out = np.full(len(hashes), -2, np.int32)
        at, left = (hashes & mask).astype(np.int64), np.arange(len(hashes))
        while len(left):
            ids = self.slot_ids[at]
            hit = (ids != -2) & (self.slots[at] == hashes[left])
            out[left[hit]] = ids[hit]
            more = (ids != -2) & ~hit
            left, at = left[more], (at[more] + 1) & int(mask)
        return out


@dataclass
class Lattice:
    """Edges by start node; nodes are byte offsets into the joined units."""

    buffer: np.ndarray
    starts: np.ndarray  # of the units
    ends: np.ndarray
    first: np.ndarray  # edges of node i: first[i] to first[i + 1]
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray  # id, or -1 for one character as bytes
    logq: np.ndarray  # ln of the conditional probability
    upto: np.ndarray  # cumulated probabilities within a node

    def and_(self, other: "Lattice") -> "Lattice":
        """Both, the other one's units, nodes and edges after these."""
        nodes, edges = len(self.buffer), len(self.target)
        join = lambda a, b, by: np.concatenate([a, b + by])
        return Lattice(
            np.concatenate([self.buffer, other.buffer]),
            join(self.starts, other.starts, nodes),
            join(self.ends, other.ends, nodes),
            # The node behind the last byte has no edges; the other's first node takes its place.
            np.concatenate([self.first[:nodes], other.first + edges]),
            join(self.source, other.source, nodes),
            join(self.target, other.target, nodes),
            np.concatenate([self.piece, other.piece]),
            np.concatenate([self.logq, other.logq]),
            np.concatenate([self.upto, other.upto]),
        )


def build(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary, literal: np.ndarray) -> Lattice:
    """The lattices of adjoining units; ``literal`` marks characters that must be bytes."""
    n = len(buffer)
    unit_end = np.repeat(ends.astype(np.int32), ends - starts)
    head = (buffer & 0xC0) != 0x80  # first byte of a character
    edge_from, edge_to, edge_piece = [], [], []
    positions = np.flatnonzero(head).astype(np.int32)  # a batch and its units are far below 2^31 bytes
    literals = np.append(0, np.cumsum(literal[:n], dtype=np.int32))
    hashes = SpanHashes(buffer)
    for length in vocabulary.lengths:
        positions = positions[positions + length <= unit_end[positions]]
        if not len(positions):
            break
        found = vocabulary.find(hashes(positions, positions + length))
        hit = (found >= 0) & (literals[positions + length] == literals[positions])
        edge_from.append(positions[hit])
        edge_to.append(positions[hit] + length)
        edge_piece.append(found[hit])
        positions = positions[found >= -1]
    heads = np.flatnonzero(head).astype(np.int32)
    size = np.diff(np.append(heads, np.int32(n)))  # bytes of the characters
    single = np.zeros(n, bool)
    size_at = np.zeros(n, np.int32)
    size_at[heads] = size
    for f, t in zip(edge_from, edge_to):
        if len(f) and t[0] - f[0] <= 4:
            single[f[size_at[f] == t - f]] = True
    as_bytes = ~single[heads]
    edge_from.append(heads[as_bytes])
    edge_to.append(heads[as_bytes] + size[as_bytes])
    edge_piece.append(np.full(int(as_bytes.sum()), -1, np.int32))
    # Edges of a node side by side, shorter ones first: each length has at most one edge per node.
    degree = np.zeros(n + 1, np.int32)
    for start in edge_from:
        degree[start] += 1
    first = np.append(np.int32(0), np.cumsum(degree, dtype=np.int32))
    free = first[:-1].copy()
    f, t = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
    p = np.empty(first[-1], np.int32)
    for start, end, piece in zip(edge_from, edge_to, edge_piece):
        at = free[start]
        f[at], t[at], p[at] = start, end, piece
        free[start] += 1
    weight = np.where(p >= 0, vocabulary.weights[p], (t - f) * vocabulary.byte_weight)
    # Backward sums from the unit's end: all units at once, by distance to the end.
    mass = np.full(n + 1, -np.inf)
    end_of = unit_end[f]
    distance = end_of - f
    if len(distance) and distance.max() < 1 << 16:
        distance = distance.astype(np.uint16)  # sorted digit by digit
    by_distance = np.argsort(distance, kind="stable")
    cuts = np.flatnonzero(np.diff(distance[by_distance])) + 1
    value = np.empty(len(f))
    for part in np.split(by_distance, cuts):
        if not len(part):
            continue
        ahead = t[part]
        done = ahead == end_of[part]
        value[part] = v = weight[part] + np.where(done, 0.0, mass[ahead])
        nodes = f[part]
        new = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        top = np.maximum.reduceat(v, new)
        count = np.diff(np.append(new, len(v)))
        mass[nodes[new]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count)), new))
    logq = value - mass[f]
    upto = np.exp(logq)
    begin, size = first[:-1], degree
    k = 1
    while len(begin := begin[size > k]):  # summed up node by node, so that no other text matters
        size = size[size > k]
        upto[begin + k] += upto[begin + k - 1]
        k += 1
    last = first[1:][degree > 0] - 1
    upto[last] = np.inf  # the last edge takes what rounding leaves
    return Lattice(buffer, starts, ends, first, f, t, p, logq, upto)


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((mix(seed) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _uniform_one(seed: int) -> float:
    return ((mix_one(seed) >> 11) + 0.5) * 2.0**-53


def escape(text: str) -> tuple[bytes, list[int]]:
    """The escaped text, and the byte offsets of U+2581 that stood in the text itself."""
    data = text.encode("utf-8", "replace")
    if SPACE not in data:
        return SPACE + data.replace(b" ", SPACE), []
    out, literal = [SPACE], []
    size = len(SPACE)
    for i, part in enumerate(data.split(SPACE)):
        if i:
            literal.append(size)
            out.append(SPACE)
            size += len(SPACE)
        out.append(part.replace(b" ", SPACE))
        size += len(out[-1])
    return b"".join(out), literal


class Lattices:
    """The lattices of the units met so far, up to ``CACHED_UNITS`` before it starts anew."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.lattice = vocabulary, None
        self.known, self.unit = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def units(self, buffer, starts, ends, hashes, literal) -> np.ndarray:
        """Numbers of the spans' units, adding those that are new."""
        if len(self.known) > CACHED_UNITS:
            self.__init__(self.vocabulary)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        place[place == len(self.known)] = 0
        new = self.known[place] != distinct if len(self.known) else np.ones(len(distinct), bool)
        numbers = np.empty(len(distinct), np.int64)
        numbers[~new] = self.unit[place[~new]]
        if new.any():
            at = at[new]
            lengths = ends[at] - starts[at]
            unit_ends = np.cumsum(lengths)
            unit_starts = unit_ends - lengths
            index = np.arange(unit_ends[-1]) - np.repeat(unit_starts, lengths) + np.repeat(starts[at], lengths)
            more = build(buffer[index], unit_starts, unit_ends, self.vocabulary, literal[index])
            numbers[new] = len(self.known) + np.arange(len(at))
            self.lattice = more if self.lattice is None else self.lattice.and_(more)
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.unit = known[order], np.concatenate([self.unit, numbers[new]])[order]
        return numbers[inverse]


class Batch:
    """Several texts with the lattice of their units."""

    def __init__(self, texts: list[str], lattices: Lattices):
        self.vocabulary = lattices.vocabulary
        parts, literals, size = [], [], 0
        edges = [0]
        for text in texts:
            data, literal = escape(text) if text else (b"", [])
            parts.append(data)
            literals += [size + i for i in literal]
            size += len(data)
            edges.append(size)
        buffer = np.frombuffer(b"".join(parts), np.uint8)
        literal = np.zeros(len(buffer) + 1, bool)
        literal[literals] = True
        starts = self._unit_starts(buffer, np.array(edges), literal)
        ends = np.append(starts[1:], len(buffer)) if len(starts) else starts
        self.text_units = np.searchsorted(starts, edges)  # units of text i
        if not len(starts):
            self.units, self.lattice = np.zeros(0, np.int64), None
            return
        hashes = hash_words(buffer, starts, ends)
        if literals:  # a unit with a literal U+2581 is another one
            marked = np.searchsorted(starts, literals, side="right") - 1
            places = np.array(literals) - starts[marked]
            np.bitwise_xor.at(hashes, marked, mix(places))
        self.units = lattices.units(buffer, starts, ends, hashes, literal)
        self.lattice = lattices.lattice

    @staticmethod
    def _unit_starts(buffer: np.ndarray, edges: np.ndarray, literal: np.ndarray) -> np.ndarray:
        space = np.zeros(len(buffer) + 3, bool)
        at = np.flatnonzero((buffer[:-2] == SPACE[0]) & (buffer[1:-1] == SPACE[1]) & (buffer[2:] == SPACE[2]))
        at = at[~literal[at]]
        space[at] = space[at + 1] = space[at + 2] = True
        new = np.zeros(len(buffer), bool)
        new[at] = True
        new[at[(at > 0) & space[at - 1]]] = False  # a run of spaces begins one unit
        lines = np.flatnonzero(buffer == 10)
        new[lines] = True
        after = lines + 1
        new[after[after < len(buffer)]] = True
        inner = edges[edges < len(buffer)]
        new[inner] = True
        return np.flatnonzero(new)

    def descend(self, units: np.ndarray, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A random path from each node to the end of its unit: edges in order, and the number per unit."""
        lat = self.lattice
        ends = lat.ends[units]
        active, at = np.arange(len(units)), nodes.copy()
        whose, chosen = [], []
        counts = np.zeros(len(units), np.int64)
        step = np.uint64(0)
        open_ = at < ends
        active, at = active[open_], at[open_]
        while len(active):
            step += np.uint64(1)
            u = _uniform(seeds[active] + step) if len(active) < len(seeds) else _uniform(seeds + step)
            edge = lat.first[at]
            wrong = np.flatnonzero(u > lat.upto[edge])
            while len(wrong):
                edge[wrong] += 1
                wrong = wrong[u[wrong] > lat.upto[edge[wrong]]]
            whose.append(active)
            chosen.append(edge)
            counts[active] += 1
            at = lat.target[edge]
            on = at < ends[active]
            active, at = active[on], at[on]
        path = np.empty(int(counts.sum()), np.int64)
        start = np.cumsum(counts) - counts
        for k, (active, edge) in enumerate(zip(whose, chosen)):
            path[start[active] + k] = edge
        return path, counts

    def sample(self, keys: list[int], k: int) -> list[tuple[list[tuple[float, float, np.ndarray]], float]]:
        """Per text up to k (perturbed, log_prob, edges), largest first, and the threshold (-inf if none is left).

        The texts take their next sample together, so that one pass over arrays descends in all.
        """
        searches = [
            _Search(self, self.units[a:b], key, k) for a, b, key in zip(self.text_units[:-1], self.text_units[1:], keys)
        ]
        while waiting := [s for s in searches if s.wants_descent()]:
            parts = [s.begin() for s in waiting]
            units, nodes, seeds = (np.concatenate(x) for x in zip(*parts))
            path, counts = self.descend(units, nodes, seeds)
            ends = np.append(0, np.cumsum(counts))
            unit = 0
            for search, (rest, _, _) in zip(waiting, parts):
                a, b = ends[unit], ends[unit + len(rest)]
                search.finish(path[a:b], counts[unit : unit + len(rest)])
                unit += len(rest)
        return [(s.out, -s.heap[0][0] if s.heap else -np.inf) for s in searches]

    def ids(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """Piece ids along paths."""
        lat = self.lattice
        if lat is None or not paths:
            return [np.zeros(0, np.int32) for _ in paths]
        edges = np.concatenate(paths)
        ends = np.cumsum([len(x) for x in paths])
        out = lat.piece[edges]
        as_bytes = np.flatnonzero(out < 0)
        if len(as_bytes):
            starts = lat.source[edges]
            counts = np.ones(len(edges), np.int64)
            counts[as_bytes] = lat.target[edges[as_bytes]] - starts[as_bytes]
            after = np.cumsum(counts)
            out = np.repeat(out, counts)
            at = np.flatnonzero(out < 0)
            of = np.repeat(as_bytes, counts[as_bytes])
            out[at] = self.vocabulary.byte_ids[lat.buffer[starts[of] + at - (after - counts)[of]]]
            ends = np.where(ends > 0, np.append(0, after)[ends], 0)
        return np.split(out, ends[:-1])


class _Search:
    """A* over the segmentations of one text.

    Open are subtrees of two kinds: all paths below one node, and all paths that leave a
    known path in one stretch of it.  A stretch is split into its branches only when it is
    the best; its mass is the difference of the masses at its two ends.
    """

    def __init__(self, batch: Batch, units: np.ndarray, key: int, k: int):
        self.lattice, self.units, self.k = batch.lattice, units, k
        self.row = mix_one(key & (1 << 64) - 1)
        self.out: list[tuple[float, float, np.ndarray]] = []
        self.opened = 0
        self.heap: list[tuple] = []  # minus value, number, subtree
        root = -log(-log(_uniform_one(self.row)))
        if len(units):
            self._push(root, (np.zeros(0, np.int64), 0, int(self.lattice.starts[units[0]]), 0.0))
        else:
            self.out.append((root, 0.0, np.zeros(0, np.int64)))

    def _push(self, value: float, subtree: tuple) -> None:
        self.opened += 1
        heapq.heappush(self.heap, (-value, self.opened, subtree))

    def _noise(self, number: int) -> np.uint64:
        return np.uint64(mix_one(self.row ^ number))

    def wants_descent(self) -> bool:
        """Open the best subtrees until a node below which a path is unknown is on top."""
        while self.heap and len(self.out) < self.k:
            minus, number, subtree = self.heap[0]
            if len(subtree) == 4 and subtree[1] < len(self.units):
                return True
            heapq.heappop(self.heap)
            if len(subtree) == 4:  # one path, all of it known
                self.out.append((-minus, subtree[3], subtree[0]))
            else:
                self._split(-minus, number, *subtree)
        return False

    def begin(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.now = heapq.heappop(self.heap)
        _, number, (_, done, node, _) = self.now
        rest = self.units[done:]
        nodes = self.lattice.starts[rest].copy()
        nodes[0] = node
        return rest, nodes, mix(np.arange(done, len(self.units), dtype=np.uint64) ^ self._noise(number))

    def finish(self, path: np.ndarray, counts: np.ndarray) -> None:
        """Take the leaf at the end of ``path`` and open the stretches along it."""
        minus, number, (prefix, done, _, before) = self.now
        total = np.zeros(len(path) + 1)
        np.cumsum(self.lattice.logq[path], out=total[1:])
        self.out.append((-minus, float(before + total[-1]), np.concatenate([prefix, path]) if len(prefix) else path))
        cuts = _cuts(len(path))
        known = (path, total, before, counts, prefix, done)
        found, noise = [], int(self._noise(number)) ^ 1 << 40
        here = before + float(total[0])
        for c, stop in enumerate(cuts[1:]):  # a dozen of numbers: plain ones are faster than arrays
            there = before + float(total[stop])
            lost = -expm1(min(there - here, 0.0))
            if lost > 0:
                mass = here + log(lost)
                g = log(-log(_uniform_one(noise ^ c))) - mass
                low, high = min(g, minus), max(g, minus)
                found.append((high + log1p(exp(low - high)), c))
            here = there
        wanted = self.k - len(self.out) + 1  # further samples and the threshold
        for value, c in heapq.nsmallest(wanted, found):
            self._push(-value, (known, cuts[c], cuts[c + 1], None, None))

    def _split(self, value: float, number: int, known: tuple, start: int, stop: int, *_: None) -> None:
        """Open the branches of a stretch, one of which holds its largest value."""
        path, total, before, counts, prefix, done = known
        lat = self.lattice
        nodes = lat.source[path[start:stop]]
        lo = lat.first[nodes]
        degree = lat.first[nodes + 1] - lo
        place = np.repeat(np.arange(start, stop), degree)
        edge = np.repeat(lo - np.cumsum(degree) + degree, degree) + np.arange(len(place))
        other = edge != path[place]
        place, edge = place[other], edge[other]
        if not len(edge):
            return
        phi = before + total[place] + lat.logq[edge]
        noise = self._noise(number)
        seeds = mix(np.arange(len(edge) + 1, dtype=np.uint64) ^ noise)
        share = np.cumsum(np.exp(phi - phi.max()))
        best = min(int(np.searchsorted(share, _uniform_one(int(seeds[-1])) * share[-1])), len(edge) - 1)
        values = _truncated(phi, value, seeds[:-1])
        values[best] = value
        wanted = self.k - len(self.out) + 1
        chosen = np.argsort(-values, kind="stable")[:wanted]
        unit_of = np.searchsorted(np.cumsum(counts), place[chosen], side="right") + done
        for c, unit in zip(chosen.tolist(), unit_of.tolist()):
            node = int(lat.target[edge[c]])
            if node == int(lat.ends[self.units[unit]]):
                unit += 1
                node = int(lat.starts[self.units[unit]]) if unit < len(self.units) else node
            whole = np.concatenate([prefix, path[: place[c]], edge[c : c + 1]]).astype(np.int64)
            self._push(float(values[c]), (whole, unit, node, float(phi[c])))


@lru_cache(maxsize=4096)
def _cuts(n: int) -> list[int]:
    """Ends of stretches that double in length: 0, 8, 16, 32, ... n."""
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(min(n, max(8, 2 * cuts[-1])))
    return cuts


def _truncated(phi: np.ndarray, value: float, seed: np.ndarray) -> np.ndarray:
    """Gumbel values at ``phi`` of the branches not taken, given that the maximum is ``value``.

    The value of the largest branch is independent of which branch holds it, so the ones not
    taken are Gumbel variables at their own mass, cut off at the maximum.
    """
    # exp(-g) = exp(-value) + E / exp(phi) with E a unit exponential
    log_e = np.log(-np.log(_uniform(seed))) - phi
    return -np.logaddexp(-value, log_e)


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of piece ids: their strings side by side, without the space in front."""
    size = vocabulary.shown_size[ids]
    ends = np.cumsum(size)
    at = np.repeat(vocabulary.shown_start[ids] - ends + size, size)
    at += np.arange(len(at))
    return vocabulary.shown[at].tobytes()[1:].decode("utf-8", "replace")


SAMPLE = "rank int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids array<int>"


def log_inclusion(log_prob: float, threshold: float) -> float:
    if threshold == -np.inf:
        return 0.0
    z = log_prob - threshold  # ln of exp(log_prob - threshold)
    return float(z - 0.5 * np.exp(z)) if z < -30 else float(np.log(-np.expm1(-np.exp(min(z, 700.0)))))


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= UNIT_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def sample_texts(texts: list[str | None], keys: list[int], vocabulary: Vocabulary, k: int) -> Iterator[list[dict]]:
    """For every text its samples, best first."""
    lattices = Lattices(vocabulary)
    for i, j in _groups(texts):
        batch = Batch([t or "" for t in texts[i:j]], lattices)
        sampled = batch.sample(keys[i:j], k)
        ids = iter(batch.ids([edges for found, _ in sampled for _, _, edges in found]))
        for text, (found, threshold) in zip(texts[i:j], sampled):
            rows = [
                {
                    "rank": rank,
                    "log_prob": log_prob,
                    "perturbed": value,
                    "log_inclusion": log_inclusion(log_prob, threshold),
                    "ids": next(ids),
                }
                for rank, (value, log_prob, _) in enumerate(found, 1)
            ]
            yield rows if text is not None else []


def encode(docs: DataFrame, vocabulary: Vocabulary, k: int, checked: bool = False) -> DataFrame:
    """One row per document and sample: doc_id and SAMPLE.

    With ``checked`` the ids are decoded again; instead of them comes ``ids_digest``, their
    MD5 as little-endian 32-bit numbers, and ``round_trip``, whether decoding gave the text.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64(F.col("doc_id").cast("string")))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a fixed file of some 32,000 pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        own = shared.value
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
            owner, found, size = [], [], 0
            for n, samples in enumerate(sample_texts(texts, keys, own, k)):
                for s in samples:
                    s["n_pieces"] = len(s["ids"])
                    if checked:
                        s["ids_digest"] = hashlib.md5(s["ids"].astype("<i4").tobytes()).hexdigest()
                        s["round_trip"] = decode(s["ids"], own) == texts[n].encode("utf-8", "replace").decode()
                        del s["ids"]
                    else:
                        size += len(s["ids"])
                    owner.append(n)
                    found.append(s)
                if size > 1 << 20 or len(found) > 4096:
                    yield _rows(batch, owner, found)
                    owner, found, size = [], [], 0
            yield _rows(batch, owner, found)

    def _rows(batch, owner, found):
        names = _CHECKED if checked else _IDS
        columns = [pa.array([s[c] for s in found], t) for c, t in names.items()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(owner, pa.int64())), *columns], names=["doc_id", *names]
        )

    kind = dict(docs.dtypes)["doc_id"]
    last = "ids_digest string, round_trip boolean" if checked else "ids array<int>"
    schema = f"doc_id {kind}, rank int, n_pieces long, log_prob double, perturbed double, log_inclusion double, {last}"
    return rows.mapInArrow(run, schema)


_IDS = {
    "rank": pa.int32(), "n_pieces": pa.int64(), "log_prob": pa.float64(), "perturbed": pa.float64(),
    "log_inclusion": pa.float64(), "ids": pa.list_(pa.int32()),
}
_CHECKED = {c: t for c, t in _IDS.items() if c != "ids"} | {"ids_digest": pa.string(), "round_trip": pa.bool_()}


def decoded(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with the column ``text`` instead of ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def text_of(ids):
        return ids.map(lambda x: None if x is None else decode(np.asarray(x), shared.value))

    return encoded.withColumn("text", text_of("ids")).drop("ids")
