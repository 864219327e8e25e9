"""Toxicity as a weighted finite-state grammar over clauses.

Small transducers read the words of a clause as classes (insult, threat, target, negation,
report, other): one opens a negated scope after a negation, one a reported scope after a
verb of speech, one notes whom the words are aimed at.  Their product is compiled into one
table; run over a clause, it writes the weight of each insult or threat into a channel
(plain, aimed, negated, reported).  A text's channel totals, not its isolated words, are
what the score sees.

Learned from labelled rows only: the weights of words and word stems (log odds of occurring
in toxic texts; short seed lists give threats, targets, negations and reports) and one
weight per channel.  Learning uses at most ``max_labelled`` labelled documents, those with
the smallest hash of doc_id; every document is scored over its whole text.

Defined cases: null or empty texts have empty channels and get the score of a text without
any match; several labels of a document count as toxic if one does; labels other than 0 and 1 are not
used; with labels of one kind only, or none, every score is that share (0 if none); equal
rows get equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import fold, stage

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
CHANNELS = ("plain", "aimed", "negated", "reported")

SEEDS = {
    THREAT: "kill hurt destroy beat smash shoot stab murder strangle töten umbringen schlagen tuer frapper "
    "matar golpear pegar",
    TARGET: "you your yours yourself he she they them him her u ur du dich dir dein deine ihr euch tu te toi ton "
    "vous votre ti tus usted ustedes ellos",
    NEGATION: "not no never nobody isn't aren't wasn't don't nicht kein keine nie pas jamais ne nunca nadie",
    REPORT: "said says say called calls told claimed claims wrote quoted sagte sagt nannte dit disait appelle "
    "dijo dice llamó",
}
_CLAUSE_END = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_EDGE = re.compile(r"[^\W_]")


class Transducer:
    """States 0..n-1 from 0; ``step`` maps (state, class) to (state, mark)."""

    def __init__(self, states: int, step):
        self.states = states
        self.table = [[step(s, c) for c in range(6)] for s in range(states)]

    @staticmethod
    def scope(opener: int, length: int) -> "Transducer":
        """Marks the ``length`` words after an opener."""

        def step(left, c):
            return (length, left > 0) if c == opener else (max(left - 1, 0), left > 0)

        return Transducer(length + 1, step)


def compose(*parts: Transducer) -> list[list[tuple[int, int]]]:
    """The product: per state and class the next state and the marks as bits."""
    states = list(itertools.product(*[range(p.states) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    return [
        [
            (
                number[tuple(p.table[s][c][0] for p, s in zip(parts, state))],
                sum(p.table[s][c][1] << bit for bit, (p, s) in enumerate(zip(parts, state))),
            )
            for c in range(6)
        ]
        for state in states
    ]


NEGATED, REPORTED, AIMED = 1, 2, 4
GRAMMAR = compose(
    Transducer.scope(NEGATION, 3),
    Transducer.scope(REPORT, 12),
    Transducer.scope(TARGET, 5),
)


@dataclass(frozen=True)
class Settings:
    max_labelled: int = 20_000
    min_support: int = 5
    min_weight: float = 2.5
    max_entries: int = 4096
    stems: tuple[int, ...] = (4, 5, 6)


class Lexicon:
    """Words, and stems marked by a final ``*``, with weights; finds them at the start of words."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        self.weights = weights
        self.classes = {w: c for c, words in SEEDS.items() for w in words.split()}
        self.finder = ahocorasick.Automaton()
        for entry in sorted({*weights, *SEEDS[THREAT].split()}):  # a stem after the word of the same letters
            self.finder.add_word(entry.rstrip("*"), entry)
        if len(self.finder):
            self.finder.make_automaton()

    def __reduce__(self):
        return Lexicon, (self.weights,)

    def word(self, word: str) -> tuple[int, float]:
        weight = self.weights.get(word)
        if weight is None:
            stem = next((s for n in (4, 5, 6) if len(word) > n and (s := word[:n] + "*") in self.weights), None)
            weight = self.weights[stem] if stem else None
        known = self.classes.get(word, OTHER)
        if weight is not None:
            return (THREAT if known == THREAT else INSULT), weight
        return known, 1.0 if known == THREAT else 0.0

    def channels(self, text: str | None) -> list[float]:
        totals = [0.0] * len(CHANNELS)
        if not text or not len(self.finder):
            return totals
        low, done = text.lower(), -1
        for end, entry in self.finder.iter(low):
            start = end + 1 - len(entry.rstrip("*"))
            if start < done or start and _EDGE.match(low, start - 1):
                continue
            if not entry.endswith("*") and end + 1 < len(low) and _EDGE.match(low, end + 1):
                continue
            # The clause around the match, read once.
            left = max((low.rfind(c, 0, start) for c in ".!?;:\n"), default=-1) + 1
            stop = _CLAUSE_END.search(low, end + 1)
            done = stop.start() if stop else len(low)
            state = 0
            for token in _TOKEN.findall(low, max(left, 0), done):
                kind, weight = self.word(token)
                state, marks = GRAMMAR[state][kind]
                if kind in (INSULT, THREAT):
                    channel = 3 if marks & REPORTED else 2 if marks & NEGATED else 1 if marks & AIMED else 0
                    totals[channel] += weight
        return totals


def _features(channels: list[float]) -> list[float]:
    return [f for c in channels for f in (float(c > 0), np.log1p(c))]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    coefficients: tuple[float, ...]

    def score(self, text: str | None) -> tuple[float, list[float]]:
        channels = self.lexicon.channels(text)
        z = self.coefficients[0] + float(np.dot(self.coefficients[1:], _features(channels)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40)))), channels


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the channels' weights are never negative."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _entries(text: str, stems: tuple[int, ...]) -> set[str]:
    words = set(_TOKEN.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in stems if len(w) > n}


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    labelled = (
        labels.filter(F.col("toxic").isin(0, 1) & (fold("doc_id") != 0) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(settings.max_labelled)
    )
    sample = stage(
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
            F.broadcast(labelled), F.col("doc_id") == F.col("labelled_id")
        ),
        "toxicity-sample",
    ).select("text", "toxic")
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        return Model(Lexicon({}), (40.0 if toxic else -40.0, *[0.0] * (2 * len(CHANNELS))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[label].update(_entries(text, settings.stems))
        kept = list(counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.string()), pa.array([counts[1][k] for k in kept], pa.int64())]
            + [pa.array([0] * len(kept), pa.int64())],
            names=["entry", "toxic", "clean"],
        )
        kept = list(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.string()), pa.array([0] * len(kept), pa.int64())]
            + [pa.array([counts[0][k] for k in kept], pa.int64())],
            names=["entry", "toxic", "clean"],
        )

    odds = F.log(
        (F.col("toxic") + 0.5) / (toxic + 1.0) / ((F.col("clean") + 0.5) / (clean + 1.0))
    )
    found = (
        sample.mapInArrow(count, "entry string, toxic long, clean long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= settings.min_support)
        .withColumn("weight", F.round(odds, 6))
        .filter(F.col("weight") >= settings.min_weight)
        .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "entry")
        .limit(settings.max_entries)
        .collect()
    )
    weights = {r["entry"]: r["weight"] for r in found}
    for entry in list(weights):  # a stem stands for the longer entries that begin with it
        word = entry.rstrip("*")
        if any(len(word) > n and weights.get(word[:n] + "*", -1.0) >= weights[entry] - 1 for n in settings.stems):
            del weights[entry]
    lexicon = Lexicon(weights)

    @F.pandas_udf("array<double>")
    def channels(texts):
        return texts.map(lexicon.channels)

    rows = sample.select("toxic", channels("text").alias("c")).collect()  # at most max_labelled short rows
    x = np.array([_features(r["c"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    return Model(lexicon, tuple(float(v) for v in _fit(x, y)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and the channels of every text."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (fold("doc_id") == 0).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = [model.score(t) for t in batch.column("text").to_pylist()]
            values = [s for s, _ in scored]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64())]
                + [pa.array([int(s >= 0.5) for s in values], pa.int32())]
                + [pa.array([c[i] for _, c in scored], pa.float64()) for i in range(len(CHANNELS))],
                names=["doc_id", "held_out", "score", "predicted", *CHANNELS],
            )

    kind = dict(docs.dtypes)["doc_id"]
    columns = ", ".join(f"{c} double" for c in CHANNELS)
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, {columns}")
