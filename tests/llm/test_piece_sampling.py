"""Sampling against all segmentations of short texts, round trips, independence of batches."""

import itertools
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import collected, prose
from vaultwright.llm import piece_sampling as s


@pytest.fixture(scope="module")
def vocabulary():
    return s.Vocabulary.load(s.default_model())


@pytest.fixture(scope="module")
def small():
    """Bytes and a few pieces, with weights that make long texts of pieces likely."""
    plain = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "é"]
    pieces = [bytes([i]) for i in range(256)] + [p.encode() for p in plain]
    ranks = np.array([0.0] * 256 + [float(3 * i % 7) for i in range(len(plain))])
    return s.Vocabulary(pieces, ranks, np.arange(256, dtype=np.int32))


def segmentations(text, vocabulary):
    """All (ids, weight) by brute force; characters without a piece are bytes."""
    data = s.escape(text)[0]
    known = {p: i for i, p in enumerate(vocabulary.pieces) if i not in set(vocabulary.byte_ids.tolist())}

    def rest(i):
        if i == len(data):
            yield (), 0.0
            return
        for j in range(i + 1, len(data) + 1):
            if data[i:j] in known:
                for ids, w in rest(j):
                    yield (known[data[i:j]], *ids), w + vocabulary.weights[known[data[i:j]]]
        j = i + 1
        while j < len(data) and data[j] & 0xC0 == 0x80:
            j += 1
        if data[i:j] not in known:
            for ids, w in rest(j):
                yield (*vocabulary.byte_ids[list(data[i:j])].tolist(), *ids), w + (j - i) * vocabulary.byte_weight

    return dict(rest(0))


def test_probabilities_and_all_segmentations(small):
    for text in ("abc", "abca bc", "é x\nab", "", "a", "zz"):
        weights = segmentations(text, small) if text else {(): 0.0}
        total = np.logaddexp.reduce(list(weights.values()))
        (found,) = s.sample_texts([text], [7], small, 200)
        assert {tuple(x["ids"].tolist()) for x in found} == set(weights)
        for x in found:
            assert x["log_prob"] == pytest.approx(weights[tuple(x["ids"].tolist())] - total)
            assert x["log_inclusion"] == 0.0
        values = [x["perturbed"] for x in found]
        assert values == sorted(values, reverse=True)


def test_samples_follow_the_distribution_without_replacement(small):
    text, n, k = "abcab", 6000, 3
    weights = segmentations(text, small)
    names, p = list(weights), np.exp(list(weights.values()))
    p /= p.sum()
    expected = Counter()
    for order in itertools.permutations(range(len(names)), k):  # successive draws without replacement
        left, chance = 1.0, 1.0
        for i in order:
            chance *= p[i] / left
            left -= p[i]
        for i in order:
            expected[names[i]] += chance
    first, included, score = Counter(), Counter(), Counter()
    for samples in s.sample_texts([text] * n, list(range(n)), small, k):
        ids = [tuple(x["ids"].tolist()) for x in samples]
        assert len(set(ids)) == k
        first[ids[0]] += 1
        included.update(ids)
        for x in samples:  # inclusion scores weigh samples without bias: they count each segmentation once
            score[tuple(x["ids"].tolist())] += 1 / np.exp(x["log_inclusion"])
    for name, chance in zip(names, p):
        assert first[name] / n == pytest.approx(chance, abs=0.025)
        assert included[name] / n == pytest.approx(expected[name], abs=0.025)
        if chance > 0.02:
            assert score[name] / n == pytest.approx(1, abs=0.2)


TEXTS = ["", " ", "a", "▁x ▁", "tab\tand\nlines\n\n  spaces  ", "日本語 ﬁ é 😀 \u0000", None, "x" * 3000, prose(3, 900), "plain text.", "plain text."]


def test_round_trip(spark, documents, vocabulary):
    docs = documents(list(enumerate(TEXTS)), extra=["rank", "ids", "key"])
    encoded = s.encode(docs, vocabulary, 2)
    back = {(r["doc_id"], r["rank"]): r["text"] for r in s.decoded(encoded, vocabulary).collect()}
    for i, text in enumerate(TEXTS):
        if text is None:
            assert (i, 1) not in back
        else:
            assert back[(i, 1)] == text and back.get((i, 2), text) == text
    checked = s.encode(docs, vocabulary, 2, checked=True)
    assert checked.filter("NOT round_trip").count() == 0
    assert checked.select("doc_id", "ids_digest").distinct().count() == checked.count()


def test_same_samples_in_any_partition(documents, vocabulary):
    docs = documents([(i, prose(i, 40 + i)) for i in range(20)] + [(3, prose(3, 43))])
    one = collected(s.encode(docs.coalesce(1), vocabulary, 3))
    assert one == collected(s.encode(docs.repartition(7), vocabulary, 3))
    assert len(one) == 63


def test_empty_table(documents, vocabulary):
    assert s.encode(documents([]), vocabulary, 2).count() == 0


def test_memory_of_a_batch():
    """Many texts at once take no more memory than some of them: executors of the pipeline have little left for it."""
    vocabulary = s.Vocabulary.load(s.default_model())
    texts = [f"{prose(i, 400)} w{i}" for i in range(900)]
    tracemalloc.start()
    try:
        n = sum(1 for _ in s.sample_texts(texts, list(range(len(texts))), vocabulary, 2))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts) and peak < 50e6
