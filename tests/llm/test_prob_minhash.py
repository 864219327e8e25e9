"""Signatures against exact similarity, classes against comparing all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from tests.llm.conftest import collected, prose
from vaultwright.llm import linking
from vaultwright.llm import prob_minhash as p

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def weighted(text):
    words = WORD.findall(text.lower())
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    counts = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    return {g: 1 + np.log2(n) for g, n in counts.items()}


def exact(a, b):
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    prob = sum(1 / sum(max(a.get(u, 0) / a[x], b.get(u, 0) / b[x]) for u in a.keys() | b.keys()) for x in a.keys() & b.keys())
    return plain, prob


def edited(text, k, seed):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(k):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_similarity_is_exact():
    texts = [prose(1, 60), edited(prose(1, 60), 2, 5), prose(1, 60) + " " + prose(1, 30), "a b", "a b c d e f"]
    owner, hashes, counts = p.shingles(texts, 5)
    sets = [(hashes[owner == i], p.weights(counts[owner == i])) for i in range(len(texts))]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert p.similarity(sets[i], sets[j]) == pytest.approx(max(exact(weighted(texts[i]), weighted(texts[j]))))
    assert [int((owner == i).sum()) for i in range(len(texts))] == [len(weighted(t)) for t in texts]


def test_registers_agree_with_probability_jaccard():
    registers, errors = 1024, []
    for seed in range(12):
        text = prose(seed, 90) + " " + prose(seed, 40)
        pair = [text, edited(text, seed, seed)]
        owner, hashes, counts = p.shingles(pair, 5)
        signed = p.signatures(owner, hashes, p.weights(counts), 2, registers)
        errors.append((signed[0] == signed[1]).mean() - exact(*map(weighted, pair))[1])
    assert np.abs(errors).max() < 0.07 and abs(np.mean(errors)) < 0.02


def test_signatures_do_not_depend_on_the_batch():
    texts = [prose(i, 30 + i) for i in range(6)]
    owner, hashes, counts = p.shingles(texts, 5)
    together = p.signatures(owner, hashes, p.weights(counts), 6, 96)
    for i, t in enumerate(texts):
        owner, hashes, counts = p.shingles([t], 5)
        assert (p.signatures(owner, hashes, p.weights(counts), 1, 96)[0] == together[i]).all()


def corpus():
    rng, rows = random.Random(11), []
    for family in range(8):
        text = prose(family, 120)
        rows += [edited(text, rng.randrange(0, 6), rng.random()) for _ in range(12)]
    rows += [prose(100 + i, 50) for i in range(20)] + ["one two three", "one two three", "One Two Three", "one two four"]
    rows += [None, "", " \n", prose(0, 120), prose(0, 120)]
    return [(i, t) for i, t in enumerate(rows)]


def brute_classes(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: weighted(t) for i, t in rows if t and weighted(t)}
    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if a.keys() & b.keys() and max(exact(a, b)) >= 0.8:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((i, find(i)) for i, _ in rows)


def test_classes_equal_all_pairs(documents):
    rows = corpus()
    found = p.document_classes(documents(rows, extra=["node", "keys", "class_id", "kept"]))
    assert collected(found, "doc_id", "class_id") == sorted(brute_classes(rows), key=repr)
    sizes = {}
    for _, c in brute_classes(rows):
        sizes[c] = sizes.get(c, 0) + 1
    assert all(r["class_size"] == sizes[r["class_id"]] for r in found.collect())
    assert sorted(r["doc_id"] for r in found.filter("kept").collect()) == sorted(sizes)


def test_keep_one_and_repeated_rows(documents):
    rows = corpus() + [(3, prose(500, 40)), (3, prose(500, 40)), (None, prose(600, 40)), (None, prose(600, 40)), (None, None)]
    docs = documents(rows, extra=["_key", "class_size", "n"])
    kept = p.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    classes = {c for _, c in brute_classes(corpus())}
    assert sorted(i for i in ids if i is not None) == sorted([*classes, 3])
    assert ids.count(None) == 2


def test_empty_table(documents):
    assert p.document_classes(documents([])).count() == 0
    assert p.keep_one(documents([])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame(chain + star + [(200, 201), (201, 200)], "a long, b long")
    found = dict(collected(linking.components(links)))
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 160)) and found[201] == 200


def test_no_link_between_classes_is_lost(spark):
    """Members of one key, similar only to their neighbours: a star cannot join them, the second step does."""
    members = spark.createDataFrame([(1, i) for i in range(30)] + [(2, i) for i in range(50, 53)], "key long, node long")
    labels, _ = linking.classes(members, lambda pairs: pairs.filter("b - a = 1"))
    found = dict(collected(labels))
    assert set(found[i] for i in range(30)) == {0} and set(found[i] for i in range(50, 53)) == {50}


def test_large_keys_in_blocks(spark, documents, monkeypatch):
    """One family of look-alikes: many share bands, few are similar; blocks find the links that stars miss."""
    monkeypatch.setattr(linking, "SMALL_KEY", 4)
    monkeypatch.setattr(linking, "BLOCK", 8)
    base, rows = prose(1, 150), []
    for i in range(40):
        one = edited(base, 6, i)
        rows += [(2 * i, one), (2 * i + 1, edited(one, 1 if i % 2 else 6, 1000 + i))]
    found = p.document_classes(documents(rows))
    assert collected(found, "doc_id", "class_id") == sorted(brute_classes(rows), key=repr)


def repeating(own, seed):
    """A passage that comes eight times, then words of one text only."""
    return " ".join([prose(1, 100)] * 8 + [f"own{seed}x{i}" for i in range(own)])


def test_large_keys_link_what_small_keys_link(documents, monkeypatch):
    """Texts alike by their repeated shingles only: a key's size must not decide whether they are linked."""
    rows = [(i, repeating(20 if i % 8 == 0 else 60 + 3 * i, i)) for i in range(48)]
    sets = [weighted(t) for _, t in rows]
    assert exact(sets[0], sets[8])[0] < 0.8 < exact(sets[0], sets[8])[1]
    found = []
    for small, block in ((1000, 384), (4, 8)):
        monkeypatch.setattr(linking, "SMALL_KEY", small)
        monkeypatch.setattr(linking, "BLOCK", block)
        # Without stars, keys have to find all links.
        monkeypatch.setattr(linking, "star_pairs", lambda members, seeds: members.limit(0).selectExpr("node AS a", "node AS b"))
        found.append(collected(p.document_classes(documents(rows)), "doc_id", "class_id"))
    assert found[0] == found[1]
    assert {c for i, c in found[0] if i % 8 == 0} == {0}


def test_upper_bound_of_similarity():
    rng = np.random.default_rng(5)
    texts = []
    for i in range(24):
        words = [f"w{k}" for k in rng.integers(0, 12 + 4 * (i % 5), 60)]
        texts.append(" ".join(words * int(rng.integers(1, 5)) + [f"x{i}"]))
    texts += [repeating(20, 1), repeating(20, 2), "a b", "a b", prose(3, 80), edited(prose(3, 80), 2, 1)]
    owner, hashes, counts = p.shingles(texts, 2)
    sets = [(hashes[owner == i], p.weights(counts[owner == i])) for i in range(len(texts))]
    for i, one in enumerate(sets):  # as they come back from packing
        for a, b in zip(one, linking._unpacked(*linking.packed(*one))):
            assert a == pytest.approx(b)
    upper = linking._upper(sets, sets)
    for i, j in itertools.product(range(len(sets)), repeat=2):
        assert upper[i, j] >= p.similarity(sets[i], sets[j]) - 1e-5
