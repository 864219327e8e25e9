"""Collocations against counts of all phrases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import collected
from vaultwright.llm import collocations


def plainly(rows, least=30, most=2000, subsumed=80):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            lower = lower.replace(c, "\n")
        for piece in lower.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            sizes[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if a >= least and len(p) > 1]
        longer = defaultdict(int)
        for q in candidates:
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    longer[q[i : i + size]] = max(longer[q[i : i + size]], f[q])
        scored = []
        for p in candidates:
            a = f[p]
            if 100 * longer[p] >= subsumed * a:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["Été", "a b", "\x00", "x-y", " "]
    fixed = ["new york city hall", "in spite of", "a a a a a", "of the"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(60)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else words[min(int(rng.expovariate(0.2)), len(words) - 1)])
            if rng.random() < 0.15:
                parts[-1] += rng.choice([".", ",", "!\n", "\r\n", ";x", "\x0b", "  ", "\t"])
        text = " ".join(parts)
        rows.append((i, text.upper() if rng.random() < 0.1 else text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, None, "en"), (5, "", "fr"), (6, " \t. ", "fr"), *rows[:3]]


def frame(spark, rows):
    schema = "doc_id long, text string, lang string"
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS prefix", "2 AS phrase", "'x' AS rank", "0 AS n").repartition(5)


@pytest.mark.parametrize(
    "seed,options",
    [(1, {}), (2, {"entries_at_once": 40, "hot_parts": 3}), (3, {"most_bits": 15, "hot_parts": 1})],
)
def test_equals_plain_counts(spark, monkeypatch, seed, options):
    monkeypatch.setattr(collocations, "WORDS_AT_ONCE", 500)
    rows = corpus(seed)
    expected = plainly(rows, least=8)
    assert len(expected) > 50 and len({r[0] for r in expected}) >= 3
    assert collected(collocations.mine(frame(spark, rows), least=8, **options)) == expected


def test_first_of_many_and_ties(spark):
    rows = [(i, f"{a} {b}", "en") for i in range(6) for a in "abcde" for b in "vwxyz"]
    expected = plainly(rows, least=3, most=7)
    assert len(expected) == 7 and len({r[7] for r in expected}) == 1
    assert collected(collocations.mine(frame(spark, rows), least=3, most=7)) == expected


def test_one_hot_line_and_nothing(spark):
    rows = [(i, "all rights reserved by us. " * 20, "en") for i in range(40)]
    assert collected(collocations.mine(frame(spark, rows))) == plainly(rows)
    for none in ([], [(1, None, None)], [(1, " . ", "en")]):
        assert collocations.mine(frame(spark, none)).count() == 0


def test_bitmap_has_no_false_miss(spark):
    phrases = [("en", f"w{i} v{i % 7}") for i in range(500)] + [("de", f"é{i}") for i in range(300)]
    found = collocations.bitmap_of(spark.createDataFrame(phrases, "lang string, phrase string"), 20)
    from zlib import crc32

    for lang, phrase in phrases:
        sums = [np.array([crc32(w.encode())]) for w in phrase.split(" ")]
        assert found.hits(lang.encode(), *sums)[0]
        if len(sums) == 1:
            assert found.has(crc32(lang.encode()), int(sums[0][0]))
    others = [np.array([crc32(f"o{i}".encode()) for i in range(2000)])] * 2
    assert found.hits(b"en", *others).mean() < 0.1
