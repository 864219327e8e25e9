"""Fuzzy lines against comparing all pairs."""

import itertools
import random
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import collected, prose
from vaultwright.llm import line_dedup as d
from vaultwright.llm import linking
from vaultwright.staging import shared_folder


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def replaced(line, k, seed):
    rng, words = random.Random(seed), line.split(" ")
    for i in rng.sample(range(len(words)), k):
        words[i] = words[i][::-1] + "x"
    return " ".join(words)


def corpus():
    rng, rows = random.Random(4), []
    lines = [" ".join(prose(i, n).split()) for i, n in enumerate([8, 12, 20, 25, 30, 40, 90] * 3)]
    for i in range(60):
        own = [" ".join(prose(1000 + 10 * i + k, 30).split()) for k in range(2)]
        for line in rng.sample(lines, 2):
            own.insert(rng.randrange(3), replaced(line, rng.choice([0, 1, 1]) if 230 < len(line) < 275 or len(line) > 500 else 0, rng.random()))
        rows.append((i, "\n".join([*own, "As.", ""])))
    return rows + [(70, None), (71, ""), (72, rows[0][1]), (72, rows[0][1]), (None, rows[1][1]), (73, "to be\n\nto be\nTo, be!")]


def brute(rows, settings):
    """(doc_id, text, line) of what goes; similar lines are within two replaced words, or equal."""
    order = sorted({(i is None, i or 0, t or "") for i, t in rows}, key=lambda r: (r[0], r[1], d.hashlib.md5(r[2].encode()).digest()))
    places = [(k, n, c) for k, (_, _, t) in enumerate(order) for n, c in d._split(t, settings.least_words)]
    kinds = sorted({c for _, _, c in places})
    root = {c: c for c in kinds}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in itertools.combinations(kinds, 2):
        x, y = a.split(), b.split()
        allowed = int(max(len(x), len(y)) * (1 - settings.similarity) + 1e-9)
        if abs(len(x) - len(y)) <= allowed and len(set(x) ^ set(y)) < 24 and distance(x, y) <= allowed:
            root[find(a)] = find(b)
    seen, gone = set(), set()
    for k, n, c in places:
        if find(c) in seen:
            gone.add((None if order[k][0] else order[k][1], order[k][2], n))
        seen.add(find(c))
    return gone


def test_removals_equal_all_pairs(documents):
    settings, rows = d.Settings(), corpus()
    gone = brute(rows, settings)
    docs = documents(rows, extra=["line", "node", "doc", "removed"])
    expected = sorted(((i, sorted(n for j, x, n in gone if (j, x) == (i, t or ""))) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["removed"]) for r in d.report(docs).collect()), key=repr) == expected
    kept = d.dedup(docs)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    left = []
    for i, t in rows:
        own = {n for j, x, n in gone if (j, x) == (i, t or "")}
        text = t if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if n not in own)
        if not own or text.strip():
            left.append((i, text))
    assert found == sorted(left, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.filter("text IS NOT NULL").collect())


@pytest.mark.parametrize("words, changes", [(40, 1), (70, 2), (90, 2)])
def test_replaced_words_always_meet(words, changes):
    for seed in range(60):
        line = d.normalise(" ".join(prose(seed, words).split()))
        a, b = d.keys_of([line, d.normalise(replaced(line, changes, seed))], d.Settings())
        assert set(a) & set(b)


def test_hot_line_and_many_variants(documents):
    line = " ".join(prose(1, 40).split())
    rows = [(i, replaced(line, i % 3, i) + "\n" + " ".join(prose(2000 + i, 20).split())) for i in range(300)]
    found = {r["doc_id"]: r["removed"] for r in d.report(documents(rows)).collect()}
    assert found[0] == [] and all(found[i] == [0] for i in range(1, 300))


def test_empty_table(documents):
    assert d.report(documents([])).count() == 0
    assert d.dedup(documents([])).count() == 0


def test_keys_do_not_depend_on_the_batch():
    lines = [d.normalise(" ".join(prose(i, 10 + i).split())) for i in range(40)]
    together = d.keys_of(lines, d.Settings())
    assert together == [d.keys_of([line], d.Settings())[0] for line in lines]
    assert collected is not None


def edited(line, edits, seed):
    """Words replaced, dropped and added, evenly spread as well as at random, at most ``edits`` in all."""
    rng, words = random.Random(seed), line.split(" ")
    step = len(words) / (edits + 1)
    places = [int((i + 1) * step) for i in range(edits)] if seed % 2 else rng.sample(range(len(words)), edits)
    for i in sorted(places, reverse=True):
        words[i : i + 1] = rng.choice([["other"], [], [words[i], "more"]] if seed % 3 else [["other"]])
    return " ".join(words)


@pytest.mark.parametrize("words", [7, 8, 9, 10, 13, 14, 15, 20, 27, 40, 60, 90, 150, 300])
def test_all_changes_of_the_threshold_meet(words):
    settings, missed = d.Settings(), []
    for seed in range(60):
        line = d.normalise(" ".join(prose(seed, words).split()))
        changed = edited(line, int(words * (1 - settings.similarity) + 1e-9), seed)
        longer = max(words, len(changed.split()))
        assert distance(line.split(), changed.split()) <= int(longer * (1 - settings.similarity) + 1e-9)
        a, b = d.keys_of([line, changed], settings)
        if line != changed and not set(a) & set(b):
            missed.append(seed)
    assert missed == []


def test_short_and_strongly_edited_lines_equal_all_pairs(documents):
    settings, rows = d.Settings(), []
    for i, words in enumerate([6, 7, 8, 9, 10, 12, 13, 14, 15, 19, 20, 26, 27, 40, 60, 90] * 2):
        line = d.normalise(" ".join(prose(i, words).split()))
        for k in range(4):
            rows.append((10 * i + k, edited(line, int(words * (1 - settings.similarity) + 1e-9) if k else 0, 100 * i + k)))
    gone = brute(rows, settings)
    expected = sorted((i, [n for j, x, n in gone if (j, x) == (i, t)]) for i, t in rows)
    assert sorted((r["doc_id"], r["removed"]) for r in d.report(documents(rows)).collect()) == expected
    assert len(gone) > 80


def test_equal_short_lines_and_scripts_without_spaces(documents):
    own = [" ".join(prose(3000 + i, 30).split()) for i in range(4)]
    rows = [(i, f"{own[i]}\nRead more\n保留所有权利。\n\nAll rights reserved.{'!' * i}\nOnly {'abcd'[i]}") for i in range(4)]
    found = {r["doc_id"]: r["removed"] for r in d.report(documents(rows)).collect()}
    assert found == {0: [], 1: [1, 2, 4], 2: [1, 2, 4], 3: [1, 2, 4]}


def test_no_lines_at_all(documents):
    assert d.word_bits([]).shape == (0, 1 + d.BITS // 64) and d.keys_of([], d.Settings()) == []
    assert [r["n_removed"] for r in d.report(documents([(1, None), (2, "\n")])).collect()] == [0, 0]


def test_steps_leave_nothing_but_what_the_result_reads(spark, documents, monkeypatch):
    freed, free = [], d.free_shuffles
    monkeypatch.setattr(d, "free_shuffles", lambda session: (freed.append(1), free(session)))
    folder = Path(shared_folder(spark), "vaultwright")
    before = set(folder.glob("*"))
    found = d.repeated_lines(documents(corpus()))
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before) == ["line-groups", "lines"]
    assert found.count() > 0 and len(freed) >= 3


def test_pairs_across_classes_use_one_exchange(spark):
    rows = spark.createDataFrame([(k % 40, f"n{k:03}", f"r{k % 3}", 10) for k in range(400)], "key long, node string, root string, n long")
    facts = rows.select("node", F.array(F.col("key")).alias("fact"))
    tested = spark.createDataFrame([("n000", "n040")], "a string, b string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = linking.across(rows, tested, facts, lambda a, b: a[0] == b[0])
        own = [(r["key"], r["node"], r["root"]) for r in rows.collect()]
        brute = {(a, b) for k, a, x in own for j, b, y in own if k == j and a < b and x != y} - {("n000", "n040")}
        assert {tuple(r) for r in pairs.collect()} == brute
        assert "ReusedExchange" in pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_lines_are_hashed_in_parts():
    settings = d.Settings()
    rng = np.random.default_rng(5)
    lines = [" ".join(f"w{n}" for n in rng.integers(0, 9999, 40)) for _ in range(20_000)]
    parts = list(d._parts(lines))
    assert [x for part in parts for x in part] == lines and len(parts) > 4
    assert list(d._parts([])) == [[]]
    d.minimizers(lines[:10], settings.similarity)
    tracemalloc.start()
    found = [d.minimizers(part, settings.similarity) for part in parts]
    facts = [d.word_bits(part) for part in parts]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    assert np.concatenate([k for _, k in found]).tolist() == d.minimizers(lines, settings.similarity)[1].tolist()
    assert (np.concatenate(facts) == d.word_bits(lines)).all()


def alike(n, words, changes):
    """Lines around one passage: some within the threshold, some only nearly."""
    passage = d.normalise(" ".join(prose(77, words).split()))
    return [replaced(passage, changes + k % 3, k) + " " + " ".join(f"own{k % 9}" for _ in range(k % 4)) for k in range(n)]


def test_large_keys_meet_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(linking, "SMALL_KEY", 8)
    monkeypatch.setattr(d, "LINES", 16)
    seen, across = [], linking.across

    def watched(rows, *rest):
        seen.append(rows.agg(F.max("n")).first()[0])
        return across(rows, *rest)

    monkeypatch.setattr(linking, "across", watched)
    rows = [(k, line) for k, line in enumerate(alike(90, 40, 3) + alike(20, 9, 1))]
    gone = brute(rows, d.Settings())
    found = {(r["doc_id"], r["n_removed"]) for r in d.report(documents(rows)).collect()}
    assert found == {(k, int(any(k == i for i, _, _ in gone))) for k, _ in rows} and 10 < len(gone) < 109
    assert seen and max(n or 0 for n in seen) <= 8


def test_close_lines_finds_what_links_classes():
    lines = [line.split() for line in alike(60, 30, 2)]
    codes = [np.frombuffer(d._codes(" ".join(line)).encode("utf-16-le"), np.uint16) for line in lines]
    near = {(i, j) for i, j in itertools.combinations(range(60), 2) if distance(lines[i], lines[j]) <= d.allowed_edits(max(len(lines[i]), len(lines[j])), 0.85)}
    pairs = list(itertools.combinations(range(60), 2))
    assert d._distances([codes[i] for i, _ in pairs], [codes[j] for _, j in pairs]).tolist() == [distance(lines[i], lines[j]) for i, j in pairs]
    packed, roots = [(c.tobytes(), b"") for c in codes], np.arange(60)
    found = set(d.close_lines(0.85)(packed, packed, (roots, roots), True))

    def parts(links):
        root = list(range(60))
        for i, j in links:
            root = [root[i] if r == root[j] else r for r in root]
        return {frozenset(k for k in range(60) if root[k] == r) for r in root}

    assert found <= near and parts(found) == parts(near) and len(found) < len(near)


def test_lines_of_one_node_get_another_salt(documents, monkeypatch):
    digests, rows = d._digests, corpus()[:20]
    expected = collected(d.report(documents(rows)))

    def clashing(lines, salt):
        out = digests(lines, salt).copy()
        if salt == 0:
            out[:, 0] %= 3
        return out

    monkeypatch.setattr(d, "_digests", clashing)
    assert collected(d.report(documents(rows))) == expected and any(n for _, _, n, _ in expected)


def test_briefs_rule_out_only_what_bitmaps_do(spark):
    lines = alike(40, 40, 2) + [d.normalise(" ".join(prose(i, 20 + i).split())) for i in range(20)]
    rows = spark.createDataFrame([(k, f) for k, f in enumerate(d.word_bits(lines).tolist())], "k int, fact array<long>")
    one, two = (rows.select(F.col("k").alias(n), F.col("fact").alias(f"fact_{n}")) for n in "ab")
    pairs = one.join(two, F.col("a") < F.col("b")).withColumn("likely", d.likely(0.85)(d.brief(F.col("fact_a")), d.brief(F.col("fact_b"))))
    likely = {(r["a"], r["b"]): r["likely"] for r in pairs.collect()}
    words = [line.split() for line in lines]
    close = [(i, j) for i, j in likely if distance(words[i], words[j]) <= d.allowed_edits(max(len(words[i]), len(words[j])), 0.85)]
    assert close and all(likely[p] for p in close) and not all(likely.values())


def test_keys_of_the_same_lines_count_once(documents):
    docs = documents([(i, line) for i, line in enumerate(alike(30, 40, 0))])
    distinct = d.line_kinds(d.lines(docs, d.Settings()))
    members = [tuple(r) for r in d.line_members(docs, distinct, d.Settings()).select("key", "node").collect()]
    of = {}
    for key, node in members:
        of.setdefault(key, set()).add(node)
    assert len(members) == len(set(members)) and len({frozenset(s) for s in of.values()}) == len(of)
    keys = {}
    for key, node in {tuple(r) for r in d.line_keys(docs, d.Settings()).select("key", "node").collect()}:
        keys.setdefault(key, set()).add(node)
    assert {frozenset(s) for s in of.values()} == {frozenset(s) for s in keys.values() if len(s) > 1}


@pytest.mark.parametrize("packed", [False, True])
def test_texts_of_many_lines_are_not_shuffled(documents, monkeypatch, packed):
    docs = documents(corpus())
    distinct = d.line_kinds(d.lines(docs, d.Settings())).select("node", "first.doc_id", "first.doc")
    wanted = distinct.filter("node % 3 = 0")
    few = collected(d.line_texts(docs, wanted, d.Settings(), packed=packed))
    monkeypatch.setattr(d, "BROADCAST_KEYS", 0)
    many = d.line_texts(docs, wanted, d.Settings(), packed=packed)
    assert collected(many) == few and 0 < len(few) < distinct.count()
    plan = many._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "MapInArrow" in line)
    assert not any("Join" in line for line in plan[at : at + 4])


def test_near_lines_are_those_that_bitmaps_allow():
    lines = alike(60, 40, 3) + [d.normalise(" ".join(prose(i, 20 + i).split())) for i in range(60)]
    lines += [replaced(line, 1, 5) for line in lines[-30:]]
    facts, roots = d.word_bits(lines), np.arange(len(lines)) % 70
    one, two = d.near_lines(0.85)(facts[:120], facts[60:], (roots[:120], roots[60:]))
    words = [line.split() for line in lines]
    for found, own, others in ((one, range(120), range(60, 150)), (two, range(60, 150), range(120))):
        for k, i in enumerate(own):
            most = lambda j: d.allowed_edits(max(len(words[i]), len(words[j])), 0.85)  # noqa: E731, B023
            if any(roots[i] != roots[j] and distance(words[i], words[j]) <= most(j) for j in others if abs(len(words[i]) - len(words[j])) <= most(j)):
                assert found[k]
    assert 20 < one.sum() < 120 and 20 < two.sum() < 90 and (facts[:, 1:] < 0).any()


@pytest.mark.parametrize("words", [7, 8, 9, 12, 14, 19, 27, 40, 60, 150, 300])
def test_lines_of_a_large_key_share_a_run_around_it(words):
    settings, shared = d.Settings(), 0
    for seed in range(40):
        line = d.normalise(" ".join(prose(seed, words).split()))
        changed = edited(line, int(words * (1 - settings.similarity) + 1e-9), seed)
        if line == changed:
            continue
        of = [d.minimizers([x], settings.similarity)[1].view(np.uint64).tolist() for x in (line, changed)]
        every = d.long_runs([line, changed], settings.similarity, np.full(1 << 12, 255, np.uint8))
        assert set(every[1][every[0] == 0]) & set(every[1][every[0] == 1])
        # Some common key has a run of its own, so it is enough to refine the large ones among them.
        found = 0
        for key in set(of[0]) & set(of[1]):
            marked = np.zeros(1 << 12, np.uint8)
            marked[key % (1 << 15) >> 3] = 1 << (key & 7)
            owner, runs = d.long_runs([line, changed], settings.similarity, marked)
            found += bool(set(runs[owner == 0]) & set(runs[owner == 1]))
        assert found
        shared += 1
    assert shared > 20


def test_phrases_of_many_lines_do_not_meet_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(linking, "SMALL_KEY", 8)
    blocks, near, across = [], [], linking.near_members
    monkeypatch.setattr(linking, "near_members", lambda rows, *rest: (near.append(rows.count()), across(rows, *rest))[1])
    met = linking.across_blocks
    monkeypatch.setattr(linking, "across_blocks", lambda rows, *rest: (blocks.append(rows.count()), met(rows, *rest))[1])
    # Windows of three words that all lines have, in lines that are otherwise unlike each other.
    rows = [(i, " ".join([*prose(i, 12).split(), "one", "of", "the", *prose(500 + i, 12).split()])) for i in range(60)]
    rows += [(100 + i, replaced(rows[i][1], 2, i)) for i in range(20)]
    gone = brute(rows, d.Settings())
    found = {(r["doc_id"], r["n_removed"]) for r in d.report(documents(rows)).collect()}
    assert found == {(k, int(any(k == i for i, _, _ in gone))) for k, _ in rows} and len(gone) == 20
    assert near == [0] and blocks == []


def test_bitmap_of_keys(spark):
    keys = [5, -1, 1 << 62, (1 << 15) + 5, -(1 << 63) + 77]
    whole = np.frombuffer(d.key_bitmap(spark.createDataFrame([(k,) for k in keys], "key long")), np.uint8)
    assert len(whole) == 1 << 12 and sorted(np.flatnonzero(np.unpackbits(whole, bitorder="little"))) == sorted({k % (1 << 15) for k in keys})
