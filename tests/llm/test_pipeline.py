"""The pipeline against brute force, stage by stage, on a small corpus."""

import corpus_pipeline as cp
from tests.llm import test_line_dedup, test_prob_minhash, test_quality_rules
from tests.llm.conftest import prose
from vaultwright.llm import line_dedup, piece_sampling
from vaultwright.llm.queries import TEXT_ORACLES, TEXT_QUERIES

NAMES = ["quality", "lines", "near_duplicates", "decontamination", "pieces"]


def corpus():
    rows = [(i, prose(i, 70 + i), "en", f"s{i % 2}", 1) for i in range(40)]
    rows += [(100 + i, prose(i, 70 + i), "en", "s0", 1) for i in range(5)]  # exact copies
    rows += [(120 + i, test_prob_minhash.edited(prose(i, 70 + i), 2, i), "en", "s0", 1) for i in range(5, 9)]
    rows += [(140 + i, prose(200 + i, 80).upper().replace(" ", "!! "), "en", "s0", 1) for i in range(4)]  # shouted
    notice = " ".join(prose(777, 15).split())
    rows += [(150 + i, f"{prose(300 + i, 90)}\n{notice}", None, None, 1) for i in range(4)]
    rows += [(160, f"{prose(400, 60)}\n{ITEM}\n{prose(401, 60)}", "de", "s1", 1), (161, "short text", "en", "s0", 1)]
    return rows + [(162, None, "en", "s0", 0), (163, "", "en", "s0", 0)]


ITEM = " ".join(prose(9999, 25).split())


def bucket(v):
    shift = max(0, v.bit_length() - 6)
    return v >> shift << shift


def measures(text):
    n, chars, symbols, dup, repeated = test_quality_rules.base(text)
    lines = sum(bool(test_quality_rules.WORD.search(x)) for x in text.split("\n"))
    capitals, small = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    return [
        1000 * symbols // n, 1000 * dup // lines, 1000 * repeated // n,
        1000 * capitals // max(1, capitals + small), 1000 * text.count("!") // n, 1000 * chars // n,
    ]


SPREADS = [(30, False), (120, False), (100, False), (60, False), (20, False), (500, True)]


def brute_quality(rows):
    def limits(texts):
        out = []
        for k, (least, low_too) in enumerate(SPREADS):
            values = sorted(bucket(measures(t)[k]) for t in texts)
            at = lambda percent: next(v for i, v in enumerate(values, 1) if 100 * i >= percent * len(values))  # noqa: E731, B023
            reach = 4 * max(at(50) - at(5), least)
            out.append((at(50) - reach if low_too else -1, at(50) + reach))
        return out

    texts = [r for r in rows if r[1] and r[1].split()]
    kept = []
    for r in texts:
        n, _, _, _, repeated = test_quality_rules.base(r[1])
        same = [x[1] for x in texts if x[2:4] == r[2:4]]
        if len(same) < 100:
            same = [x[1] for x in texts if x[2] == r[2]]
        within = all(lo <= v <= hi for v, (lo, hi) in zip(measures(r[1]), limits(same)))
        if n >= 50 and 100 * repeated <= 50 * n and within:
            kept.append(r)
    return kept


def brute_lines(rows):
    gone = test_line_dedup.brute([(r[0], r[1]) for r in rows], line_dedup.Settings())
    out = []
    for i, text, lang, source, n in rows:
        own = {k for j, t, k in gone if (j, t) == (i, text)}
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in own)
        if left.strip() or not own:
            out.append((i, left, lang, source, len(left) if own else n))
    return out


def brute_near(rows):
    classes = test_prob_minhash.brute_classes([(r[0], r[1]) for r in rows])
    keep = {c for _, c in classes}
    return [r for r in rows if r[0] in keep]


def brute_decontamination(rows):
    plain = lambda text: " ".join(w.strip(".") for w in text.lower().split())
    return [r for r in rows if plain(ITEM) not in plain(r[1])]


def brute_pieces(spark, rows):
    keys = {r["i"]: r["k"] for r in spark.sql(f"SELECT i, xxhash64(CAST(i AS string)) AS k FROM VALUES {', '.join(f'({r[0]}L)' for r in rows)} AS t(i)").collect()}
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.default_model())
    out = []
    for i, text, *_ in rows:
        (samples,) = piece_sampling.sample_texts([text], [keys[i]], vocabulary, cp.SAMPLES)
        out += [(i, s["rank"], s["ids"].tolist()) for s in samples]
    return out


def test_stages(spark, documents, tmp_path):
    sf_dir, rows = str(tmp_path), corpus()
    docs = documents(rows, extra=["node", "kept"])
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    assert [n for n, _ in cp.STAGES] == NAMES
    brute = [brute_quality, brute_lines, brute_near, brute_decontamination]
    sizes = [len(rows)]
    for (name, function), expected in zip(cp.STAGES, brute):
        rows = expected(rows)
        out = function(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        found = sorted((tuple(r)[:5] for r in docs.collect()), key=repr)
        assert found == sorted(rows, key=repr), name
        sizes.append(len(rows))
    assert all(a > b for a, b in zip(sizes, sizes[1:])) or sizes[2] == sizes[3]
    last = sorted((r["doc_id"], r["rank"], r["ids"]) for r in cp.STAGES[-1][1](spark, docs, sf_dir).collect())
    assert last == sorted(brute_pieces(spark, rows))
    whole = sorted((r["doc_id"], r["rank"], r["ids"]) for r in cp.run(spark, sf_dir).collect())
    assert whole == last


def test_empty_documents(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert "pipeline" in TEXT_QUERIES and "pipeline" not in TEXT_ORACLES
    assert {n.split("_")[0] for n in TEXT_QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 11))}
