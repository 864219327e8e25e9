"""The grammar, learning from the training folds only, and held-out accuracy."""

import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vaultwright.llm import toxicity as t
from vaultwright.llm.queries import TEXT_QUERIES


def channels(text):
    return dict(zip(t.CHANNELS, t.Lexicon({"moron": 2.0, "scum*": 1.0}).channels(text)))


@pytest.mark.parametrize(
    "text, channel, weight",
    [
        ("What a moron.", "plain", 2.0),
        ("You are a moron, really", "aimed", 2.0),
        ("He is not a moron.", "negated", 2.0),
        ("She said he was a moron.", "reported", 2.0),
        ("you. Moron", "plain", 2.0),
        ("not now! moron", "plain", 2.0),
        ("Scummy SCUMBAG", "plain", 2.0),
        ("I will kill you", "plain", 1.0),
        ("oxymoron moronic", "plain", 0.0),
        ("", "plain", 0.0),
        (None, "plain", 0.0),
    ],
)
def test_channels(text, channel, weight):
    found = channels(text)
    assert found[channel] == weight
    assert sum(found.values()) == weight


def test_scopes_end():
    found = t.Lexicon({"moron": 2.0}).channels("not one two three moron")
    assert dict(zip(t.CHANNELS, found))["plain"] == 2.0


def test_product_has_all_states():
    a, b = t.Transducer.scope(t.NEGATION, 2), t.Transducer.scope(t.REPORT, 1)
    table = t.compose(a, b)
    assert len(table) == a.states * b.states
    state = table[0][t.NEGATION][0]
    assert table[state][t.OTHER][1] == 1 and table[state][t.REPORT][1] == 1


def tables(spark, documents, n=240):
    """Every third text has a made-up insult."""
    rows = [(i, prose(i, 40) + (" zorgling" if i % 3 == 0 else "")) for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0), "x") for i in range(n)], "doc_id long, quality int, toxic int, text string")
    return documents(rows, extra=["score", "toxic", "held_out"]), labels


def test_learns_from_training_folds(spark, documents):
    docs, labels = tables(spark, documents)
    for r in t.score(docs, t.learn(docs, labels)).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["doc_id"] % 3 == 0) == int(r["score"] >= 0.5)


def test_held_out_labels_are_not_used(spark, documents):
    docs, labels = tables(spark, documents)
    turned = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert t.learn(docs, labels).coefficients == t.learn(docs, turned).coefficients


def test_edge_cases(spark, documents):
    docs, labels = tables(spark, documents, 60)
    model = t.learn(docs, labels)
    odd = documents([(None, "zorgling"), (1, None), (1, ""), (2, "x" * 200_000), (3, "zorgling"), (3, "zorgling")])
    scored = t.score(odd, model).collect()
    assert len(scored) == 6 and all(0 <= r["score"] <= 1 for r in scored)
    assert scored[1]["score"] == scored[2]["score"]
    assert t.score(documents([]), model).count() == 0
    empty = labels.limit(0)
    assert max(r["score"] for r in t.score(docs, t.learn(docs, empty)).collect()) < 1e-9
    only = labels.withColumn("toxic", F.lit(1))
    assert {r["predicted"] for r in t.score(docs, t.learn(docs, only)).collect()} == {1}
    nulls = labels.withColumn("toxic", F.lit(None).cast("int")).union(labels.withColumn("doc_id", F.lit(None).cast("long")))
    assert {r["predicted"] for r in t.score(docs, t.learn(docs, nulls)).collect()} == {0}


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = TEXT_QUERIES["op9_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert scored.count() == 10_000
