"""Templates: re-parameterised items are caught, look-alikes and inconsistent slots are not."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import collected, prose
from vaultwright.llm import template_decontamination as t
from vaultwright.llm.queries import TEXT_QUERIES

QUESTION = (
    "If Anna buys 12 apples for 3 dollars each and Bob sells 12 pears after 5km of walking, how many dollars does Anna "
    "have left when she pays 12 percent of the price to Bob at the end of the day"
)


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id long, text string, pos int, doc string")


def found(spark, documents, rows, items, **settings):
    docs = documents(rows, extra=["doc", "item_id", "window", "tokens"])
    return collected(t.contaminated(docs, benchmark(spark, items), t.Settings(**settings)), "doc_id", "item_id")


def test_marks(spark):
    df = spark.createDataFrame([("In 1999 old John Smith paid $3,500.25 for 5km, (see Anna's 7%). He said \"Bob\" ran 20 Miles",)], "text string")
    marked = df.select(t.marked(F.col("text"))).first()[0]
    shown = marked.replace("\x01", "N:").replace("\x02", "#:").replace("\x03", "U:")
    assert shown == "in #:1999 old N:john N:smith paid #:$3,500.25 for #:5 U:km see N:anna's #:7 U:% he said N:bob ran #:20 U:miles"
    tokens = df.select(t.templates(t.marked(F.col("text")))).first()[0]
    assert [x for x in tokens if x < "\x04"] == ["\x02", "\x01", "\x01", "\x02", "\x02", "\x03", "\x01", "\x02", "\x03", "\x01", "\x02", "\x03"]


def test_parameters_changed(spark, documents):
    moved = QUESTION.replace("12", "47").replace("Anna", "Maria").replace("Bob", "Otto").replace("5km", "9 miles").replace("3", "8")
    mixed = QUESTION.replace("12 apples", "47 apples").replace("12 pears", "48 pears").replace("12 percent", "49 percent")
    mixed = mixed.replace("Anna buys", "Maria buys").replace("does Anna", "does Carla").replace("Bob at", "Emil at")
    swapped = " ".join(prose(5, 60).split())
    rows = [
        (1, f"{swapped}\n{QUESTION}\n{swapped}"), (2, f"{swapped} {moved}"), (3, f"{swapped}\n{mixed}"), (4, swapped),
        (5, QUESTION.upper()[:60]), (6, None), (7, ""), (None, f"x\n{QUESTION}"), (8, QUESTION), (8, QUESTION),
    ]
    pairs = found(spark, documents, rows, [(7, QUESTION), (8, None), (9, ""), (None, QUESTION), (10, "12 13 14 15 16 17 18 19 20")])
    assert pairs == sorted([(1, 7), (2, 7), (8, 7), (None, 7)], key=repr)


def test_numbers_alone_are_no_evidence(spark, documents):
    rows = [(1, "4 5 6 7 8 9 10 11 12 13 14 15")]
    assert found(spark, documents, rows, [(1, "1 2 3 4 5 6 7 8 9 10")]) == []


def test_short_items_and_edges(spark, documents):
    rows = [(1, "ra be se na du"), (2, "one ra be se na du two"), (3, "ra be se na"), (4, "x " * 50_000 + "ra be se na du")]
    assert found(spark, documents, rows, [(1, "ra be se na du"), (2, "ra be")]) == [(1, 1), (2, 1), (4, 1)]


def test_empty_tables(spark, documents):
    assert found(spark, documents, [], [(1, QUESTION)]) == []
    assert found(spark, documents, [(1, QUESTION)], []) == []
    assert t.decontaminate(documents([]), benchmark(spark, [])).count() == 0


def test_decontaminate_keeps_the_rest(spark, documents):
    docs = documents([(1, QUESTION), (2, prose(1, 50)), (3, None), (3, None), (4, "")], extra=["_key", "_doc"])
    kept = t.decontaminate(docs, benchmark(spark, [(1, QUESTION)]))
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id") == [(2,), (3,), (3,), (4,)]


def test_no_python_in_the_plan(spark, documents):
    plan = t.contaminated(documents([(1, QUESTION)]), benchmark(spark, [(1, QUESTION)]))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_query_equals_word_windows(spark):
    """The items of the test tables have no slots: windows of eight words, plainly compared, find the same."""
    sf_dir, pairs = "/root/testdata/sf0.01", set()
    index, total = defaultdict(set), {}
    words = lambda text: [w for x in text.lower().split() if (w := x.strip(".,!?#*$%&|"))]
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        own = words(r["text"])
        total[r["item_id"]] = len(own) - 7
        for i in range(len(own) - 7):
            index[tuple(own[i : i + 8])].add((r["item_id"], i))
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        own, hits = words(r["text"]), defaultdict(set)
        for i in range(len(own) - 7):
            for item, k in index.get(tuple(own[i : i + 8]), ()):
                hits[item].add(k)
        pairs |= {(r["doc_id"], item) for item, ks in hits.items() if len(ks) >= 0.3 * total[item]}
    assert pairs and set(collected(TEXT_QUERIES["op7_benchmark_decontamination"](spark, sf_dir), "doc_id", "item_id")) == pairs


def test_verbatim_copies_are_found(spark, documents):
    sums = "12 plus 7 is 19 and 19 minus 4 is 15 then 15 times 3 is 45"
    places = "Paris, Rome, Berlin, Madrid, Oslo, Wien, Bern, Prag, Kiev, Riga"
    short = "What is the capital of France?"
    numbers = "1 2 3 4 5 6 7 8 9 10 11 12"
    filler = " ".join(prose(5, 40).split())
    copies = [sums, places, short, numbers, QUESTION]
    rows = [(i, f"{filler}\n{c}\n{filler}") for i, c in enumerate(copies)]
    rows += [(10 + i, f"{filler}. {c.upper()} {filler}") for i, c in enumerate(copies)]
    rows += [(20 + i, f"{filler} ({c.lower()}) {filler}") for i, c in enumerate(copies)] + [(30, filler)]
    pairs = found(spark, documents, rows, list(enumerate(copies)))
    assert pairs == sorted(((base + i, i) for base in (0, 10, 20) for i in range(5)), key=repr)


def test_short_items_are_whole_lines(spark, documents):
    """Items below four words are found as a line of their own, not inside a sentence."""
    items = [(1, "Where is Oslo?"), (2, "two plus two"), (3, "Yes!"), (4, "..."), (5, None), (6, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "An intro\n  where IS oslo \nand more"), (2, "He asked where is Oslo, twice.\nyes and no"), (3, "Two plus two."),
        (4, "yes"), (5, "...\n\n"), (6, None), (7, ""), (8, "Q: two plus two\nYes"), (4, "yes"),
    ]
    found = t.contaminated(documents(rows), benchmark)
    assert sorted((r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in found.collect()) == [
        (1, 1, 1, 1), (3, 2, 1, 1), (4, 3, 1, 1), (8, 3, 1, 1),
    ]
    assert sorted(r.doc_id for r in t.decontaminate(documents(rows), benchmark).collect()) == [2, 5, 6, 7]
