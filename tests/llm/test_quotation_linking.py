"""Quotes to replies, against a plain restatement, on the short and the stretched path."""

import random
import re

import pytest

from tests.llm.conftest import collected
from vaultwright.llm import quotation_linking as q
from vaultwright.llm.queries import TEXT_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, position int, mid string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)


def clean(text):
    return " ".join(re.sub(r"[\x00-\x20]+", " ", text.lower()).split(" ")).strip()


def parse(text):
    out = []
    for line in (text or "").split("\n"):
        head = re.match(r"^((?:[ \t]*>)+)", line)
        out.append(((head[1].count(">") if head else 0), line[head.end() :] if head else line))
    return out


def units(text):
    """{(level, unit)}: lines, passages and their sentences."""
    found, run = set(), []
    for level, body in [*parse(text), (None, "")]:
        if run and run[0][0] != level:
            passage = " ".join(b for _, b in run)
            found |= {(run[0][0], clean(x)) for x in [passage, *re.findall(r"[^.!?]+[.!?]*", passage)]}
            run = []
        if level is not None:
            found.add((level, clean(body)))
            run.append((level, body))
    return {(level, u) for level, u in found if u}


def brute(rows):
    """{(conv, turn): (position, reply_to, linked)}; turns must be unique."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        said, parent, linked = {}, {}, {}
        for i, (_, turn, _, text) in enumerate(own):
            votes = {}
            for level, u in units(text):
                if level == 1 and u in said:
                    votes[said[u]] = votes.get(said[u], 0) + len(u)
            best = max(votes, key=lambda t: (votes[t], t)) if votes else None
            linked[turn] = best is not None
            parent[turn] = best if best is not None else own[i - 1][1] if i else None
            for level, u in units(text):
                if level == 0:
                    said[u] = turn
        order = []

        def walk(t):
            order.append(t)
            for child in sorted(c for c, p in parent.items() if p == t):
                walk(child)

        if own:
            walk(own[0][1])
        for k, t in enumerate(order, 1):
            out[(conv, t)] = (k, parent[t], linked[t])
    return out


def thread(seed, n):
    rng = random.Random(seed)
    said, rows = [], []
    for turn in range(0, 3 * n, 3):
        lines = [f"message {turn} says word{rng.randrange(10**6)} and more", f"second line of {turn} goes here"]
        text = "\n".join(lines)
        if said and rng.random() < 0.6:
            quoted = rng.choice(said).split("\n")
            quoted = rng.sample(quoted, rng.randrange(1, len(quoted) + 1))
            nested = rng.choice(said).split("\n")[0]
            text = "\n".join([f"On Monday {turn} somebody wrote:", f">> {nested}", *[f"> {x.upper()}  " for x in quoted], *lines])
        said.append("\n".join(lines))
        rows.append((seed, turn, "user", text))
    return rows


@pytest.mark.parametrize("stretch", [1024, 8])
def test_replies_equal_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(q, "STRETCH", stretch)
    rows = [r for seed in range(5) for r in thread(seed, 25)] + [(9, t, "user", f"chain message number {t}") for t in range(30)]
    found = {(r["conv_id"], r["turn"]): (r["position"], r["reply_to"], r["linked"]) for r in q.link(table(spark, rows)).collect()}
    assert found == brute(rows)
    assert sum(v[2] for v in found.values()) > 40


def test_text_without_quotes(spark):
    rows = [
        (1, 0, "a", "the first message here\n\nwith two parts"),
        (1, 1, "b", "Some Body wrote yesterday, 3 pm:\n> The first   message here\n > > deeper\n\nI agree\n>x\nbye \n"),
        (1, 2, "c", "he wrote this:\nnot a quote\n"), (1, 3, None, None), (1, 4, "d", ""),
        (None, 1, "n", "> q"), (2, None, "n", "no turn"), (3, 5, "t", "same turn"), (3, 5, "t", "same turn"), (3, 5, "u", "other of it"),
    ]
    found = {(r["conv_id"], r["turn"], r["role"]): r for r in q.link(table(spark, rows)).collect()}
    assert q.link(table(spark, rows)).count() == len(rows)
    reply = found[(1, 1, "b")]
    assert reply["text"] == "I agree\nbye" and reply["n_quoted"] == 3 and reply["linked"] and reply["reply_to"] == 0
    assert found[(1, 2, "c")]["text"] == "he wrote this:\nnot a quote"
    assert found[(1, 3, None)]["text"] is None and found[(1, 4, "d")]["reply_to"] == 3
    assert found[(None, 1, "n")]["position"] == 1 and found[(2, None, "n")]["position"] == 1
    assert {r["position"] for r in q.link(table(spark, rows)).filter("conv_id = 3").collect()} == {1, 2}


def test_empty_table_and_no_python(spark):
    empty = q.link(table(spark, []))
    assert empty.count() == 0
    plan = q.link(table(spark, thread(1, 6)))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_query_over_the_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = brute(rows)
    found = TEXT_QUERIES["op8_quotation_linking"](spark, data)
    assert collected(found, "conv_id", "turn", "position", "reply_to", "linked") == sorted(
        ((*k, *v) for k, v in expected.items()), key=repr
    )


def test_short_quotes_and_sentences(spark):
    """A word, a short line and one sentence of a long line, quoted, lead to the message that has them."""
    rows = [
        (1, 0, "a", "Yes, why?\nIt rained all day. We stayed in and read! Then it stopped."),
        (1, 1, "b", "I agree."), (1, 2, "c", "No"), (1, 3, "d", "Nothing of that."),
        (1, 4, "e", "> We stayed in and\n> read!\nMe too"), (1, 5, "f", "> i  agree.\nGood"), (1, 6, "g", "> No\nSure?"),
        (1, 7, "h", ">> Yes, why?\n> Sure?\nYes"),
    ]
    found = {r["turn"]: (r["reply_to"], r["linked"]) for r in q.link(table(spark, rows)).collect()}
    assert {t: found[t] for t in (4, 5, 6, 7)} == {4: (0, True), 5: (1, True), 6: (2, True), 7: (6, True)}
    assert found[3] == (2, False)
    assert {(1, t): v for t, v in found.items()} == {k: v[1:] for k, v in brute(rows).items()}
