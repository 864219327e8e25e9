"""Blocks of pages, and the suffix array against counting all windows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import collected, prose
from vaultwright.llm import html_text as h


def text(page):
    return [t for t, _ in h.blocks(page)]


def test_left_out_elements():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- <p>no</p> -->
    <div class="ad">Buy</div><div class='cookie-notice'>We use</div><div id="adBanner">x</div><aside>Side</aside>
    <article><header><h1>Title &amp; more</h1></header><p>One  two
    three<br>four</p><p>A &lt; B &copy; C&nbsp;D &ampx</p><div class="comments"><p>Reader</p></div><div role="note">Kept</div>
    <form><p>Mail</p><button>Go</button></form><p class="advert">Ad</p>Loose <b>text</b>.</article>
    <footer>Foot</footer></body></html>"""
    found, within = h.candidates(h.blocks(page))
    assert within
    assert found == ["Title & more", "One two three four", "A < B © C D &x", "Kept", "Loose text ."[:10] + "."]


def test_broken_pages():
    assert text(None) == [] and text("") == [] and text("   ") == []
    assert text("plain <b>text") == ["plain text"]
    assert text("<nav><ul><li>x<article><p>in") == ["in"]
    assert text("<article><p>a<p>b<br><p>c</article>rest <p") == ["a", "b", "c", "rest"]
    assert text("<p>1 < 2 and <3</p><p title='>'>x</p><p title=\">y</p>") [:2] == ["1 < 2 and <3", "x"]
    assert text("</div></article><p>x</p></section>") == ["x"]
    assert text("<script>never closed <p>x") == []
    assert text("<p>caf&eacute; &#233; &#x1F600; &nosuch;</p>") == ["café é 😀 &nosuch;"]
    assert len(text("<div>" * 5000 + "deep" + "</div>" * 5000)) == 1


def test_without_article_all_blocks_count():
    found, within = h.candidates(h.blocks("<body><nav>m</nav><div><p>a</p>b</div></body>"))
    assert (found, within) == (["a", "b"], False)


def brute(streams, least):
    pages = defaultdict(set)
    for s in streams:
        for i in range(len(s) - least + 1):
            pages[tuple(s[i : i + least])].add(tuple(s))
    out = []
    for s in streams:
        count = [0] * len(s)
        for i in range(len(s) - least + 1):
            n = len(pages[tuple(s[i : i + least])])
            for k in range(i, i + least):
                count[k] = max(count[k], n if n > 1 else 0)
        out.append(count)
    return out


def test_suffix_array_equals_counting():
    rng = random.Random(3)
    for least in (8, 12, 16):
        common = [[rng.randrange(50) for _ in range(25)] for _ in range(3)]
        streams = []
        for _ in range(12):
            s = [rng.randrange(50) for _ in range(rng.randrange(0, 40))]
            for c in rng.sample(common, rng.randrange(0, 3)):
                s[len(s) // 2 : len(s) // 2] = c[rng.randrange(0, 5) :]
            streams.append(s)
        streams += [streams[0], [], [1] * 40, [1] * 30]
        found, distinct = h.covered([np.array([2 * x for x in s], np.uint64) for s in streams], least)
        assert [f.tolist() for f in found] == brute(streams, least)
        assert distinct == len({tuple(s) for s in streams})


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, shard int, text string")


NOTICE = "please support our work with a small gift because good words are dear to all of us here today"


def test_repeated_boilerplate_goes_and_copies_stay(spark):
    body = lambda i: f"<div><p>{prose(i, 40)}</p><p>{NOTICE}</p></div>"
    rows = [(i, f"http://Host/{i}", f"<html><body>{body(i)}</body></html>") for i in range(12)]
    article = f"<article><h1>Same</h1><p>{prose(99, 60)}</p></article>"
    rows += [(100 + i, "http://copies.org/x", article + f"<footer>{i}</footer>") for i in range(8)]
    noticed = [(200 + i, "https://n.org:80/", f"<article><p>{prose(200 + i, 50)}</p><p>{NOTICE}</p></article>") for i in range(8)]
    rows += noticed + [(300, None, None), (301, "odd", ""), (300, None, None)]
    found = {r["page_id"]: r for r in h.extract(pages(spark, rows)).collect()}
    for i in range(12):
        assert found[i]["text"] == " ".join(prose(i, 40).split())
        assert found[i]["n_removed"] == 1
    assert all(found[100 + i]["text"] == "Same\n" + " ".join(prose(99, 60).split()) for i in range(8))
    assert all(found[200 + i]["text"] == " ".join(prose(200 + i, 50).split()) for i in range(8))
    assert found[300]["text"] == "" and found[301]["text"] == "" and found[301]["n_chars"] == 0
    assert h.extract(pages(spark, rows)).count() == len(rows)


def test_shards_and_empty_table(spark):
    rows = [(i, "http://one.org/", f"<div><p>{prose(i, 30)}</p><p>{NOTICE}</p></div>") for i in range(60)]
    split = h.extract(pages(spark, rows), h.Repeats(shard_bytes=3000))
    assert collected(split, "page_id", "text") == collected(h.extract(pages(spark, rows)), "page_id", "text")
    assert h.extract(pages(spark, [])).count() == 0


def test_shards_count_like_the_whole_host(spark):
    """A notice on few pages of a host, copies of one page, and articles: shards of any size give the same text."""
    own = [(i, prose(i, 40)) for i in range(60)] + [(60 + i, prose(7, 40)) for i in range(30)]
    rows = [(i, "http://one.org/", f"<div><p>{t}</p>{f'<p>{NOTICE}</p>' if i in (3, 41) else ''}</div>") for i, t in own]
    rows += [(200 + i, "http://one.org/a", f"<article><p>{prose(300 + i, 40)}</p><p>{NOTICE} Sign up now.</p></article>") for i in range(9)]
    rows += [(300 + i, "http://two.org/", f"<p>{prose(400 + i, 60)}</p><p>{NOTICE}</p>") for i in range(3)] + [(400, "http://two.org", None)]
    whole = collected(h.extract(pages(spark, rows)), "page_id", "text", "n_removed")
    assert {i for i, _, n in whole if n} == {3, 41, 300, 301, 302}
    for size in (700, 3000, 9000):
        assert collected(h.extract(pages(spark, rows), h.Repeats(shard_bytes=size)), "page_id", "text", "n_removed") == whole


@pytest.mark.parametrize(
    "page",
    [
        "<body class='home no-sidebar'>{}</body>",
        "<html class='menu-closed'><body>{}</body></html>",
        "<div class='elementor-widget-container'>{}</div>",
        "<body><div class='content login-page'>{}</div></body>",
        "<section id='related-work'>{}</section>",
    ],
)
def test_class_words_on_what_holds_the_page(page):
    """A marked container with most of the text is the text; a marked one beside or inside it still goes."""
    text = "<h1>On rivers</h1><p>" + "Water finds its way. " * 30 + "</p>"
    aside = "<div class='sidebar'><p>See also: lakes</p></div><ul class='share-menu'><li>Mail</li></ul>"
    expected = ["On rivers", ("Water finds its way. " * 30).strip()]
    assert [t for t, _ in h.blocks(page.format(text))] == expected
    assert [t for t, _ in h.blocks(page.format(text + aside))] == expected
    assert [t for t, _ in h.blocks(page.format(aside + text) + "<div class='comments'><p>Nice!</p></div>")] == expected


def test_near_copies_without_article_keep_their_text():
    shared = [f"Sentence {i} of the story says this and that about the same old thing again." for i in range(12)]
    pages = [([*shared, f"Only page {n} ends like so."], False) for n in range(2)]
    assert h.without_boilerplate(pages, h.Repeats()) == [texts for texts, _ in pages]


def test_windows_are_counted_once_per_stream():
    streams = [np.array(s, np.uint64) for s in ([2, 4, 6, 8, 2, 4, 6], [4, 6, 8], [], [2, 4], [6, 2, 4, 6])]
    own = np.unique(np.concatenate([h.window_hashes(s, np.arange(len(s) - 2), 3) for s in streams if len(s) > 2]))
    found = dict(zip(own.tolist(), h.window_counts(streams, own, 3).tolist()))
    of = lambda *w: int(h.window_hashes(np.array(w, np.uint64), np.array([0]), 3)[0])
    assert found[of(2, 4, 6)] == 2 and found[of(4, 6, 8)] == 2 and found[of(8, 2, 4)] == 1
    assert h.window_counts(streams, own[:0], 3).tolist() == []


def test_frequent_in_some_shard_only(spark):
    """Notices on many pages, on just enough and on one too few of them, in shards that hold uneven parts of each."""
    rows = []
    for i in range(100):
        notices = [f"<p>{prose(9000 + k, 16)}</p>" for k, n in enumerate((60, 20, 19)) if i < n]
        rows.append((i, "http://one.org/", f"<div><p>{prose(i, 60)}</p>{''.join(notices)}</div>"))
    rows += [(200 + i, "http://one.org/", rows[30][2]) for i in range(50)]
    rules = dict(share=0.2, share_in_article=0.5)
    whole = collected(h.extract(pages(spark, rows), h.Repeats(**rules)), "page_id", "text", "n_removed")
    assert {i: n for i, _, n in whole if n} == {**{i: 2 for i in range(20)}, **{i: 1 for i in range(20, 60)}, **{200 + i: 1 for i in range(50)}}
    for size in (9000, 30000):
        assert collected(h.extract(pages(spark, rows), h.Repeats(**rules, shard_bytes=size)), "page_id", "text", "n_removed") == whole


def test_texts_of_shards_travel_once(spark):
    rows = [(i, "http://one.org/", f"<div><p>{prose(i, 200)}</p><p>{NOTICE}</p></div>") for i in range(300)]
    found = h.extract(pages(spark, rows), h.Repeats(shard_bytes=100_000))
    assert {r["n_removed"] for r in found.collect()} == {1}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FlatMapCoGroupsInArrow") == 3 and plan.count("ReusedExchange") == 2
