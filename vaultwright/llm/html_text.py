"""Main text of web pages, with a suffix array per host against repeated boilerplate.

1. Each page is cut into blocks.  Elements that never hold the article are left out:
   menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and
   comments, known by element, role or the words in class and id.  When the page has an
   ``article`` or ``main`` element, only blocks inside it stay.
2. The blocks of the pages of a host are concatenated into one stream of tokens.  Its
   suffixes are sorted to a depth of ``least_tokens``; equal neighbours are substrings that
   recur.  Tokens covered by substrings that recur on a large enough share of the host's
   different pages are boilerplate, and blocks made of nothing else are removed; unique
   runs stay.  Inside an ``article`` the share is higher, and a page that is covered for the
   most part is a copy, not boilerplate, and keeps its blocks.

Hosts with more than ``shard_bytes`` of html are cut into shards of about that size, which
changes nothing in the results: equal streams count in one shard, each shard sorts its own
suffixes and names the substrings frequent there, these are counted over all shards of the
host, and its pages are then held against the sums.

Defined cases: null or empty html gives the empty text; a null or odd URL belongs to the
empty host; repeated rows come out as often as they went in; an empty table gives an empty
result; other columns are ignored.  A cut-off page gives the text up to the cut.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import hash_words, mix, stage, word_spans

LEFT_OUT = frozenset(
    "nav footer aside form script style noscript template iframe select button textarea svg canvas object "
    "head title menu dialog option".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg".split())
CONTAINERS = LEFT_OUT | frozenset(
    "html body div section article main header ul ol dl table thead tbody tfoot tr figure blockquote center "
    "details fieldset".split()
)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption pre address hr summary hgroup legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices alert popup modal overlay newsletter subscribe signup menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget comment comments commentlist disqus replies share sharing social "
    "related recommended footer masthead copyright login search pagination pager toolbar skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?=[/a-zA-Z])[^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


# A container left out because of its class must not hold this part of the page's text.
MOST = 0.9


def _marked(tag: str, attributes: str) -> str:
    """How the attributes of an element say that it isn't main text: "hidden" or a "role" for sure, a "class" maybe."""
    if tag in ("html", "body") or not attributes or "=" not in attributes and "hidden" not in attributes:
        return ""
    found = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if name == "role" and value.lower() in ROLES:
            return "role"
        if name in ("class", "id") and any(w.lower() in MARKS for w in _WORDS.findall(value)):
            found = "class"
    return found


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """Blocks of text outside left-out elements, and whether each is inside article or main.

    A class or id is a name that anybody chose, so a container that it marks is left out only if most of the
    page's text is elsewhere.
    """
    out: list[tuple[str, bool, tuple[int, ...]]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # open containers, whether they are left out, number of their mark or 0
    marks: list[int] = []  # open containers marked by class
    left_out = inside = n_marks = 0
    skip_block = False

    def close() -> None:
        nonlocal skip_block
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, inside > 0, tuple(marks)))
            parts.clear()
        skip_block = False

    position, page = 0, page or ""
    while piece := _PIECE.match(page, position):
        position = piece.end()
        tag = piece[2]
        if tag is None:
            if not left_out and not skip_block and page[piece.start()] != "<":
                parts.append(piece[0])
            elif piece[0] == "<" and not left_out and not skip_block:
                parts.append("<")
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "br":
                parts.append(" ")
            elif not piece[1] and tag in RAW:
                position = _after(page, tag, position)
            continue
        close()
        if tag in VOID:
            continue
        if piece[1]:  # an end tag closes what was left open inside; without a start it closes nothing
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    for name, out_too, mark in stack[i:]:
                        left_out -= out_too
                        inside -= name in ("article", "main")
                        if mark:
                            marks.remove(mark)
                    del stack[i:]
                    break
            continue
        marked = _marked(tag, piece[3])
        if tag in ("article", "main"):
            if not inside and not marked:  # an article ends menus that were never closed
                stack = [(name, False, 0) for name, _, _ in stack]
                left_out = 0
                marks.clear()
            inside += 1
        elsewhere = tag in LEFT_OUT or tag == "header" and not inside or marked in ("hidden", "role")
        if tag in RAW:
            position = _after(page, tag, position)
        elif tag in CONTAINERS:
            if not piece[3].endswith("/"):
                mark = 0
                if marked == "class" and not elsewhere:
                    n_marks += 1
                    mark = n_marks
                    marks.append(mark)
                stack.append((tag, elsewhere, mark))
                left_out += elsewhere
        elif elsewhere or marked:
            skip_block = True
    close()
    if not n_marks:
        return [(text, within) for text, within, _ in out]
    held = [0] * (n_marks + 1)
    for text, _, of in out:
        for mark in of:
            held[mark] += len(text)
    most = MOST * sum(len(text) for text, _, _ in out)
    return [(text, within) for text, within, of in out if all(held[mark] >= most for mark in of)]


def _after(page: str, tag: str, position: int) -> int:
    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, position)
    return end.end() if end else len(page)


def candidates(found: list[tuple[str, bool]]) -> tuple[list[str], bool]:
    """The blocks inside article or main if there are any, else all; which of the two."""
    within = [text for text, inside in found if inside]
    return (within, True) if within else ([text for text, _ in found], False)


@dataclass(frozen=True)
class Repeats:
    least_tokens: int = 12  # at most 16
    share: float = 0.01
    share_in_article: float = 0.5
    least_pages: int = 2
    least_pages_in_article: int = 5
    shard_bytes: int = 24 << 20


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes by their first ``depth`` tokens (8 to 16), by prefix doubling."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    for step in (1, 2, 4, depth - 8):
        if step:
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = rank[step:]
            rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
    return rank


def suffix_groups(distinct: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Substrings of ``least`` tokens of different streams: the streams in a row, places, the substring at each, pages by substring."""
    lengths = np.array([len(s) for s in distinct])
    # A separator per page, different from each other and from all words, ends its suffixes.
    joined = np.concatenate([np.append(s, np.uint64(2 * i + 1)) for i, s in enumerate(distinct)])
    page = np.repeat(np.arange(len(distinct)), lengths + 1)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    rank = suffix_ranks(joined, least)
    whole = place + least <= lengths[page]  # the substring does not reach beyond its page
    rank, page, at = rank[whole], page[whole], np.flatnonzero(whole)
    suffixes = np.lexsort((page, rank))  # the suffix array, to that depth
    r, p = rank[suffixes], page[suffixes]
    new_rank = np.append(True, r[1:] != r[:-1]) if len(r) else np.zeros(0, bool)
    new_page = new_rank | np.append(True, p[1:] != p[:-1]) if len(r) else new_rank
    group = np.cumsum(new_rank) - 1
    return joined, at[suffixes], group, np.bincount(group[new_page], minlength=group[-1] + 1 if len(group) else 0)


def _reach(shared: np.ndarray, least: int) -> np.ndarray:
    """For every token the largest number of the substrings that cover it."""
    reach = shared.copy()
    for k in range(1, least):
        np.maximum(reach[k:], shared[:-k], out=reach[k:])
    return reach


def covered(streams: list[np.ndarray], least: int) -> tuple[list[np.ndarray], int]:
    """For every token the number of different streams that share a substring of ``least`` tokens over it."""
    order = {}
    for s in streams:
        order.setdefault(s.tobytes(), len(order))
    own = [order[s.tobytes()] for s in streams]
    distinct = [np.frombuffer(k, np.uint64) for k in order]
    counts = [np.zeros(len(s), np.int32) for s in distinct]
    lengths = np.array([len(s) for s in distinct])
    if lengths.sum():
        joined, at, group, pages_of = suffix_groups(distinct, least)
        shared = np.zeros(len(joined), np.int32)
        shared[at] = pages_of[group]
        shared[shared < 2] = 0
        reach = _reach(shared, least)
        starts = np.cumsum(lengths + 1) - lengths - 1
        counts = [reach[a : a + n] for a, n in zip(starts, lengths)]
    return [counts[i] for i in own], len(distinct)


def window_hashes(tokens: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the substrings of ``least`` tokens that begin there."""
    found = np.zeros(len(starts), np.uint64)
    for k in range(least):
        found = mix(found ^ tokens[starts + k])
    return found.view(np.int64)


def covered_by(streams: list[np.ndarray], windows: np.ndarray, pages_of: np.ndarray, least: int) -> list[np.ndarray]:
    """What ``covered`` counts, from the substrings that recur (hashes in order) and their numbers of streams."""
    out = []
    for s in streams:
        shared = np.zeros(len(s), np.int64)
        starts = np.arange(max(0, len(s) - least + 1))
        if len(starts) and len(windows):
            own = window_hashes(s, starts, least)
            at = np.minimum(np.searchsorted(windows, own), len(windows) - 1)
            shared[starts] = np.where(windows[at] == own, pages_of[at], 0)
        out.append(_reach(shared, least))
    return out


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of blocks, and where each block begins."""
    buffer = np.frombuffer("\n".join(texts).encode("utf-8", "replace"), np.uint8)
    starts, ends = word_spans(buffer)
    lines = np.flatnonzero(buffer == 10)
    hashes = hash_words(buffer, starts, ends) & ~np.uint64(1)  # even: separators are odd
    return hashes, np.searchsorted(starts, np.concatenate([[0], lines, [len(buffer)]]))


def without_boilerplate(
    pages: list[tuple[list[str], bool]], rules: Repeats, known: tuple[np.ndarray, np.ndarray, int] | None = None
) -> list[list[str]]:
    """The blocks of each page of one host that stay.

    ``known`` has what recurs on the whole host if these aren't all its pages: hashes, streams of each, different streams.
    """
    found = [_tokens(texts) for texts, _ in pages]
    streams, edges = [s for s, _ in found], [e for _, e in found]
    if known is None:
        counts, n_pages = covered(streams, rules.least_tokens)
    else:
        counts, n_pages = covered_by(streams, known[0], known[1], rules.least_tokens), known[2]
    out = []
    for (texts, within), count, edge in zip(pages, counts, edges):
        share, least = (
            (rules.share_in_article, rules.least_pages_in_article) if within else (rules.share, rules.least_pages)
        )
        repeated = count >= max(least, share * n_pages)
        if not repeated.any() or 2 * repeated.sum() >= len(repeated):  # a copy of other pages, or near to one
            out.append(texts)
            continue
        out.append([t for t, a, b in zip(texts, edge[:-1], edge[1:]) if not (b > a and repeated[a:b].all())])
    return out


def window_counts(distinct: list[np.ndarray], windows: np.ndarray, least: int) -> np.ndarray:
    """On how many of different streams each substring is; ``windows`` has their hashes in order."""
    lengths = np.array([len(s) for s in distinct])
    joined = np.concatenate(distinct)
    page = np.repeat(np.arange(len(distinct)), lengths)
    starts = np.flatnonzero(np.arange(len(joined)) + least <= np.cumsum(lengths)[page])
    if not len(starts) or not len(windows):
        return np.zeros(len(windows), np.int64)
    own = window_hashes(joined, starts, least)
    at = np.minimum(np.searchsorted(windows, own), len(windows) - 1)
    hit = windows[at] == own
    pairs = np.unique(at[hit] * len(distinct) + page[starts[hit]])
    return np.bincount(pairs // len(distinct), minlength=len(windows))


def _packed(texts: list[str]) -> list[pa.Array]:
    """Texts compressed, and their sizes."""
    data = [t.encode("utf-8", "replace") for t in texts]
    packed = [pa.compress(d, codec="zstd", asbytes=True) if d else b"" for d in data]
    return [pa.array(packed, pa.binary()), pa.array([len(d) for d in data], pa.int32())]


def _unpacked(packed: list[bytes], sizes: list[int]) -> list[str]:
    return [
        pa.decompress(b, decompressed_size=n, codec="zstd", asbytes=True).decode() if n else "" for b, n in zip(packed, sizes)
    ]


def _streams(group: pa.Table, digests: list[bytes]) -> list[np.ndarray]:
    """The streams with these digests, one of each."""
    wanted, chosen = set(digests), []
    for i, digest in enumerate(group.column("digest").to_pylist()):
        if digest in wanted:
            wanted.remove(digest)
            chosen.append(i)
    rows = group.select(["packed", "size"]).take(pa.array(chosen, pa.int64()))
    return [_tokens([t])[0] for t in _unpacked(rows.column("packed").to_pylist(), rows.column("size").to_pylist())]


def host_repeats(pages: DataFrame, rules: Repeats) -> DataFrame:
    """(host, shard, window, n, n_pages) of hosts in shards: substrings on n of their different streams, for every shard.

    ``pages`` has (host, shard, shards, packed, size, digest).  Substrings too rare to be boilerplate are left out: one that is
    on n streams is on n / shards or more of those of some shard, so only such ones are counted over the whole host.
    """
    # A stream counts in one of the shards that hold it.
    own = stage(pages.groupBy("host", "digest").agg(F.min("shard").alias("shard")), "html-streams")
    share, least = min(rules.share, rules.share_in_article), min(rules.least_pages, rules.least_pages_in_article)
    hosts = own.groupBy("host").agg(F.count("*").alias("n_pages"))
    hosts = hosts.join(pages.select("host", "shards").distinct(), "host")
    hosts = hosts.withColumn("bar", F.greatest(F.lit(float(least)), F.col("n_pages") * share))
    hosts = stage(hosts, "html-bars")  # hosts above shard_bytes only
    own = own.join(F.broadcast(hosts), "host")
    dealt = pages.groupBy("host", "shard")

    def often_here(group: pa.Table, here: pa.Table) -> pa.Table:
        windows = np.zeros(0, np.int64)
        if here.num_rows:
            tokens, at, substring, n = suffix_groups(_streams(group, here.column("digest").to_pylist()), rules.least_tokens)
            first = np.unique(substring, return_index=True)[1]
            enough = n * here.column("shards")[0].as_py() >= here.column("bar")[0].as_py() * (1 - 1e-9)
            windows = window_hashes(tokens, at[first[enough]], rules.least_tokens)
        return _of_host(group, windows)

    def count(group: pa.Table, known: pa.Table) -> pa.Table:
        windows = np.unique(known.column("window").drop_null().to_numpy())
        streams = _streams(group, known.column("digest").drop_null().to_pylist()) if len(windows) else []
        n = window_counts(streams, windows, rules.least_tokens) if streams else np.zeros(len(windows), np.int64)
        return _of_host(group, windows[n > 0]).append_column("n", pa.array(n[n > 0], pa.int64()))

    def every_shard(windows: DataFrame) -> DataFrame:
        of = windows.join(F.broadcast(hosts), "host")
        return of.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    kind = "host string, shard int, digest binary, shards int, bar double"
    # Cut from the plan of ``hosts`` by names of their own, as both sides of a cogroup come from one table.
    here = own.select(*[F.col(c.split()[0]).alias(c.split()[0]) for c in kind.split(", ")])
    often = dealt.cogroup(here.groupBy("host", "shard")).applyInArrow(often_here, "host string, window long").distinct()
    known = here.select("host", "shard", "digest", F.lit(None).cast("long").alias("window")).union(
        every_shard(often).select("host", "shard", F.lit(None).cast("binary").alias("digest"), "window")
    )
    counted = dealt.cogroup(known.groupBy("host", "shard")).applyInArrow(count, "host string, window long, n long")
    counted = every_shard(counted.groupBy("host", "window").agg(F.sum("n").alias("n")))
    return counted.filter(F.col("n") >= F.col("bar")).select("host", "shard", "window", "n", "n_pages")


def _of_host(group: pa.Table, windows: np.ndarray) -> pa.Table:
    host = group.column("host")[0].as_py() if group.num_rows else None
    return pa.table({"host": pa.array([host] * len(windows), pa.string()), "window": pa.array(windows, pa.int64())})


def extract(pages: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """page_id, url, host, text, n_chars and the blocks found and removed, one row per page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    rows = rows.withColumn("host", host)
    size = F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long"))
    large = stage(
        rows.groupBy("host")
        .agg(F.ceil(size / rules.shard_bytes).cast("int").alias("shards"))
        .filter("shards > 1")
        .withColumnRenamed("host", "large_host"),
        "html-hosts",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [candidates(blocks(h)) for h in batch.column("html").to_pylist()]
            texts = ["\n".join(t) for t, _ in found]
            digests = [hashlib.md5(t.replace("\n", " ").encode("utf-8", "replace")).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), *_packed(texts)]
                + [pa.array([w for _, w in found], pa.bool_()), pa.array(digests, pa.binary())],
                names=["page_id", "url", "host", "packed", "size", "within", "digest"],
            )

    def cleaned(group: pa.Table, known: tuple[np.ndarray, np.ndarray, int] | None) -> pa.Table:
        texts = _unpacked(group.column("packed").to_pylist(), group.column("size").to_pylist())
        found = [t.split("\n") if t else [] for t in texts]
        stay = without_boilerplate(list(zip(found, group.column("within").to_pylist())), rules, known)
        text = ["\n".join(s) for s in stay]
        return pa.table(
            {
                "page_id": group.column("page_id"),
                "url": group.column("url"),
                "text": pa.array(text, pa.string()),
                "n_chars": pa.array([len(t) for t in text], pa.int64()),
                "host": group.column("host"),
                "n_blocks": pa.array([len(f) for f in found], pa.int64()),
                "n_removed": pa.array([len(f) - len(s) for f, s in zip(found, stay)], pa.int64()),
            }
        )

    def against(group: pa.Table, repeats: pa.Table) -> pa.Table:
        windows, n = repeats.column("window").to_numpy(), repeats.column("n").to_numpy()
        order = np.argsort(windows)
        n_pages = repeats.column("n_pages")[0].as_py() if len(order) else 0
        return cleaned(group, (windows[order], n[order], n_pages))

    # Texts travel compressed; equal streams of words have equal digests.
    before = "page_id long, url string, host string, packed binary, size int, within boolean, digest binary"
    after = "page_id long, url string, text string, n_chars long, host string, n_blocks long, n_removed long"
    of_large = F.col("host") == F.col("large_host")
    whole = rows.join(large, of_large, "left_anti").mapInArrow(cut, before).drop("digest")
    out = whole.groupBy("host").applyInArrow(lambda group: cleaned(group, None), after)
    if large.isEmpty():
        return out
    parts = rows.join(large.select("large_host"), of_large, "left_semi").mapInArrow(cut, before)
    parts = parts.join(F.broadcast(large), of_large).drop("large_host")
    parts = stage(parts.withColumn("shard", F.pmod(F.xxhash64("page_id", "url"), F.col("shards")).cast("int")), "html-large")
    # One plan, so that the three passes over the shards read one exchange.
    repeats = host_repeats(parts, rules).groupBy("host", "shard")
    return out.unionByName(parts.groupBy("host", "shard").cogroup(repeats).applyInArrow(against, after))
