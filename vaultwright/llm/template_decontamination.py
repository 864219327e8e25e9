"""Benchmark decontamination by templates; DataFrame functions only.

Texts become templates: names, numbers and units turn into typed placeholders, the rest
into lower-case words without surrounding punctuation.  Windows of ``window`` template tokens
(shorter items: all of their tokens) are hashed and joined with the windows of the
documents.  Equal windows on one diagonal (document position minus item position) are one
occurrence; its slots must be consistent: a value of the item stands for one value of the
document of the same type throughout, and the other way round.  So a question with
other numbers or names is caught, a text that merely has its shape is not.  An item counts as found
in a document when its consistent windows are at least ``coverage`` of its windows.

Windows of templates need ``least_literal`` tokens that are no placeholders.  Names are capitalised
words that do not begin a sentence.  Beside them the words themselves, lower-case runs of letters
and digits, are compared in the same windows without such a minimum, so that verbatim copies are found
whatever they consist of, however they are capitalised and whatever stands before them.  An item
counts as found if either way finds it; the counts are those of the way that covers more of it (if both do
the same, of the templates).

Items of fewer than ``least_literal`` words would be found in ordinary prose; such an item counts as found where a
whole line of a document has just its words.

Defined cases: null and empty texts and items without a word match nothing;
equal windows inside an item count once per position; rows of equal doc_id and text are one
text; null item ids are no items; an empty table on either side finds nothing; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import stage

SMALL_ROWS = 500_000  # of some 40 bytes: broadcast up to this many
NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
UNITS = (
    "km|cm|mm|m|kg|mg|g|lb|lbs|oz|ml|l|s|ms|h|min|hz|khz|mhz|ghz|kb|mb|gb|tb|miles?|met(?:er|re)s?|kilomet(?:er|re)s?|"
    "feet|foot|inch(?:es)?|yards?|grams?|kilograms?|pounds?|ounces?|lit(?:er|re)s?|seconds?|minutes?|hours?|days?|weeks?|"
    "months?|years?|dollars?|euros?|cents?|percent|degrees?"
)


@dataclass(frozen=True)
class Settings:
    window: int = 8
    least_literal: int = 4
    coverage: float = 0.3
    slot_agreement: float = 0.8


def marked(text: Column) -> Column:
    """Lower-case words one space apart, with a mark before each name, number and unit.

    The patterns test a character before they look around it, and leave single spaces alone, as most
    positions of a text are neither the begin nor the end of anything.
    """
    t = F.concat(F.lit(" "), F.regexp_replace(text, r"[\x00-\x20]{2,}|[\x00-\x1F]", " "), F.lit(" "))
    t = F.regexp_replace(t, rf"(?i)([0-9])({UNITS}|%)(?=[^\p{{L}}\p{{N}}])", "$1 $2")
    t = F.regexp_replace(t, r"(?![a-zA-Z ])(?<= )([+-]?[$€£]?[0-9][0-9.,:/]*)(?=[^\p{L}\p{N}])", NUMBER + "$1")
    t = F.regexp_replace(t, rf"(?i)({NUMBER}[^ ]+ )({UNITS}|%)(?=[^\p{{L}}\p{{N}}])", "$1" + UNIT + "$2")
    t = F.regexp_replace(
        t, r"(?![a-z ])(?=\p{Lu}\p{Ll})(?<=[^.!?:; ][\"')]? [\"'(]?)(\p{Lu}\p{Ll}[\p{L}'-]*)", NAME + "$1"
    )
    # Punctuation at the edges of words, but not the per cent sign of a unit.
    t = F.regexp_replace(
        t,
        rf"(?![a-zA-Z0-9])(?:(?<= )[^\p{{L}}\p{{N}}{NAME}-{UNIT}]+|(?<!{UNIT})[^\p{{L}}\p{{N}} {NAME}-{UNIT}]+(?= ))",
        "",
    )
    return F.trim(F.regexp_replace(F.lower(t), "  +", " "))


def templates(marked_text: Column) -> Column:
    """Tokens of a marked text, placeholders without their values."""
    return F.split(F.regexp_replace(marked_text, rf"([{NAME}-{UNIT}])[^ ]+", "$1"), " ")


def plain(text: Column) -> Column:
    """The lower-case words of a text: runs of letters, marks and digits."""
    # A space between two words of ASCII letters is one already.
    between = r"(?![a-z0-9])(?! [a-z0-9])[^\p{L}\p{M}\p{N}]+"
    return F.split(F.trim(F.regexp_replace(F.lower(text), between, " ")), " ")


def _text_key() -> Column:
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, marked_tokens, tokens, words) of the items."""
    text = marked(F.col("text").cast("string"))
    return (
        benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL")
        .select("item_id", text.alias("marked"), plain(F.col("text").cast("string")).alias("words"))
        .select("item_id", F.split("marked", " ").alias("marked_tokens"), templates(F.col("marked")).alias("tokens"), "words")
    )


def item_windows(item_rows: DataFrame, settings: Settings) -> DataFrame:
    """(item_id, item_pos, window, length), one row per window with enough literal tokens."""
    length = F.least(F.size("tokens"), F.lit(settings.window))
    literal = F.size(F.filter(F.col("part"), lambda t: t >= F.lit("\u0004")))
    return (
        item_rows.filter(F.size("tokens") >= settings.least_literal)
        .withColumn("length", length)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.size("tokens") - F.col("length") + 1)))
        .withColumn("part", F.slice("tokens", F.col("at"), F.col("length")))
        .filter(literal >= settings.least_literal)
        .select("item_id", (F.col("at") - 1).alias("item_pos"), F.xxhash64("part").alias("window"), "length")
    )


def word_windows(item_rows: DataFrame, settings: Settings) -> DataFrame:
    """(item_id, item_pos, window, length), one row per window of words."""
    words = item_rows.select("item_id", F.col("words").alias("tokens"))
    return item_windows(words, settings)


def short_items(texts: DataFrame, item_rows: DataFrame, settings: Settings) -> DataFrame | None:
    """(doc, item_id) of items too short for a window whose words are a whole line; None without such items."""
    joined = F.array_join("words", " ")
    short = item_rows.filter(F.size("words") < settings.least_literal).select("item_id", joined.alias("line"))
    short = short.filter("line <> ''")
    if short.isEmpty():
        return None
    lines = texts.select(_text_key().alias("doc"), F.explode(F.split("text", "\n")).alias("line"))
    few_words = lines.filter(F.length(F.trim("line")) > 0).select("doc", plain(F.col("line")).alias("words"))
    few_words = few_words.filter(F.size("words") < settings.least_literal).select("doc", joined.alias("line"))
    wanted = F.broadcast(short) if short.count() <= SMALL_ROWS else short
    return few_words.join(wanted, "line").select("doc", "item_id").distinct()


def _hash_at(length: int):
    return lambda at: F.xxhash64(F.slice("tokens", at, F.lit(length)))


def matches(docs: DataFrame, wanted: DataFrame, lengths: list[int], tokens_of: Callable[[Column], Column]) -> DataFrame:
    """(doc, pos, item_id, item_pos, length): windows of documents that equal windows of items."""
    few = wanted.count() <= SMALL_ROWS
    wanted = F.broadcast(wanted) if few else wanted
    found = None
    for length in lengths:  # one pass per length; more than one only if items are shorter than the window
        tokens = docs.select(_text_key().alias("doc"), tokens_of(F.col("text").cast("string")).alias("tokens"))
        # A shorter text has one window, which equals none; posexplode_outer, as a filter on the
        # size of the array would have the optimiser compute all hashes twice.
        hashed = tokens.select(
            "doc",
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("tokens") - length + 1, F.lit(1))),
                _hash_at(length),
            ).alias("hashes"),
        )
        exploded = hashed.select("doc", F.posexplode_outer("hashes").alias("pos", "window"))
        part = exploded.join(wanted.filter(F.col("length") == length), "window").select(
            "doc", "pos", "item_id", "item_pos", "length"
        )
        found = part if found is None else found.union(part)
    return found


def slot_conflicts(docs: DataFrame, item_rows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, item_id, diagonal, slots, agreeing): slots on each diagonal, and how many keep to one value each way."""
    places = (
        found.select("doc", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "item_pos", "length")
        .withColumn("at", F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + F.col("length") - 1)))
        .select("doc", "item_id", "diagonal", "at")
        .distinct()
    )
    kinds = item_rows.select("item_id", F.posexplode("marked_tokens").alias("at", "item_value"))
    kinds = kinds.filter(F.col("item_value") < F.lit("\u0004"))
    slots = stage(places.join(kinds, ["item_id", "at"]), "slots")
    wanted = slots.select("doc").distinct()
    if wanted.count() <= SMALL_ROWS:
        wanted = F.broadcast(wanted)
    values = (
        docs.withColumn("doc", _text_key())
        .join(wanted, "doc", "left_semi")
        .dropDuplicates(["doc"])
        .select("doc", F.posexplode(F.split(marked(F.col("text").cast("string")), " ")).alias("place", "value"))
        .filter(F.col("value") < F.lit("\u0004"))
    )
    pairs = (
        slots.withColumn("place", F.col("at") + F.col("diagonal"))
        .join(values, ["doc", "place"])
        .groupBy("doc", "item_id", "diagonal", "item_value", "value")
        .agg(F.count("*").alias("n"))
    )
    here = ["doc", "item_id", "diagonal"]
    one_way = pairs.groupBy(*here, "item_value").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    other_way = pairs.groupBy(*here, "value").agg(F.max("n").alias("most"))
    forward = one_way.groupBy(*here).agg(F.sum("n").alias("slots"), F.sum("most").alias("forward"))
    backward = other_way.groupBy(*here).agg(F.sum("most").alias("backward"))
    return forward.join(backward, here).select(*here, "slots", F.least("forward", "backward").alias("agreeing"))


def _found(docs: DataFrame, wanted: DataFrame, settings: Settings, tokens_of: Callable[[Column], Column], name: str) -> DataFrame:
    lengths = sorted(r[0] for r in wanted.select("length").distinct().collect())  # at most ``window`` numbers
    return stage(matches(docs, wanted, lengths or [settings.window], tokens_of).distinct(), name)


def _covered(found: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(doc, item_id, n_windows, n_slots, n_agreeing, item_windows) of the items covered by ``found``."""
    total = wanted.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    per_diagonal = found.groupBy("doc", "item_id", "diagonal").agg(
        F.collect_set("item_pos").alias("covered"),
        F.coalesce(F.max("slots"), F.lit(0)).alias("slots"),
        F.coalesce(F.max("agreeing"), F.lit(0)).alias("agreeing"),
    )
    return (
        per_diagonal.groupBy("doc", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).cast("long").alias("n_windows"),
            F.sum("slots").cast("long").alias("n_slots"),
            F.sum("agreeing").cast("long").alias("n_agreeing"),
        )
        .join(total, "item_id")
        .filter(F.col("n_windows") >= F.col("item_windows") * settings.coverage)
        .select("doc", "item_id", "n_windows", "n_slots", "n_agreeing", "item_windows")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pairs of a document and an item found in it.

    doc_id, doc (digest of the text), item_id, n_windows, item_windows, n_slots, n_agreeing.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    item_rows = stage(items(benchmark), "items")
    wanted = stage(item_windows(item_rows, settings), "item-windows")
    found = _found(texts, wanted, settings, lambda text: templates(marked(text)), "item-matches")
    slots = slot_conflicts(texts, item_rows, found)
    diagonals = found.select("doc", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
    consistent = diagonals.join(slots, ["doc", "item_id", "diagonal"], "left").filter(
        F.col("slots").isNull() | (F.col("agreeing") >= F.col("slots") * settings.slot_agreement)
    )
    verbatim = stage(word_windows(item_rows, settings), "item-words")
    copies = _found(texts, verbatim, settings, plain, "item-copies").select(
        "doc", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"),
        F.lit(0).cast("long").alias("slots"), F.lit(0).cast("long").alias("agreeing"),
    )
    either = _covered(consistent, wanted, settings).withColumn("by_template", F.lit(1)).union(
        _covered(copies, verbatim, settings).withColumn("by_template", F.lit(0))
    )
    short = short_items(texts, item_rows, settings)
    if short is not None:
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        counts = [one.alias("n_windows"), none.alias("n_slots"), none.alias("n_agreeing"), one.alias("item_windows")]
        either = either.union(short.select("doc", "item_id", *counts, F.lit(0).alias("by_template")))
    better = F.struct(F.col("n_windows") / F.col("item_windows"), "by_template", "n_windows", "item_windows", "n_slots", "n_agreeing")
    texts_found = either.groupBy("doc", "item_id").agg(F.max(better).alias("best")).select("doc", "item_id", "best.*")
    ids = texts.select("doc_id", _text_key().alias("doc")).distinct()
    return ids.join(texts_found, "doc").select(
        "doc_id", "doc", "item_id", "n_windows", "item_windows", "n_slots", "n_agreeing"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents in which no item is found, unchanged."""
    found = stage(contaminated(docs, benchmark, settings).select(F.col("doc").alias("_doc")).distinct(), "contaminated")
    if found.count() <= SMALL_ROWS:
        found = F.broadcast(found)
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        F.unhex(F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"))).alias("_key"),
    )
    return whole.join(found, F.col("_key") == F.col("_doc"), "left_anti").select("_row.*")
