"""Conversations without quotes, in reply order; DataFrame functions only.

A line's quote level is the number of ``>`` in front of it; neighbouring lines of a level are a
passage.  Quoted passages, their lines and their sentences, however short, are normalised, hashed and
joined with the unquoted passages, lines and sentences of earlier messages of the conversation; the latest earlier
message that has it is the origin.  A message replies to the origin of most of its level-one
quotes (by characters; then the later one), else to the message before it.  Messages come
out without quoted lines and the attribution lines before them, with their position in a
walk through the replies: every message, then the replies to it in order of turn.

Nothing collects a conversation: "latest earlier" and ranks are taken within and then
across stretches of ``STRETCH`` turns, and the walk is ranked by doubling pointers along
it, for the conversations in which some reply goes further back than one message.

Defined cases: null and empty texts quote nothing and can't be quoted; a row without
conv_id or turn is a conversation of its own, at position 1; several messages of one turn are
ordered by a digest of their content; repeated rows (all four columns equal) are one
message that comes out as often as it went in; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import stage

STRETCH = 1024
MAX_ROUNDS = 64  # doublings: conversations of up to 2 ** 64 messages
QUOTE = r"^((?:[ \t]*>)+)"
ATTRIBUTION = r"(?:wrote|writes|schrieb|a écrit|escribió)[^\n]{0,80}:[ \t]*$"


# A sentence ends with its marks.
SENTENCE = r"[^.!?]+[.!?]*"


@dataclass(frozen=True)
class Settings:
    least_chars: int = 1


def _messages(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    content = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    return rows.withColumn("mid", F.unhex(F.md5(content.cast("binary"))))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x00-\x20]+", " "))


def levels(messages: DataFrame) -> DataFrame:
    """One row per line: conv_id, turn, mid, at, level, body."""
    lines = messages.select("conv_id", "turn", "mid", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    prefix = F.regexp_extract("line", QUOTE, 1)
    return lines.select(
        "conv_id",
        "turn",
        "mid",
        "at",
        (F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))).alias("level"),
        F.regexp_replace("line", QUOTE, "").alias("body"),
    )


def units(messages: DataFrame, settings: Settings) -> DataFrame:
    """Distinct (conv_id, turn, mid, level, unit, chars): passages, lines and sentences, normalised and hashed."""
    lines = levels(messages)
    own = Window.partitionBy("mid").orderBy("at")  # within one message
    run = F.sum(F.when(F.col("level") != F.col("last"), 1).otherwise(0)).over(own)
    passages = (
        lines.withColumn("last", F.coalesce(F.lag("level").over(own), F.col("level")))
        .withColumn("run", run)
        .groupBy("conv_id", "turn", "mid", "run", "level")
        .agg(F.sort_array(F.collect_list(F.struct("at", "body"))).alias("lines"))
        .select("conv_id", "turn", "mid", "level", F.array_join(F.col("lines.body"), " ").alias("body"))
    )
    sentences = passages.withColumn("body", F.explode(F.regexp_extract_all("body", F.lit(SENTENCE), F.lit(0))))
    every = lines.select("conv_id", "turn", "mid", "level", "body").union(passages).union(sentences)
    clean = every.withColumn("body", normalised(F.col("body"))).filter(F.length("body") >= settings.least_chars)
    return clean.select(
        "conv_id", "turn", "mid", "level", F.unhex(F.md5(F.col("body").cast("binary"))).alias("unit"),
        F.length("body").alias("chars"),
    ).distinct()


def latest_before(rows: DataFrame, keys: list[str], own: Column) -> DataFrame:
    """``rows`` with ``before``: the largest (turn, mid) of rows for which ``own`` holds, of the same keys and an earlier turn."""
    cut = rows.withColumn("_stretch", F.floor(F.col("turn") / STRETCH)).withColumn(
        "_own", F.when(own, F.struct("turn", "mid"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = cut.groupBy(*keys, "_stretch").agg(F.max("_own").alias("_top"))
    carried = stretches.select(*keys, "_stretch", F.max("_top").over(earlier).alias("_carried"))
    here = Window.partitionBy(*keys, "_stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_here", F.max("_own").over(here))
        .join(carried, [*keys, "_stretch"])
        .withColumn("before", F.coalesce("_here", "_carried"))
        .drop("_stretch", "_own", "_here", "_carried")
    )


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, mid, ...) with ``rank``, from 1, by turn and digest."""
    cut = rows.withColumn("_stretch", F.floor(F.col("turn") / STRETCH))
    earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("conv_id", "_stretch").agg(F.count("*").alias("_n"))
    offsets = counts.select("conv_id", "_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    here = Window.partitionBy("conv_id", "_stretch").orderBy("turn", "mid")
    return (
        cut.withColumn("_row", F.row_number().over(here))
        .join(offsets, ["conv_id", "_stretch"])
        .withColumn("rank", F.col("_row") + F.col("_offset"))
        .drop("_stretch", "_row", "_offset")
    )


def origins(messages: DataFrame, settings: Settings) -> DataFrame:
    """(mid, level, unit, chars, before): each quoted unit with its origin, null if there is none."""
    found = units(messages, settings)
    placed = latest_before(found, ["conv_id", "unit"], F.col("level") == 0)
    return placed.filter("level > 0").select("mid", "level", "unit", "chars", "before")


def replies(structure: DataFrame, quoted: DataFrame) -> DataFrame:
    """``structure`` (conv_id, turn, mid) with previous, parent (structs of turn, mid) and linked."""
    by_origin = (
        quoted.filter("level = 1 AND before IS NOT NULL").groupBy("mid", "before").agg(F.sum("chars").alias("chars"))
    )
    linked = by_origin.groupBy("mid").agg(F.max(F.struct("chars", "before")).alias("best"))
    linked = linked.select("mid", F.col("best.before").alias("origin"))
    previous = latest_before(structure, ["conv_id"], F.lit(True)).withColumnRenamed("before", "previous")
    return previous.join(linked, "mid", "left").select(
        "conv_id",
        "turn",
        "mid",
        "previous",
        F.coalesce("origin", "previous").alias("parent"),
        F.col("origin").isNotNull().alias("linked"),
    )


def walk(tree: DataFrame) -> DataFrame:
    """(mid, position) in a walk that visits every message before the replies to it, replies by turn."""
    order = F.struct("turn", "mid")
    family = tree.select("conv_id", "turn", "mid", F.col("parent.mid").alias("parent_mid"))
    # The next reply to the same message: as ``latest_before``, with turns counted downwards.
    down = family.withColumn("_stretch", F.floor(F.col("turn") / STRETCH))
    tops = down.groupBy("conv_id", "parent_mid", "_stretch").agg(F.min(order).alias("_first"))
    later = Window.partitionBy("conv_id", "parent_mid").orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(
        F.col("conv_id").alias("_c"), F.col("parent_mid").alias("_p"), F.col("_stretch").alias("_s"),
        F.min("_first").over(later).alias("_later"),
    )
    here = Window.partitionBy("conv_id", "parent_mid", "_stretch").orderBy("turn", "mid")
    same = (F.col("conv_id") == F.col("_c")) & F.col("parent_mid").eqNullSafe(F.col("_p")) & (F.col("_stretch") == F.col("_s"))
    siblings = down.withColumn("_next", F.lead("mid").over(here)).join(carried, same)
    siblings = siblings.select("conv_id", "mid", "parent_mid", F.coalesce("_next", F.col("_later.mid")).alias("sibling"))
    first = family.groupBy(F.col("parent_mid").alias("mid")).agg(F.min(order)["mid"].alias("child")).filter("mid IS NOT NULL")
    nodes = siblings.join(first, "mid", "left")
    # Entering a message counts, leaving it does not; each step knows the next one.
    step = lambda mid, kind: F.when(mid.isNotNull(), F.concat(mid, F.lit(kind).cast("binary")))
    enter = nodes.select(
        "conv_id",
        step(F.col("mid"), "+").alias("step"),
        F.coalesce(step(F.col("child"), "+"), step(F.col("mid"), "-")).alias("next"),
        F.lit(1).cast("long").alias("left"),
    )
    leave = nodes.select(
        "conv_id",
        step(F.col("mid"), "-").alias("step"),
        F.coalesce(step(F.col("sibling"), "+"), step(F.col("parent_mid"), "-")).alias("next"),
        F.lit(0).cast("long").alias("left"),
    )
    steps = stage(enter.union(leave), "walk")
    for _ in range(MAX_ROUNDS):
        if steps.filter("next IS NOT NULL").isEmpty():
            break
        ahead = steps.select(F.col("step").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        steps = stage(
            steps.join(ahead, "next", "left").select(
                "conv_id", "step", F.col("_next").alias("next"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left")
            ),
            "walk",
        )
    total = tree.groupBy("conv_id").agg(F.count("*").alias("n"))
    entered = steps.filter(F.expr("right(hex(step), 2)") == F.lit("2B"))
    return entered.join(total, "conv_id").select(
        F.expr("substring(step, 1, length(step) - 1)").alias("mid"), (F.col("n") - F.col("left") + 1).alias("position")
    )


def without_quotes(text: Column) -> Column:
    """The unquoted lines, without attribution lines that introduce a quote, trimmed."""
    introduced = F.regexp_replace(text, rf"(?m)^[^>\n][^\n]{{0,200}}{ATTRIBUTION}\n(?=[ \t]*>)", "")
    own = F.filter(F.split(introduced, "\n"), lambda line: ~line.rlike(r"^[ \t]*>"))
    return F.regexp_replace(F.array_join(own, "\n"), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def link(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per message: conv_id, position, turn, role, reply_to (turn), linked, n_quoted (lines), n_origins, text."""
    messages = _messages(conversations)
    known = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = stage(origins(known.filter(F.col("text").isNotNull()).dropDuplicates(["mid"]), settings), "quoted")
    structure = known.select("conv_id", "turn", "mid").distinct()
    tree = stage(replies(structure, quoted), "replies")
    back = tree.filter("NOT parent <=> previous").select("conv_id").distinct()
    positions = ranked(tree.select("conv_id", "turn", "mid")).select("mid", "conv_id", F.col("rank").alias("position"))
    if not back.isEmpty():
        back = stage(back, "branched")
        walked = walk(tree.join(back, "conv_id", "left_semi"))
        positions = positions.join(back, "conv_id", "left_anti").select("mid", "position").union(walked)
    counts = quoted.groupBy("mid").agg(F.count_distinct(F.col("before.mid")).alias("n_origins"))
    placed = (
        tree.select("mid", F.col("parent.turn").alias("reply_to"), "linked")
        .join(positions.select("mid", "position"), "mid")
        .join(counts, "mid", "left")
    )
    n_quoted = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(r"^[ \t]*>")))
    return messages.join(placed, "mid", "left").select(
        "conv_id",
        F.coalesce("position", F.lit(1)).cast("long").alias("position"),
        "turn",
        "role",
        "reply_to",
        F.coalesce("linked", F.lit(False)).alias("linked"),
        n_quoted.cast("long").alias("n_quoted"),
        F.coalesce("n_origins", F.lit(0)).cast("long").alias("n_origins"),
        without_quotes(F.col("text")).alias("text"),
    )
