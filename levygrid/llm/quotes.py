"""Quotation linking: conversations in reply order, without quoted text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import Scratch, let
from levygrid.operators.numbering import number_rows

_PREFIX = "^(?:[ \\t]*>)+"
#: A line that introduces a quote and belongs to it, if the next line is quoted.
_LEAD_IN = "(?i)^\\s*(?:on\\b.*\\bwrote|.*\\bwrote|.*\\bwrites)\\s*:\\s*$"


def normalised(text: Column) -> Column:
    """Lower-cased, white space runs as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), "\\s++", " "))


def parsed_lines(text: Column) -> Column:
    """Array of (level, body) of a text's lines; the level is the number of leading ``>``."""
    def line(l: Column) -> Column:
        prefix = F.regexp_extract(l, _PREFIX, 0)
        level = F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.regexp_replace(l, _PREFIX + " ?", "").alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), line)


def runs(lines: Column) -> Column:
    """Array of (level, text, lines) of neighbouring lines of one level, blank ones left out."""
    solid = F.filter(lines, lambda l: F.length(normalised(l["body"])) > 0)

    def split(rows: Column) -> Column:
        starts = F.filter(
            F.transform(rows, lambda r, i: F.when((i == 0) | (F.get(rows, i - 1)["level"] != r["level"]), i)),
            lambda i: i.isNotNull(),
        )
        return let(starts, lambda s: F.transform(s, lambda at, k: F.slice(
            rows, at + 1, F.coalesce(F.get(s, k + 1), F.size(rows)) - at
        )))

    def run(part: Column) -> Column:
        bodies = F.transform(part, lambda l: normalised(l["body"]))
        return F.struct(
            part[0]["level"].alias("level"), F.array_join(bodies, " ").alias("text"), bodies.alias("lines")
        )

    return F.transform(let(solid, split), run)


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that introduce them, trimmed."""
    def own(lines: Column) -> Column:
        return F.array_join(F.transform(F.filter(lines, lambda l, i: (l["level"] == 0) & ~(
            l["body"].rlike(_LEAD_IN) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
        )), lambda l: l["body"]), "\n")

    kept = F.trim(F.regexp_replace(let(parsed_lines(text), own), "^\\s++|\\s++$", ""))
    return F.when(text.isNotNull(), kept)


def _hashes(parts: Column) -> Column:
    """Distinct hashes of a passage and of its lines, ``whole`` telling which."""
    both = F.concat(
        F.transform(parts, lambda p: F.struct(p["level"].alias("level"), F.xxhash64(p["text"]).alias("hash"), F.length(p["text"]).alias("size"))),
        F.flatten(F.transform(parts, lambda p: F.transform(p["lines"], lambda l: F.struct(
            p["level"].alias("level"), F.xxhash64(l).alias("hash"), F.length(l).alias("size"))))),
    )
    return F.array_distinct(both)


def linked(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Messages with their place and the place each answers.

    Returns (messages, places): ``messages`` has the columns of ``df`` and ``__row``;
    ``places`` has __row, key (of the conversation), n (place in the conversation, from 1), parent (the place answered,
    null for the first), quotes and matched (numbers of quoted passages and lines).

    A quoted passage and each of its lines are hashed; so are the unquoted passages and lines of
    every message. Of each conversation and hash only the first message is kept before
    the join, so a passage that a third of all messages share meets one row. A message answers the
    latest message before it that its shallowest matched quote comes from; without a match,
    the message before it.
    """
    scratch = Scratch(df.sparkSession)
    messages = scratch.write(df.withColumn("__row", F.monotonically_increasing_id()))
    conv = F.col(conv_col).cast("string")
    narrow = messages.select(
        "__row", F.col(turn_col).alias("turn"),
        F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv)).alias("key"),
    )
    placed = scratch.write(number_rows(narrow, ["key"], [F.col("turn"), F.col("__row")], "n"))
    units = (
        messages.select("__row", _hashes(runs(parsed_lines(F.col(text_col)))).alias("units"))
        .select("__row", F.explode("units").alias("u")).select("__row", "u.*")
        .join(placed.select("__row", "key", "n"), "__row")
    )
    units = scratch.write(units.select("__row", "key", "n", "level", "hash"))
    originals = units.where("level = 0").groupBy("key", "hash").agg(F.min("n").alias("origin"))
    quoted = units.where("level > 0").join(originals, ["key", "hash"], "left")
    before = F.when(F.col("origin") < F.col("n"), F.col("origin"))
    links = quoted.withColumn("origin", before).groupBy("__row").agg(
        F.count(F.lit(1)).alias("quotes"), F.count("origin").alias("matched"),
        F.max("level").alias("levels"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", (-F.col("origin")).alias("o")))).alias("nearest"),
    )
    parent = F.coalesce(-F.col("nearest.o"), F.when(F.col("n") > 1, F.col("n") - 1))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return messages, scratch.write(placed.join(links, "__row", "left").select(
        "__row", "key", "n", parent.alias("parent"), zero("quotes").alias("quotes"),
        zero("matched").alias("matched"), zero("levels").alias("levels"),
    ))


def depths(places: DataFrame) -> DataFrame:
    """(__row, depth): replies between a message and the first of its conversation.

    Every round doubles the length of the jumps towards the root, so the number of
    rounds is the logarithm of the longest chain. Messages that have arrived take no part in
    later rounds but as targets; so short conversations cost no more because one is long. Every
    round is written to the shared folder.
    """
    scratch = Scratch(places.sparkSession)
    # A large conversation spreads over tasks, as the joins' keys have the place in it.
    jumps = scratch.write(places.select(
        "__row", "key", "n", F.coalesce("parent", F.lit(0)).alias("up"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"),
    ))
    arrived = jumps.where(F.col("up") == 0)
    moving = jumps.where(F.col("up") > 0)
    while moving.limit(1).count():
        upper = arrived.unionByName(moving).select(
            "key", F.col("n").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more")
        )
        moved = scratch.write(
            moving.join(upper, ["key", "up"]).select(
                "__row", "key", "n", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth")
            )
        )
        arrived = arrived.unionByName(moved.where(F.col("up") == 0))
        moving = moved.where(F.col("up") > 0)
    return arrived.select("__row", "depth")


def conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """A row for each message, without quoted text, in reply order.

    Columns: conv_id, position (from 1; every reply comes after what it answers), turn, role, text,
    reply_to (position, null for the first), depth, quote_levels, quotes, matched. Messages are in
    the order of their turns; ties and null turns, which come first, by place in the
    input. Messages without conv_id form one conversation. A null text stays null. Repeated rows
    are messages of their own. Other columns of ``df`` are not read.
    """
    df = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    messages, places = linked(df)
    found = places.join(depths(places), "__row")
    return messages.join(found, "__row").select(
        "conv_id", F.col("n").alias("position"), "turn", "role", unquoted(F.col("text")).alias("text"),
        F.col("parent").alias("reply_to"), "depth", F.col("levels").alias("quote_levels"), "quotes", "matched",
    )
