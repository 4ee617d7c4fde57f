"""Quotation linking: which message each message answers, and its text without quotes.

Lines that start with ``>`` are quoted, as deep as there are markers (blanks between
them allowed). Consecutive lines of one depth are a passage. Passages and the
messages' own paragraphs and bodies are normalised (markers off, letters lowered,
blanks joined) and hashed; a passage belongs to the latest earlier message of its
conversation with a paragraph, body or line of the same hash, line by line where the
passage as a whole has none. A message answers the message that its shallowest
linked quote comes from, else the one before it.

Only hashes that are quoted somewhere are looked up among the originals. The lookup
orders turns in blocks and carries one value per block, so neither a long
conversation nor a common line is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, as_text, materialise

MARKS = rf"^([{BLANKS}]*>)+[{BLANKS}]?"
BLOCK = 64  # turns that are put in order together


def depth_of(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]+", ""))


def normalised(text: Column) -> Column:
    """Quote markers off every line, letters lowered, blanks joined and trimmed."""
    plain = F.regexp_replace(text, rf"(?m){MARKS}", "")
    return F.trim(F.regexp_replace(F.lower(plain), f"[{BLANKS}]+", " "))


def latest_before(rows: DataFrame, keys: Sequence[str], turn: str, known: str, out: str) -> DataFrame:
    """For each row, the largest ``known`` turn of its key that lies before ``turn``.

    Rows with ``known`` are the ones to be found. Turns are cut into blocks; within a
    block a window looks back, and a running maximum over blocks carries the rest.
    """
    cut = rows.withColumn("_block", F.floor(F.col(turn) / BLOCK))
    back = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_block").agg(F.max(known).alias("_last")).select(*keys, "_block", F.max("_last").over(back).alias("_carried"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.max(known).over(inside))
        .join(carried, [*keys, "_block"])
        .withColumn(out, F.coalesce("_inside", "_carried"))
        .drop("_block", "_inside", "_carried")
    )


def _lines(messages: DataFrame) -> DataFrame:
    """One row per line that holds more than blanks: conv_id, turn, at, depth, line."""
    line = F.posexplode(F.split("text", "\n")).alias("at", "line")
    rows = messages.select("conv_id", "turn", line).withColumn("depth", depth_of(F.col("line")))
    return rows.where(F.length(normalised(F.col("line"))) > 0)


def passages(messages: DataFrame) -> DataFrame:
    """Quoted passages (conv_id, turn, at, depth, passage, lines), found within each text.

    A fold over a text's lines closes a passage whenever the depth changes; no text is
    regrouped over the network.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(depth_of(x).alias("depth"), x.alias("line"), i.alias("at")))
    empty = "array<struct<depth:int,at:int,lines:array<string>>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        grown = F.struct(last["depth"].alias("depth"), last["at"].alias("at"), F.concat(last["lines"], F.array(x["line"])).alias("lines"))
        opened = F.struct(x["depth"].alias("depth"), x["at"].alias("at"), F.array(x["line"]).alias("lines"))
        return F.when(last["depth"] == x["depth"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(
            F.concat(acc, F.array(opened))
        )

    quoted = messages.where(F.col("text").rlike(rf"(?m)^[{BLANKS}]*>"))
    runs = F.aggregate(lines, F.array().cast(empty), step)
    found = quoted.select("conv_id", "turn", F.explode(runs).alias("r")).where("r.depth > 0")
    return found.select("conv_id", "turn", "r.at", "r.depth", F.col("r.lines").alias("lines"), F.array_join("r.lines", "\n").alias("passage"))


def without_quotes(text: Column) -> Column:
    """The message's own lines."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(rf"^[{BLANKS}]*>"))
    return F.trim(F.array_join(kept, "\n"))


def _hash(text: Column) -> Column:
    return F.xxhash64(normalised(text))


def quotation_links(messages: DataFrame) -> DataFrame:
    """Quoted passages and the turn each comes from: conv_id, turn, at, depth, passage, from_turn.

    A passage without a match is looked up line by line, and takes the latest turn
    that any of its lines comes from; ``from_turn`` is NULL where none is found.
    """
    found = materialise(passages(messages))
    wholes = found.select("conv_id", "turn", "at", "depth", _hash(F.col("passage")).alias("hash"), F.lit(True).alias("whole"))
    single = found.select("conv_id", "turn", "at", "depth", F.explode("lines").alias("line"))
    wanted = materialise(
        wholes.unionByName(
            single.where(F.length(normalised(F.col("line"))) > 0).select("conv_id", "turn", "at", "depth", _hash(F.col("line")).alias("hash"), F.lit(False).alias("whole"))
        )
    )
    body = without_quotes(F.col("text"))
    units = F.array_distinct(F.concat(F.array(body), F.split(body, rf"\n[{BLANKS}]*\n"), F.split(body, "\n")))
    own = (
        messages.select("conv_id", "turn", F.explode(units).alias("unit"))
        .where(F.length(normalised(F.col("unit"))) > 0)
        .select("conv_id", "turn", _hash(F.col("unit")).alias("hash"))
    )
    asked = wanted.select("conv_id", "hash").distinct()
    own = own.join(asked, ["conv_id", "hash"], "left_semi").distinct()
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("at", "int"), ("depth", "int"), ("whole", "boolean"))]
    both = own.select("conv_id", "hash", "turn", F.col("turn").alias("own"), *nothing).unionByName(
        wanted.select("conv_id", "hash", "turn", F.lit(None).cast("long").alias("own"), "at", "depth", "whole")
    )
    matched = latest_before(both, ["conv_id", "hash"], "turn", "own", "source").where("whole is not null")
    best = matched.groupBy("conv_id", "turn", "at", "depth").agg(
        F.max(F.when(F.col("whole"), F.col("source"))).alias("by_whole"), F.max(F.when(~F.col("whole"), F.col("source"))).alias("by_line")
    )
    return found.join(best, ["conv_id", "turn", "at", "depth"], "left").select(
        "conv_id", "turn", "at", "depth", "passage", F.coalesce("by_whole", "by_line").alias("from_turn")
    )


def conversations(messages: DataFrame) -> DataFrame:
    """Messages without quotes in reply order.

    Returns conv_id, turn, role, body, n_quotes, n_linked, reply_to (the turn it
    answers, NULL for the first) and thread. Sorted by (thread, turn), a conversation
    has every message behind the one it answers: a message that answers the turn
    before it goes on in that one's thread, any other opens one below it, named by the
    first turns on the way, ten digits each.

    NULL and empty texts have an empty body and no quotes; rows without conv_id or
    turn are kept without links; of messages that share conv_id and turn each gets
    the same links; an empty table gives an empty result; other columns are not read.
    """
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", as_text(F.col("text")).alias("text"))
    usable = rows.where("conv_id is not null and turn is not null")
    linked = materialise(quotation_links(usable))
    nearest = linked.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_quotes"),
        F.count("from_turn").alias("n_linked"),
        F.min_by("from_turn", F.when(F.col("from_turn").isNotNull(), F.struct("depth", -F.col("from_turn"), "at"))).alias("quoted"),
    )
    turns = usable.select("conv_id", "turn").distinct().withColumn("own", F.col("turn"))
    order = latest_before(turns, ["conv_id"], "turn", "own", "before").drop("own")
    tree = order.join(nearest, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "before", F.coalesce("quoted", "before").alias("reply_to"), "n_quotes", "n_linked"
    )
    tree = materialise(tree)
    # heads of threads: first turns, and turns that answer another than the one before
    digits = F.lpad(F.col("turn").cast("string"), 10, "0")
    heads = materialise(
        tree.where("before is null or reply_to <> before").select("conv_id", F.col("turn").alias("head"), "reply_to", digits.alias("path"))
    )
    heads = materialise(_enclosing(heads, heads.select("conv_id", F.col("reply_to").alias("turn")).where("turn is not null").distinct(), heads))
    while True:
        up = heads.select("conv_id", F.col("head").alias("above"), F.col("path").alias("above_path"), F.col("above").alias("next"))
        heads = materialise(
            heads.join(up, ["conv_id", "above"], "left").select(
                "conv_id", "head", F.col("next").alias("above"), F.concat(F.coalesce("above_path", F.lit("")), "path").alias("path")
            )
        )
        if heads.where("above is not null").limit(1).count() == 0:
            break
    threads = _head_of(tree.select("conv_id", "turn"), heads).join(heads.select("conv_id", "head", "path"), ["conv_id", "head"])
    named = tree.join(threads.select("conv_id", "turn", F.col("path").alias("thread")), ["conv_id", "turn"])
    body = without_quotes(F.col("text"))
    return rows.join(named, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", body.alias("body"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to", "thread"
    )


def _head_of(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """The head of the thread that holds each turn: the latest head at or before it."""
    marks = heads.select("conv_id", F.col("head").alias("turn"), F.col("head").alias("own"), F.lit(False).alias("asked"))
    both = marks.unionByName(turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(None).cast("long").alias("own"), F.lit(True).alias("asked")))
    found = latest_before(both, ["conv_id"], "turn", "own", "head").where("asked")
    return found.select("conv_id", (F.col("turn") - 1).alias("turn"), "head")


def _enclosing(heads: DataFrame, answered: DataFrame, marks: DataFrame) -> DataFrame:
    """Heads with ``above``, the head of the thread that holds the turn they answer."""
    of_turn = _head_of(answered, marks).select("conv_id", F.col("turn").alias("reply_to"), F.col("head").alias("above"))
    return heads.join(of_turn, ["conv_id", "reply_to"], "left").select("conv_id", "head", "above", "path")
