"""Chat formatting by quotation linking, in DataFrame operations only.

A line's quote level is the number of '>' that it starts with (blanks between them allowed); a run of
neighbouring lines of one level above 0 is a quoted passage. Passages, and failing that their
lines, are hashed in normal form (lower case, blanks collapsed) and meet the messages of the
same conversation whose own text, block or line has that hash; the latest one before counts. A
message replies to the original of its outermost linked quote. Replies follow, in turn, the message
that their chain of quotes starts from; other messages stand in order. The conversation comes
without quotes, in parts of ``part`` messages, so that no part is unbounded.

Messages with equal conversation, turn, role and text are one. A null text is empty, a null role
``unknown``, a null turn comes last, and messages without a conversation form one together.
Messages of one turn stand in order of role and text. A quote that meets nothing is only taken out.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import written

#: The marks at a line's start, whose '>' make its level.
MARKS = r"^(?:[ \t]*>)+"
#: Turn of messages without one.
LAST = 1 << 61
#: Neighbouring turns that are counted together.
TOGETHER = 256


def _normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def messages(conversations: DataFrame) -> DataFrame:
    """``conv, conv_id, turn, role, text`` of distinct messages; ``conv`` is a key without nulls."""
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")).alias("conv"), F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(LAST)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).distinct()


def parsed(rows: DataFrame) -> DataFrame:
    """Add ``blocks``: the text's runs of lines of one level, as (level, lines) in order."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"), F.regexp_replace(x, MARKS, "").alias("line")))

    def blocks(found: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: (i == 0) | (F.get(found, i)["level"] != F.get(found, i - 1)["level"]))
        return _let(starts, lambda s: F.transform(s, lambda at, k: F.struct(F.get(found, at)["level"].alias("level"), F.transform(
            F.slice(found, at + 1, F.coalesce(F.get(s, k + 1), F.size(found)) - at), lambda x: x["line"]).alias("lines"))))

    return rows.withColumn("blocks", _let(lines, blocks))


def _hashes(block: Column) -> Column:
    """Of a block as a whole (rank 0) and of its lines (rank 1), without empty ones."""
    whole = F.array(F.struct(F.lit(0).alias("rank"), _normal(F.array_join(block, "\n")).alias("text")))
    each = F.transform(block, lambda x: F.struct(F.lit(1).alias("rank"), _normal(x).alias("text")))
    return F.transform(F.filter(F.concat(whole, each), lambda x: x["text"] != ""), lambda x: F.struct(x["rank"].alias("rank"), F.md5(x["text"]).alias("hash")))


def quotes(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, place, level, rank, hash`` of every quoted passage and its lines."""
    return rows.select("conv", "turn", "role", "text", F.posexplode("blocks").alias("place", "block")).filter("block.level > 0").select(
        "conv", "turn", "role", "text", "place", F.col("block.level").alias("level"), F.explode(F.array_distinct(_hashes(F.col("block.lines")))).alias("h")).select(
        "conv", "turn", "role", "text", "place", "level", "h.rank", "h.hash")


def own_text(blocks: Column) -> Column:
    """The text without quotes, without blanks at its ends."""
    own = F.flatten(F.transform(F.filter(blocks, lambda b: b["level"] == 0), lambda b: b["lines"]))
    return F.btrim(F.array_join(own, "\n"), F.lit(" \t\n\r"))


def originals(rows: DataFrame) -> DataFrame:
    """``conv, turn, hash`` of each message's own text, its blocks and lines."""
    own = F.filter("blocks", lambda b: b["level"] == 0)
    every = F.flatten(F.transform(own, lambda b: _hashes(b["lines"])))
    whole = F.md5(_normal(own_text(F.col("blocks"))))
    return rows.select("conv", "turn", F.explode(F.array_distinct(F.concat(F.array(whole), F.transform(every, lambda h: h["hash"])))).alias("hash")).distinct()


def linked(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, place, level, original``: every quoted passage with the turn of its original, if it has one."""
    asked = quotes(rows)
    # Only conversations with a quote need their messages hashed.
    held = originals(rows.join(asked.select("conv").distinct(), "conv", "left_semi"))
    none = lambda kind: F.lit(None).cast(kind)
    both = asked.withColumn("own", none("bigint")).unionByName(held.select(
        "conv", "turn", none("string").alias("role"), none("string").alias("text"), none("int").alias("place"), none("int").alias("level"),
        none("int").alias("rank"), "hash", F.col("turn").alias("own")))
    # A running maximum: no pair of quote and original is made.
    before = Window.partitionBy("conv", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("original", F.max("own").over(before)).filter("own is null")
    return found.groupBy("conv", "turn", "role", "text", "place", "level").agg(
        F.max(F.when(F.col("original").isNotNull(), F.struct(-F.col("rank"), F.col("original").alias("turn"))))["turn"].alias("original"))


def replies(passages: DataFrame) -> DataFrame:
    """``conv, turn, up``: the turn that each replying turn answers, by its outermost linked quote, the latest of them."""
    return passages.filter("original is not null").groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "original"))["original"].alias("up"))


def thread_starts(answers: DataFrame) -> DataFrame:
    """Follow ``up`` to where the chain starts; every round doubles the steps taken."""
    current = written(answers)
    while True:
        above = current.select("conv", F.col("turn").alias("up"), F.col("up").alias("further"))
        joined = written(current.join(above, ["conv", "up"], "left").select(
            "conv", "turn", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")))
        current = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return current


def placed(rows: DataFrame) -> DataFrame:
    """Add ``position``, counted from 0 in each conversation, by thread and turn; counts of small cells stand for a sort of the whole."""
    cell = ["conv", "far", "thread", "near"]
    marked = rows.withColumn("far", F.floor(F.col("thread") / TOGETHER)).withColumn("near", F.floor(F.col("turn") / TOGETHER))
    cells = marked.groupBy(cell).agg(F.count("*").alias("n"))
    upto = lambda by, *order: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = cells.groupBy("conv", "far").agg(F.sum("n").alias("n")).select(
        "conv", "far", F.coalesce(F.sum("n").over(upto(["conv"], "far")), F.lit(0)).alias("first"))
    inner = cells.withColumn("next", F.coalesce(F.sum("n").over(upto(["conv", "far"], "thread", "near")), F.lit(0))).drop("n")
    offset = inner.join(outer, ["conv", "far"]).select(*cell, (F.col("first") + F.col("next")).alias("offset"))
    inside = Window.partitionBy(*cell).orderBy("turn", "role", "text")
    return marked.withColumn("at", F.row_number().over(inside)).join(offset, cell).withColumn(
        "position", F.col("offset") + F.col("at") - 1).drop("far", "near", "at", "offset")


def threaded(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, body, quoted, linked, reply_to, thread, position``: a row per message, in reply order."""
    rows = written(parsed(messages(conversations)))
    passages = written(linked(rows))
    answers = replies(passages)
    starts = thread_starts(answers)
    counted = passages.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("quoted"), F.count("original").alias("linked"))
    full = rows.join(counted, ["conv", "turn", "role", "text"], "left").join(answers.withColumnRenamed("up", "reply_to"), ["conv", "turn"], "left").join(
        starts.withColumnRenamed("up", "start"), ["conv", "turn"], "left")
    out = full.select("conv", "conv_id", "turn", "role", "text", own_text(F.col("blocks")).alias("body"), F.coalesce("quoted", F.lit(0)).alias("quoted"),
                      F.coalesce("linked", F.lit(0)).alias("linked"), "reply_to", F.coalesce("start", "turn").alias("thread"))
    return placed(out).drop("text")


def formatted(conversations: DataFrame, part: int = 64) -> DataFrame:
    """``conv_id, part, n_messages, n_quotes, n_linked, turns, content``: parts of conversations in reply order, without quotes."""
    rows = threaded(conversations).withColumn("part", F.floor(F.col("position") / part))
    message = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("body"), F.lit("\n"))
    held = rows.groupBy("conv", "part").agg(  # part rows at most
        F.max("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("position", "turn", message.alias("message")))).alias("m"),
        F.count("*").alias("n_messages"), F.sum("quoted").alias("n_quotes"), F.sum("linked").alias("n_linked"))
    turns = F.transform("m", lambda x: F.when(x["turn"] == LAST, F.lit("-")).otherwise(x["turn"].cast("string")))
    return held.select("conv_id", "part", "n_messages", "n_quotes", "n_linked", F.array_join(turns, " ").alias("turns"),
                       F.array_join(F.transform("m", lambda x: x["message"]), "").alias("content"))
