"""Quotation linking: conversations in reply order, without the quotes. DataFrame functions only.

A line's quote level is the number of `>` before it. Lines of one level in a row are a passage; blank
lines end one. A passage, and each of its lines, is normalised (small letters, single blanks) and
hashed, and each quoted hash finds the latest earlier message of the conversation that has it among
its own, unquoted, passages and lines. A line of a passage that isn't found whole goes by itself.
A message replies to the message that most of the quoted letters of its lowest linked level come from,
the latest one if several do. A thread is what replies lead back to one message, and a conversation's
order is that of the threads' first turns, then of turns, so that a reply always follows.

Texts of messages that nobody quotes in a conversation without quotes are never taken apart. The
search for the latest earlier message runs in chunks of turns, and positions come from a range
partitioning, so a conversation that holds a large part of all rows is spread over tasks.

Defined results: a null text is empty; a message without linked quotes begins a thread; rows that
repeat a turn share their links and each get a position, in the order of role and body; a null conv_id
is a conversation of its own without links, a null turn is first and has no links; quotes that no
message is found for go from the body as well and are counted; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import cut_lineage

QUOTE = r"^[ \t]*>"
MARKS = r"^[ \t]*((?:>[ \t]*)+)"
ATTRIBUTION = r"^On .+ wrote:[ \t]*$"
LINE_BREAK = r"\r?\n"
#: Turns that one task looks through for the latest earlier message.
CHUNK = 1024
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), LINE_BREAK)


def has_quotes(text: Column) -> Column:
    return F.coalesce(text.rlike(f"(?m){QUOTE}"), F.lit(False))


def body(text: Column) -> Column:
    """The text without quoted lines and the lines that introduce them; unchanged if nothing is quoted."""
    lines = _lines(text)
    own = F.filter(
        lines,
        lambda x, i: ~x.rlike(QUOTE)
        & ~(x.rlike(ATTRIBUTION) & F.coalesce(F.get(lines, i + 1).rlike(QUOTE), F.lit(False))),
    )
    joined = F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")
    return F.when(has_quotes(text), joined).otherwise(F.coalesce(text, F.lit("")))


def _marked_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, text_id, passage, level, words) of every line that isn't blank, in the
    conversations that quote."""
    quoting = messages.where(has_quotes(F.col("text"))).select("conv_id").distinct()
    some = messages.where("turn is not null").join(quoting, "conv_id", "left_semi")
    some = some.select("conv_id", "turn", F.sha2("text", 256).alias("text_id"), "text").dropDuplicates(
        ["conv_id", "turn", "text_id"]
    )
    lines = some.select("conv_id", "turn", "text_id", F.posexplode(_lines(F.col("text"))).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 1)
    lines = lines.select(
        "conv_id", "turn", "text_id", "line",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        F.lower(F.trim(F.regexp_replace(F.regexp_replace("raw", MARKS, ""), r"\s+", " "))).alias("words"),
    )
    message = Window.partitionBy("conv_id", "turn", "text_id").orderBy("line")
    kind = F.struct("level", F.col("words") == "")
    begins = F.coalesce((kind != F.lag(kind).over(message)).cast("int"), F.lit(1))
    lines = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(message))
    return lines.where("words <> ''").drop("begins")


def _sources(units: DataFrame) -> DataFrame:
    """(conv_id, turn, unit, source) of quoted units: the latest earlier turn that has it as its own."""
    each = units.groupBy("conv_id", "unit", "turn").agg(
        F.max(F.when(F.col("level") == 0, F.col("turn"))).alias("own"), F.max("level").alias("level")
    )
    each = cut_lineage(each.withColumn("chunk", F.floor(F.col("turn") / CHUNK)))
    inside = Window.partitionBy("conv_id", "unit", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    near = each.withColumn("near", F.max("own").over(inside)).where("level > 0")
    chunks = each.groupBy("conv_id", "unit", "chunk").agg(F.max("own").alias("own"))
    before = Window.partitionBy("conv_id", "unit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "unit", "chunk", F.max("own").over(before).alias("far"))
    joined = near.join(chunks, ["conv_id", "unit", "chunk"])
    return joined.select("conv_id", "turn", "unit", F.coalesce("near", "far").alias("source")).where("source is not null")


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, text_id, passage, level, words, letters, source) of each quoted passage; source
    is the turn that most of its letters come from, or null."""
    lines = cut_lineage(_marked_lines(messages))
    of = ["conv_id", "turn", "text_id", "passage", "level"]
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("line", "words"))), lambda x: x["words"])
    passages = lines.groupBy(of).agg(F.array_join(ordered, " ").alias("passage_words"))  # one message's at most
    passages = cut_lineage(passages.withColumn("whole", F.sha2("passage_words", 256)))
    lines = lines.withColumn("unit", F.sha2("words", 256))
    units = passages.select("conv_id", "turn", "level", F.col("whole").alias("unit"))
    found = cut_lineage(_sources(units.unionByName(lines.select("conv_id", "turn", "level", "unit"))))
    whole = found.select("conv_id", "turn", F.col("unit").alias("whole"), F.col("source").alias("whole_source"))
    quoted = lines.where("level > 0").join(passages, of).join(found, ["conv_id", "turn", "unit"], "left")
    quoted = quoted.join(whole, ["conv_id", "turn", "whole"], "left")
    quoted = quoted.withColumn("source", F.coalesce("whole_source", "source"))
    votes = quoted.groupBy(*of, "passage_words", "source").agg(F.sum(F.length("words")).alias("letters"))
    best = F.max(F.struct(F.col("source").isNotNull(), "letters", "source")).alias("best")
    return votes.groupBy(*of, "passage_words").agg(F.sum("letters").alias("letters"), best).select(
        *of, F.col("passage_words").alias("words"), "letters", F.col("best.source").alias("source")
    )


def replies(passages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_quotes, n_linked) of the messages that quote."""
    votes = passages.groupBy("conv_id", "turn", "level", "source").agg(
        F.sum("letters").alias("letters"), F.count("*").alias("n")
    )
    linked = F.col("source").isNotNull()
    best = F.max(F.when(linked, F.struct(-F.col("level"), "letters", "source"))).alias("best")
    counts = (F.sum("n").alias("n_quotes"), F.coalesce(F.sum(F.when(linked, F.col("n"))), F.lit(0)).alias("n_linked"))
    return votes.groupBy("conv_id", "turn").agg(best, *counts).select(
        "conv_id", "turn", F.col("best.source").alias("reply_to"), "n_quotes", "n_linked"
    )


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, thread) of the messages that reply: the first turn that replies lead back to.
    Each round doubles how far back a message looks."""
    links = cut_lineage(linked.where("reply_to is not null").select("conv_id", "turn", F.col("reply_to").alias("thread")))
    while True:
        up = links.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        longer = cut_lineage(links.join(up, ["conv_id", "thread"], "left"))
        links = longer.select("conv_id", "turn", F.coalesce("further", "thread").alias("thread"))
        if not longer.where("further is not null").head(1):
            return links


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, reply_to, thread, position, n_quotes, n_linked, formatted) of every
    message, positions from 0 within a conversation in reply order."""
    messages = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    linked = cut_lineage(replies(quoted_passages(messages)))
    found = linked.join(threads(linked), ["conv_id", "turn"], "left")
    out = messages.select("conv_id", "turn", "role", body(F.col("text")).alias("body"))
    out = out.join(found, ["conv_id", "turn"], "left")
    none = F.lit(0).cast("long")
    out = out.withColumns({
        "thread": F.coalesce("thread", "turn"),
        "n_quotes": F.coalesce("n_quotes", none),
        "n_linked": F.coalesce("n_linked", none),
    })
    return _positions(out, ["thread", "turn", "role", "body"]).withColumn("formatted", formatted())


def formatted() -> Column:
    """A message as a line of the chat format."""
    return F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"), "body", F.lit(f"{END}\n"))


def _positions(df: DataFrame, order: list[str]) -> DataFrame:
    """Number the rows of each conversation in this order. Rows are dealt out by ranges of the whole
    order, so a large conversation lies in many tasks; each task numbers its own, and what the tasks
    before it hold of a conversation is added."""
    keys = ["conv_id", *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = dealt.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    dealt = cut_lineage(dealt)
    held = dealt.groupBy("conv_id", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    held = held.select(F.col("conv_id").alias("_conv"), F.col("_part").alias("_of"), "_first", "_before")
    joined = dealt.join(held, dealt["conv_id"].eqNullSafe(held["_conv"]) & (dealt["_part"] == held["_of"]))
    return joined.withColumn("position", F.col("_row") - F.col("_first") + F.col("_before")).drop(
        "_part", "_row", "_conv", "_of", "_first", "_before"
    )
