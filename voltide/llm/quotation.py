"""Quotation linking: replies that quote earlier messages are linked to them,
freed of their quotes, and put in reply order.

A line that begins with quote marks (``>``, any number, blanks between them) is
quoted at the level of its marks. Runs of lines of one level are passages.
Passages and unquoted paragraphs are normalised (lower case, blanks collapsed)
and hashed; a passage is joined to the original message, the first of the same
conversation with that unquoted paragraph, if that is an earlier one. A message
replies to the original of its outermost linked passage (of equally deep ones:
the latest); a message without a link starts a thread. Replies are followed up
to the start of their thread by pointer doubling, so that conversations can be
read thread by thread. No step needs a whole conversation in one task. All work
is done by DataFrame functions.

Cases: null and empty texts have no paragraph and no quote; passages of fewer
than ``MIN_CHARS`` normalised characters ("> ok") link nothing; rows that repeat a conversation
and turn count as one message when links are made and are each returned; rows
without conversation or turn are returned without links.
Only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.session import materialize

MIN_CHARS = 12
#: A line of quote marks and its text.
QUOTE = r"^[\x20\t]*(>[>\x20\t]*)(.*)$"
#: "On ... wrote:" lines that announce a quote.
LEAD = r"(?i)^[\x20\t]*(on\x20.*\x20wrote|le\x20.*\x20a\x20écrit|am\x20.*\x20schrieb.*|el\x20.*\x20escribió)\x20*:[\x20\t]*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _runs(lines: Column) -> Column:
    """Runs of neighbouring lines of one level, as (level, text). Blank
    unquoted lines end a run."""
    nothing = F.struct(F.array().cast("array<struct<level:int,text:string>>").alias("done"), F.lit(-1).alias("level"), F.array().cast("array<string>").alias("held"))
    flushed = lambda a: F.when(F.size(a["held"]) > 0, F.concat(a["done"], F.array(F.struct(a["level"].alias("level"), F.array_join(a["held"], "\n").alias("text"))))).otherwise(a["done"])

    def add(a: Column, x: Column) -> Column:
        blank = F.trim(x["text"]) == ""
        more = ~blank & (x["level"] == a["level"])
        return F.struct(
            F.when(more, a["done"]).otherwise(flushed(a)).alias("done"),
            F.when(blank, F.lit(-1)).otherwise(x["level"]).alias("level"),
            F.when(blank, F.array().cast("array<string>")).when(more, F.concat(a["held"], F.array(x["text"]))).otherwise(F.array(x["text"])).alias("held"),
        )

    return F.aggregate(lines, nothing, add, flushed)


def parse_messages(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Per message: ``conv``, ``turn``, ``role``, ``clean`` (the unquoted text),
    ``depth`` (deepest quote level) and ``passages`` (level, hash) with level 0
    for its own paragraphs."""
    d = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    marks = lambda x: F.regexp_extract(x, QUOTE, 1)
    level = lambda x: F.length(marks(x)) - F.length(F.replace(marks(x), F.lit(">"), F.lit("")))
    body = lambda x: F.when(x.rlike(QUOTE), F.regexp_extract(x, QUOTE, 2)).otherwise(x)
    lines = F.filter(F.transform(F.split("text", "\r?\n"), lambda x: F.struct(level(x).alias("level"), body(x).alias("text"))), lambda x: (x["level"] > 0) | ~x["text"].rlike(LEAD))
    d = d.withColumn("lines", lines).withColumn("runs", _runs(F.col("lines")))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n")
    hashes = F.transform("runs", lambda r: F.struct(r["level"].alias("level"), F.when(F.length(_normal(r["text"])) >= MIN_CHARS, F.sha2(_normal(r["text"]), 256)).alias("hash")))
    quoted = F.exists("lines", lambda x: x["level"] > 0)
    return d.select(
        "conv",
        "turn",
        "role",
        F.when(quoted, F.regexp_replace(own, r"^\s+|\s+$", "")).otherwise(F.col("text")).alias("clean"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("depth"),
        F.filter(hashes, lambda h: h["hash"].isNotNull()).alias("passages"),
    )


def thread_starts(parents: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``start`` and ``reply_depth`` of every message with a
    parent, by pointer doubling: as many rounds as the depth has binary digits."""
    hops = materialize(parents.select("conv", "turn", F.col("parent").alias("start"), F.lit(1).alias("reply_depth")), "hops")
    while True:
        further = hops.select("conv", F.col("turn").alias("start"), F.col("start").alias("next"), F.col("reply_depth").alias("more"))
        step = hops.join(further, ["conv", "start"], "left")
        step = materialize(step.select("conv", "turn", F.coalesce("next", "start").alias("start"), (F.col("reply_depth") + F.coalesce("more", F.lit(0))).alias("reply_depth"), F.col("next").isNotNull().alias("moved")), "hops")
        hops = step.drop("moved")
        if step.where("moved").isEmpty():
            return hops


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per message: conversation, turn, role, ``clean_text``, ``quote_depth``,
    ``n_quotes`` (passages quoted), ``n_linked`` (those joined to an earlier
    message), ``parent_turn`` (null: starts a thread), ``thread_turn`` (the turn
    its thread starts with) and ``reply_depth``. Sorted by conversation,
    ``thread_turn`` and turn, replies follow what they answer."""
    parsed = materialize(parse_messages(messages, conv_col, turn_col, role_col, text_col), "messages")
    named = parsed.where("conv IS NOT NULL AND turn IS NOT NULL")
    passages = named.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.level", "p.hash")
    # Both sides are summed before they meet: one row per paragraph and conversation.
    originals = passages.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("source"))
    quotes = passages.where("level > 0").groupBy("conv", "hash", "turn").agg(F.min("level").alias("level"))
    linked = quotes.join(originals, ["conv", "hash"]).where("source < turn")
    parents = linked.groupBy("conv", "turn").agg(F.count("*").alias("n_linked"), F.max_by("source", F.struct(-F.col("level"), "source")).alias("parent"))
    parents = materialize(parents, "parents")
    n_quotes = F.size(F.array_distinct(F.transform(F.filter("passages", lambda p: p["level"] > 0), lambda p: p["hash"])))
    out = parsed.withColumn("n_quotes", n_quotes).join(parents, ["conv", "turn"], "left").join(thread_starts(parents), ["conv", "turn"], "left")
    return out.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("clean").alias("clean_text"),
        F.col("depth").alias("quote_depth"),
        F.col("n_quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("parent").alias("parent_turn"),
        F.when(F.col("conv").isNotNull(), F.coalesce("start", "turn")).alias("thread_turn"),
        F.coalesce("reply_depth", F.lit(0)).alias("reply_depth"),
    )


def reply_ordered(linked: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """The messages in reply order, dealt by ranges: a long conversation may
    span several partitions."""
    order = [conv_col, "thread_turn", turn_col]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)
