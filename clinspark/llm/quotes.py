"""Quotation linking: replies are joined to what they quote, and quotes are taken out. DataFrame functions only.

**Parsing.** A line's quote level is the number of ``>`` at its start (one space may stand before each). A passage is a run of
neighbouring lines of one level above 0. Its text is compared in normal form: marks off, lower case, white space folded,
blank lines left out.

**Linking.** A passage is looked up, by hash and text, among what messages say themselves: whole bodies, paragraphs and
lines. The message that is meant is the first of the same conversation that said it before; else the first of all
messages before it, in the order of conversation and turn. Each text has one first message, and one in each
conversation, so a line that everybody writes joins one row. A message replies to what its outermost, first passage
with a link quotes.

**Order.** Each message gets the first message of its thread and its depth below it, by doubling the length of the links in
each step. Sorted by thread, depth, conversation and turn, every message stands after what it replies to.

Messages with a null conversation or turn, or without text, have no links and are threads of their own. Rows that
repeat a conversation and turn share their links. Own lines that only announce a quote ("... wrote:") go with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinspark.staging import Staging

_MARKS = r"^((?:\s?>)+)"
_ANNOUNCES = r"^\s*On .{1,200} wrote:\s*$"


def level(line) -> F.Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[^>]", ""))


def normal(line) -> F.Column:
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def own_text(text) -> F.Column:
    """The text without quotes, their announcements and blank lines at its ends."""
    kept = F.filter(F.split(text, "\n", -1), lambda line: (level(line) == 0) & ~line.rlike(_ANNOUNCES))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, place, level, said``: quoted passages, in the order of their first lines."""
    key = ["conv_id", "turn", "version"]
    lines = messages.where(F.col("text").contains(">")).select(
        "conv_id", "turn", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line")
    ).dropDuplicates([*key, "at"]).select(*key, "at", level("line").alias("level"), normal("line").alias("said"))
    # A message is as long as its text, so a window over it is bounded.
    of_level = Window.partitionBy(*key, "level").orderBy("at")
    runs = lines.withColumn("run", F.col("at") - F.row_number().over(of_level)).where("level > 0 and said <> ''")
    return runs.groupBy(*key, "level", "run").agg(
        F.min("at").alias("place"), F.array_sort(F.collect_list(F.struct("at", "said"))).alias("lines")
    ).select("conv_id", "turn", "place", "level", F.array_join("lines.said", "\n").alias("said"))


def sayings(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, said``: bodies, paragraphs and lines of what messages say themselves."""
    body = F.transform(F.split("own", "\n", -1), lambda line: F.trim(F.lower(F.regexp_replace(line, r"\s+", " "))))
    joined = F.regexp_replace(F.array_join("lines", "\n"), r"^\n+|\n+$", "")
    forms = F.array_distinct(F.concat(
        F.array(F.regexp_replace(joined, r"\n{2,}", "\n")), F.split(joined, r"\n{2,}", -1), F.col("lines")))
    return messages.select("conv_id", "turn", own_text("text").alias("own")).withColumn("lines", body).select(
        "conv_id", "turn", F.explode(forms).alias("said")).where("said <> ''")


def quote_links(messages: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id, turn, place, level, to_conv, to_turn`` for every passage whose original is known."""
    named = messages.where("conv_id is not null and turn is not null and text is not null")
    quoted = staging.table(passages(named).withColumn("hash", F.xxhash64("said")))
    wanted = quoted.select("hash").distinct()
    said = sayings(named).withColumn("hash", F.xxhash64("said")).join(wanted, "hash", "left_semi")
    near = said.groupBy("hash", "said", "conv_id").agg(F.min("turn").alias("near_turn"))
    near = staging.table(near)
    first = near.groupBy("hash", "said").agg(F.min(F.struct("conv_id", "near_turn")).alias("first"))
    found = quoted.join(near, ["hash", "said", "conv_id"], "left").join(first, ["hash", "said"], "left")
    inside = F.col("near_turn") < F.col("turn")
    before = (F.col("first.conv_id") < F.col("conv_id")) | (
        (F.col("first.conv_id") == F.col("conv_id")) & (F.col("first.near_turn") < F.col("turn")))
    return found.select(
        "conv_id", "turn", "place", "level",
        F.when(inside, F.col("conv_id")).when(before, F.col("first.conv_id")).alias("to_conv"),
        F.when(inside, F.col("near_turn")).when(before, F.col("first.near_turn")).alias("to_turn"),
    ).where("to_turn is not null")


def threads(replies: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id, turn, to_conv, to_turn, thread_conv, thread_turn, depth`` of messages that reply to an earlier one."""
    chain = staging.table(replies.select(
        "conv_id", "turn", "to_conv", "to_turn", F.col("to_conv").alias("thread_conv"), F.col("to_turn").alias("thread_turn"),
        F.lit(1).cast("bigint").alias("depth")))
    while True:
        above = chain.select(
            F.col("conv_id").alias("thread_conv"), F.col("turn").alias("thread_turn"),
            F.col("thread_conv").alias("next_conv"), F.col("thread_turn").alias("next_turn"), F.col("depth").alias("more"))
        longer = staging.table(chain.join(above, ["thread_conv", "thread_turn"], "left").select(
            "conv_id", "turn", "to_conv", "to_turn",
            F.coalesce("next_conv", "thread_conv").alias("thread_conv"),
            F.coalesce("next_turn", "thread_turn").alias("thread_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("more").isNotNull().alias("moved")))
        chain = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return chain


def link_quotes(messages: DataFrame, staging: Staging) -> DataFrame:
    """``messages`` (``conv_id, turn, role, text``) without their quotes, in threads.

    Adds ``own_text``, ``n_quotes``, ``n_linked`` (passages), ``to_conv, to_turn`` (what is replied to), ``thread_conv,
    thread_turn, depth`` and ``formatted`` (the role's header and the text); these replace columns of the same names.
    """
    plain = messages.select("conv_id", "turn", "text")
    links = staging.table(quote_links(plain, staging))
    replies = links.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "place", "to_conv", "to_turn")).alias("best"), F.count("*").alias("n_linked"))
    counted = staging.table(replies.select("conv_id", "turn", "best.to_conv", "best.to_turn", "n_linked"))
    chain = threads(counted, staging).join(counted.select("conv_id", "turn", "n_linked"), ["conv_id", "turn"])
    new = ["own_text", "n_quotes", "n_linked", "to_conv", "to_turn", "thread_conv", "thread_turn", "depth", "formatted"]
    kept = messages.drop(*new)
    said = F.filter(F.split("text", "\n", -1), lambda line: (level(line) == 0) | (normal(line) != ""))
    levels = F.transform(said, level)
    starts = F.size(F.filter(levels, lambda x, i: (x > 0) & (
        (i == 0) | (F.get(levels, i - 1).isNull()) | (F.get(levels, i - 1) != x))))
    return (
        kept.join(staging.table(chain), ["conv_id", "turn"], "left")
        .withColumn("own_text", own_text("text"))
        .withColumn("n_quotes", F.when(F.col("text").contains(">"), starts).otherwise(0).cast("bigint"))
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
        .withColumn("thread_conv", F.coalesce("thread_conv", "conv_id"))
        .withColumn("thread_turn", F.when(F.col("depth").isNull(), F.col("turn")).otherwise(F.col("thread_turn")))
        .withColumn("depth", F.coalesce("depth", F.lit(0)))
        .withColumn("formatted", F.concat(
            F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.coalesce("own_text", F.lit("")), F.lit("\n")))
        .select(*kept.columns, *new)
    )


def as_replies(messages: DataFrame) -> DataFrame:
    """The messages as mail programs would send them: below each text, quoted, the one before it and what that quoted."""
    def before(n: int) -> DataFrame:
        return messages.groupBy("conv_id", (F.col("turn") + n).alias("turn")).agg(F.min("text").alias(f"text{n}"))

    def quoted(text: str, marks: str) -> F.Column:
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))

    joined = messages.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", "role", F.concat_ws(
        "\n", "text", F.when(F.col("text1").isNotNull(), F.lit("On an earlier day somebody wrote:")),
        quoted("text1", "> "), quoted("text2", "> > ")).alias("text"))
