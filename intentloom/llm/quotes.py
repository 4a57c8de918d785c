"""Quotation linking of messages, in DataFrame operations only.

A line's quote level is the number of its leading ``>`` marks. For each level a message's lines of
that level form passages (blank lines and lines of other levels part them); passages are compared
lower-cased and with single spaces, by hash. A quoted passage links to the latest earlier
message of its conversation that has it among its own passages, else to the first message of any
other conversation that has it. The message that most passages of the lowest quoted level link to
is the one replied to. Where no passage of that level links, its parts vote: the lines of passages of
several lines, and sentences, also those broken over lines. Own passages are hashed in the same parts, so a quoted
line or sentence of a longer passage finds it. Messages then come in reply order: each thread by its
root, in it by depth and turn, with the quotes taken out.

Own hashes that nobody quotes go first. Links are found by windows over (conversation, hash) and by the least message of the two smallest
conversations of each hash that has no link within its own, so a passage that everybody quotes makes no
pairs. Null texts count as empty. A null conversation or turn is replied to by nobody; a null turn sorts
first. Repeated rows of one (conversation, turn) stay, with one and the same link. Ties go to
the latest turn, then the smallest conversation. Other columns are unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm.runtime import stored

QUOTE = r"^(?:[ \t]*>)+[ \t]?"
KEY = ["conv_id", "turn"]


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, QUOTE, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def own_text(text: Column) -> Column:
    """A text without its quoted lines."""
    return F.btrim(F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~F.rlike(x, F.lit(QUOTE))), "\n"), F.lit(" \t\r\n"))


def _plain(part: Column) -> Column:
    return F.btrim(F.lower(F.regexp_replace(part, r"[\x20\x09-\x0D]+", " ")))


def _pieces(part: Column, plain: Column) -> Column:
    """(text, whole) of a passage, then of its lines and of the sentences in these and across them, if less than all."""
    end = r"(?<=[.!?;:]) "
    lines = F.when(F.contains(part, F.lit("\n")), F.transform(F.split(part, "\n"), _plain)).otherwise(F.array().cast("array<string>"))
    parts = F.concat(lines, F.flatten(F.transform(lines, lambda x: F.split(x, end))), F.split(plain, end))
    return F.concat(
        F.array(F.struct(plain.alias("text"), F.lit(True).alias("whole"))),
        F.transform(F.array_except(parts, F.array(plain)), lambda x: F.struct(x.alias("text"), F.lit(False).alias("whole"))),
    )


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, whole, a, b): hashes of every passage and its parts; level 0 holds a message's own."""
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, QUOTE, "").alias("body"))
    )
    parsed = messages.select(*KEY, lines.alias("lines"))
    levels = parsed.select(*KEY, "lines", F.explode(F.array_distinct(F.transform("lines", lambda x: x["level"]))).alias("level"))
    level = F.col("level")
    body = F.array_join(F.transform("lines", lambda x: F.when(x["level"] == level, x["body"]).otherwise("")), "\n")
    parts = levels.select(*KEY, "level", F.explode(F.split(body, r"\n[ \t\r]*\n")).alias("part"))
    pieces = parts.select(*KEY, "level", "part", _plain(F.col("part")).alias("plain")).where("plain <> ''")
    pieces = pieces.select(*KEY, "level", F.explode(_pieces(F.col("part"), F.col("plain"))).alias("piece")).where("piece.text <> ''")
    return pieces.select(*KEY, "level", "piece.whole", F.xxhash64("piece.text").alias("a"), F.hash("piece.text").alias("b"))


def links(found: DataFrame) -> DataFrame:
    """(conv_id, turn, to_conv, to_turn) of each message with a quote that has an original."""
    here = W.partitionBy("conv_id", "a", "b").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    before = F.max(F.when((F.col("level") == 0) & F.col("conv_id").isNotNull(), F.col("turn"))).over(here)
    local = found.withColumn("to_turn", before).where("level > 0").distinct()
    lost = local.where("to_turn is null")
    own = found.where("level = 0 and conv_id is not null and turn is not null").join(lost.select("a", "b").distinct(), ["a", "b"], "left_semi")
    least = own.groupBy("a", "b", "conv_id").agg(F.min("turn").alias("turn"))
    least = least.withColumn("n", F.row_number().over(W.partitionBy("a", "b").orderBy("conv_id"))).where("n <= 2")
    message = F.struct("conv_id", "turn")
    least = least.groupBy("a", "b").agg(F.min(message).alias("first"), F.max(message).alias("second"))  # one and the same if there is one
    other = F.when(F.col("conv_id").eqNullSafe(F.col("first.conv_id")), F.col("second")).otherwise(F.col("first"))
    wide = lost.join(least, ["a", "b"]).withColumn("other", other).where("not (other.conv_id <=> conv_id)")
    both = local.where("to_turn is not null").select(*KEY, "level", "whole", F.col("conv_id").alias("to_conv"), "to_turn").union(
        wide.select(*KEY, "level", "whole", F.col("other.conv_id").alias("to_conv"), F.col("other.turn").alias("to_turn"))
    )
    votes = both.groupBy(*KEY, "level", "to_conv", "to_turn").agg(F.count_if("whole").alias("wholes"), F.count("*").alias("all"))
    rank = F.struct(
        -F.col("level"), F.col("wholes"), F.when(F.col("wholes") == 0, F.col("all")).otherwise(0),
        F.col("to_conv").eqNullSafe(F.col("conv_id")).cast("int"), F.col("to_turn"), -F.col("to_conv"),
    )
    return votes.groupBy(*KEY).agg(F.max_by(F.struct("to_conv", "to_turn"), rank).alias("to")).select(*KEY, "to.to_conv", "to.to_turn")


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of messages that reply within their conversation, by pointer jumping."""
    up = stored(
        replies.where("to_conv = conv_id").select(*KEY, F.col("to_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")), "threads"
    )
    while True:
        step = up.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root_turn").alias("r"), F.col("depth").alias("d"))
        joined = up.join(step, (F.col("conv_id") == F.col("c")) & (F.col("root_turn") == F.col("t")), "left")
        if joined.where("c is not null").isEmpty():
            return up
        up = stored(joined.select(*KEY, F.coalesce("r", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth")), "threads")


def link_quotes(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, root_turn, depth, turn, role, reply_to_conv, reply_to_turn, n_quoted, text): sorted by the first four, reply order."""
    messages = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    quoted = F.rlike(F.coalesce("text", F.lit("")), F.lit("(?m)" + QUOTE))
    quotes = stored(passages(messages.where(quoted)).where("level > 0"), "quotes")
    own = passages(messages).where("level = 0").join(quotes.select("a", "b").distinct(), ["a", "b"], "left_semi")
    found = stored(quotes.unionByName(own), "passages")
    replies = stored(links(found), "replies")
    at = threads(replies).select(F.struct(*KEY, "root_turn", "depth").alias("h"))
    to = replies.select(F.struct("*").alias("r"))
    same = lambda k: F.col("conv_id").eqNullSafe(F.col(f"{k}.conv_id")) & F.col("turn").eqNullSafe(F.col(f"{k}.turn"))
    quoted = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(QUOTE))))
    return messages.join(to, same("r"), "left").join(at, same("h"), "left").select(
        "conv_id", F.coalesce("h.root_turn", "turn").alias("root_turn"), F.coalesce("h.depth", F.lit(0).cast("long")).alias("depth"), "turn", "role",
        F.col("r.to_conv").alias("reply_to_conv"), F.col("r.to_turn").alias("reply_to_turn"), quoted.cast("long").alias("n_quoted"), own_text(F.col("text")).alias("text"),
    )
