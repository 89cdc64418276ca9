"""Conversations as training texts with a loss mask, formatted and read back by Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template: a block is START role \n text (SEP text)* END \n. Nothing else holds "<|".
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """One backslash more between "<" and "|": no control string is left, and unescaped() takes it out again."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def safe_role(role: Column) -> Column:
    """escaped(), and line ends as "<|n|>", which no escaped text holds: a line end closes the role."""
    return F.replace(escaped(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("<|n|>"))


def joined(parts: Column, sep: str = "") -> Column:
    return F.array_join(parts, sep)


def chat_format(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation of turns (conv_id, turn, role, text): conv_id, n_blocks, segments.

    segments is an array of (text, loss): its texts joined are the formatted conversation (see formatted()), and loss
    marks what a model is trained on, the texts of loss_role without marks around them. Turns are sorted; adjacent turns
    of one role merge into one block, in which SEP keeps their texts apart, so that the turns can be read back.

    Null texts and roles count as empty; "<|" inside either is escaped, and so is a line end inside a role. Rows without turn come first; rows that repeat a turn follow one another by role and
    text, equal ones each. Rows without conv_id make one conversation. An empty table gives an empty result. Other
    columns are not read, so their names cannot clash. A conversation is one row, whatever its length: each step is one
    pass over its turns, and no text is copied more than once per step.
    """
    rows = turns.select("conv_id", F.struct("turn", safe_role(F.col("role")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("x"))
    got = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("turns"))
    last = F.size("turns") - 1
    role_at = lambda i: F.get("turns", i)["role"]
    first = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    got = got.withColumn("first", first)
    until = lambda j: F.coalesce(F.get("first", j + 1), F.size("turns"))
    blocks = F.transform("first", lambda i, j: F.struct(role_at(i).alias("role"), F.transform(F.slice("turns", i + 1, until(j) - i), lambda t: escaped(t["text"])).alias("texts")))
    got = got.select("conv_id", blocks.alias("blocks"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(b: Column) -> Column:
        trained = b["role"] == safe_role(F.lit(loss_role))
        opening = segment(F.concat(F.lit(START), b["role"], F.lit("\n")), F.lit(False))
        apart = segment(F.lit(SEP), F.lit(False))
        texts = F.flatten(F.transform(b["texts"], lambda t, i: F.when(i == 0, F.array(segment(t, trained))).otherwise(F.array(apart, segment(t, trained)))))
        return F.concat(F.array(opening), texts, F.array(segment(F.lit(END + "\n"), F.lit(False))))

    return got.select("conv_id", F.size("blocks").cast("long").alias("n_blocks"), F.flatten(F.transform("blocks", of_block)).alias("segments"))


def formatted(segments: Column) -> Column:
    """The whole formatted conversation."""
    return joined(F.transform(segments, lambda s: s["text"]))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return joined(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])))


def turns_of(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation: the inverse of the template."""

    def of_block(b: Column) -> Column:
        cut = F.locate("\n", b)
        role = unescaped(F.replace(F.substring(b, F.lit(len(START) + 1), cut - F.lit(len(START) + 1)), F.lit("<|n|>"), F.lit("\n")))
        return F.transform(F.split(F.substring(b, cut + F.lit(1), F.length(b)), r"<\|im_sep\|>", -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    blocks = F.split(text, r"<\|im_end\|>\n", -1)
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), of_block))


def chat_report(turns: DataFrame) -> DataFrame:
    """chat_format() and what its output holds, read back from it: conv_id, n_turns, turns_sha256 (of role, \\n, text, \\n
    per turn), loss_chars and loss_sha256 (of the text under the mask), formatted_chars, n_blocks."""
    out = chat_format(turns).select("conv_id", "n_blocks", formatted(F.col("segments")).alias("text"), loss_text(F.col("segments")).alias("loss"))
    out = out.withColumn("turns", turns_of(F.col("text")))
    said = joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
        "n_blocks",
    )
