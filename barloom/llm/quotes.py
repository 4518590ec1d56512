"""Conversations without quotations, in the order of their replies.

Lines that begin with `>` marks are quoted; the number of marks is the level. Neighbouring
lines of one level make a passage, up to an empty line. Passages and their single lines
are normalised (lower case, words of letters and digits) and hashed. A quoted one is joined
to the earliest message of the conversation that has it as its own words, if that message
came before. The message answers the latest one that its lowest quote level is linked to.
Answers form threads, whose roots are found by doubling the way up in every step.

All of it is DataFrame expressions; nothing runs in Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, numbered

MARKS = r"^[ \t]*(?:>[ \t]*)+"
# The line that mail programs put before a quotation.
INTRODUCES = r"(?i)^[ \t]*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|a écrit|escribió)\b.*:[ \t]*$"
BREAK = "\x01"


def level(line: Column) -> Column:
    """How many quotation marks a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"[^>]", ""))


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame, text_col: str) -> DataFrame:
    """Every row with `own`, its unquoted text, and `passages`: (level, text) of each passage and line."""
    lines = messages.withColumn("ls", F.split(F.translate(F.col(text_col), BREAK, " "), "\n"))
    lines = lines.withColumn("lv", F.transform("ls", level))

    def marked(line: Column, i: Column) -> Column:
        before = F.get("ls", i - 1)
        new = before.isNull() | (F.get("lv", i - 1) != F.get("lv", i)) | (F.trim(line) == "") | (F.trim(before) == "")
        return F.concat(F.when(new, F.lit(BREAK)).otherwise(F.lit("\n")), line)

    runs = F.split(F.array_join(F.transform("ls", marked), ""), BREAK)

    def in_run(run: Column) -> Column:
        bare = F.regexp_replace(run, "(?m)" + MARKS, "")
        parts = F.array_union(F.array(normal(bare)), F.transform(F.split(bare, "\n"), normal))
        depth = level(run)
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(depth.alias("level"), p.alias("text")))

    def is_own(line: Column, i: Column) -> Column:
        introduces = (F.coalesce(F.get("lv", i + 1), F.lit(0)) > 0) & line.rlike(INTRODUCES)
        return (F.get("lv", i) == 0) & ~introduces

    return lines.withColumns(
        {"own": F.array_join(F.filter("ls", is_own), "\n"), "passages": F.flatten(F.transform(runs, in_run))}
    ).drop("ls", "lv")


def reply_links(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, parent) of messages that quote an earlier one; needs conv, turn, passages."""
    found = messages.where("conv is not null and turn is not null").select(
        "conv", "turn", F.explode("passages").alias("p")
    )
    found = found.select("conv", "turn", "p.level", F.xxhash64("p.text").alias("h"))
    found = scratch.keep(found, "passages")
    first = found.where("level = 0").groupBy("conv", "h").agg(F.min("turn").alias("origin"))
    linked = found.where("level > 0").join(first, ["conv", "h"]).where("origin < turn")
    nearest = F.max(F.struct((-F.col("level")).alias("l"), F.col("origin").alias("o")))
    return linked.groupBy("conv", "turn").agg(nearest.alias("best")).select("conv", "turn", F.col("best.o").alias("parent"))


def roots_of(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, parent, root, steps) of every linked message, by doubling."""
    now = scratch.keep(links.withColumns({"root": F.col("parent"), "steps": F.lit(1)}), "way")
    while True:
        above = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("further"), F.col("steps").alias("more"))
        joined = now.join(above, ["conv", "root"], "left")
        climbed = joined.select(
            "conv", "turn", "parent", F.coalesce("further", "root").alias("root"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNotNull().alias("moved"),
        )
        before, now = now, scratch.keep(climbed, "way")
        scratch.drop(before)
        done = now.where("moved").isEmpty()
        now_path, now = now.scratch_path, now.drop("moved")
        now.scratch_path = now_path
        if done:
            return now


def threaded(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, turn, role, text, parent_turn, root_turn, reply_depth, seq) of every row.

    `text` is the message without quoted lines and the lines that introduce them. A message
    that quotes nothing known answers nothing and is its own root. `seq` numbers the rows of
    a conversation from 0: threads by the turn of their root, within a thread by turn, so an
    answer always follows what it answers. A null text stays null and quotes nothing. Rows
    without a conversation or turn are linked with nothing; nulls come first and are a
    conversation of their own. Rows that repeat a conversation and turn are one message
    when others link to it, and each stays; they are ordered by role and text. Other
    columns are not looked at; an empty table gives no rows.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    known = parsed(rows, "text")
    links = roots_of(reply_links(known, scratch), scratch)
    links = links.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "parent", "root", "steps")
    joined = known.select("conv", "turn", "role", F.col("own").alias("text")).join(
        links, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left"
    )
    joined = joined.select(
        "conv", "turn", "role", "text", F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"), F.coalesce("steps", F.lit(0)).cast("bigint").alias("reply_depth"),
    )
    order = [F.col(c) for c in ("conv", "root_turn", "turn", "role")] + [F.xxhash64("text")]
    placed = numbered(joined, order, scratch, "place")
    first = placed.groupBy("conv").agg(F.min("place").alias("first")).withColumnRenamed("conv", "c")
    return placed.join(first, F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
        F.col("text").alias(text_col), "parent_turn", "root_turn", "reply_depth", (F.col("place") - F.col("first")).alias("seq"),
    )
