"""Operator 1, chat formatting with prefix-target expansion: every assistant
turn becomes an example of its own, with all preceding turns as context and
only that reply trainable.  Built-in functions only.

Template: each turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings
inside roles and texts are escaped reversibly: a backslash becomes ``\\0``, the
opening ``<|`` becomes ``<\\1``, and a line break in a role becomes ``\\2``; no
``<|`` is left inside a text, so the marks can be split on.

A conversation is one example's worth of text and is gathered in one row; its
examples are made one at a time from it.  The expansion is quadratic in the
turns of a conversation, as its definition asks.

Results for odd input: null roles and texts are empty; rows are ordered by
turn (null first), then role and text, so ties and repeated rows have a fixed
order; rows with a null ``conv_id`` are one conversation; only the role
``assistant`` is trainable.  A conversation that does not end with an assistant
turn has one more example, without a trainable reply (``target_turn`` null), so
that every turn is in the output.  Extra columns are left alone; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\1"), F.lit("<|")), F.lit("\\0"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\2"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\2"), F.lit("\n")))


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), target_turn, n_context, formatted, loss_start,
    loss_chars: the loss mask covers ``loss_chars`` code points of ``formatted``
    from ``loss_start`` (0-based), the escaped reply."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("conv_id", F.struct(
        "turn", "role", "text",
        F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    convs = convs.withColumn("segments", F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))))
    # positions (from 1) of the targets, and the last turn if it is none
    at = F.filter(F.sequence(F.lit(1), F.size("ts")),
                  lambda i: (F.element_at("ts", i)["role"] == ROLE) | (i == F.size("ts")))
    each = convs.select("conv_id", "ts", "segments", F.posexplode(at).alias("example", "_i"))
    each = (each.withColumn("_t", F.element_at("ts", F.col("_i")))
            .withColumn("_context", F.array_join(F.slice("segments", F.lit(1), F.col("_i") - 1), "")))
    trained = F.col("_t.role") == ROLE
    return each.select(
        "conv_id", F.col("example").cast("long").alias("example"),
        F.when(trained, F.col("_t.turn")).alias("target_turn"),
        (F.col("_i") - 1).cast("long").alias("n_context"),
        F.concat("_context", F.element_at("segments", F.col("_i"))).alias("formatted"),
        (F.length("_context") + F.length("_t.head")).cast("long").alias("loss_start"),
        F.when(trained, F.length("_t.body")).otherwise(0).cast("long").alias("loss_chars"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda s: s != "")
    return F.transform(parts, lambda s: F.struct(
        unescaped_role(F.substring_index(F.substring(s, F.lit(len(START) + 1), F.length(s)), "\n", 1)).alias("role"),
        unescaped(F.substring(s, F.instr(s, "\n") + 1, F.length(s))).alias("text")))


def replies(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescaped(F.substring(formatted, (loss_start + 1).cast("int"), loss_chars.cast("int")))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: n_turns, turns_sha256
    (role, line break, text, line break of every turn), loss_chars and
    loss_sha256 (all trainable text in order), formatted_chars (of all
    examples), n_examples."""
    each = made.select("conv_id", "example", "formatted",
                       F.length("formatted").alias("_chars"),
                       replies(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("_reply"))
    # the last example holds every turn
    per = each.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted")).alias("_last"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "_reply"))), lambda x: x["_reply"]), "").alias("_loss"),
        F.sum("_chars").cast("long").alias("formatted_chars"), F.count("*").alias("n_examples"))
    per = per.withColumn("_turns", parsed(F.col("_last.formatted")))
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                      F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                      "formatted_chars", "n_examples")
