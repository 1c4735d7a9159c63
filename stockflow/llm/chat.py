"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only that reply is trainable. A turn is written as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

and control strings inside texts are escaped reversibly: ``<|`` becomes ``<\\|``, ``<\\|``
becomes ``<\\\\|`` and so on, one backslash more each. In a role, a backslash becomes
``\\b`` and a line feed ``\\n`` first, so that the first line feed ends the role.

Since each example is a prefix of the conversation, it is kept as the conversation's text
once, with the ends of the examples: storage grows with the conversation, not with its
square. ``expand`` makes the example texts from it.

Defined cases: turns are ordered by turn (NULL first), role, text; NULL role and text are
empty; rows with a NULL conv_id form one conversation. Turns after the last assistant turn
would be in no example, so such a conversation gets one more, with nothing trainable.
A conversation is one value (one string), so its turns are gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import has_columns

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, ``formatted`` (its whole text) and ``examples``,
    an array of (turn_index, length, loss_start, loss_length): an example is the first
    ``length`` code points, of which ``loss_length`` from ``loss_start`` on are trainable.
    """
    rows = has_columns(turns, "conv_id", "turn", "role", "text").select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("t"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == TRAINED_ROLE).alias("trained"),
        ),
    )
    lengths = F.transform(
        "pieces", lambda p: F.length(p["head"]) + F.length(p["body"]) + F.lit(len(END))
    )
    # where each turn ends: running sums, made in one pass
    ends = F.aggregate(
        "lengths",
        F.array().cast("array<int>"),
        lambda sums, n: F.concat(sums, F.array(F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0)) + n)),
    )
    marked = F.transform(
        F.arrays_zip("pieces", "ends"),
        lambda z, i: F.struct(
            i.alias("turn_index"),
            z["ends"].alias("length"),
            (z["ends"] - F.lit(len(END)) - F.length(z["pieces"]["body"])).alias("loss_start"),
            F.when(z["pieces"]["trained"], F.length(z["pieces"]["body"])).otherwise(0).alias("loss_length"),
            z["pieces"]["trained"].alias("trained"),
        ),
    )
    # the last turn always ends an example, so every turn is in one
    kept = F.filter("marked", lambda m, i: m["trained"] | (i == F.size("marked") - 1))
    return (
        whole.withColumn("pieces", pieces)
        .withColumn("lengths", lengths)
        .withColumn("ends", ends)
        .withColumn("marked", marked)
        .select(
            "conv_id",
            F.array_join(
                F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
            ).alias("formatted"),
            kept.alias("examples"),
        )
    )


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, turn_index, text, loss_start, loss_length."""
    one = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    return one.select(
        "conv_id",
        F.col("e.turn_index").alias("turn_index"),
        F.substring("formatted", F.lit(1), F.col("e.length")).alias("text"),
        F.col("e.loss_start").alias("loss_start"),
        F.col("e.loss_length").alias("loss_length"),
    )


def read_turns(text: Column) -> Column:
    """The turns of an example's text: an array of (role, text), as they were."""
    parts = F.filter(F.split(text, r"<\|im_start\|>"), lambda part: part != "")
    return F.transform(
        parts,
        lambda part: F.struct(
            unescaped_role(F.substring_index(part, "\n", 1)).alias("role"),
            unescaped(
                F.substring(
                    part,
                    F.instr(part, F.lit("\n")) + 1,
                    F.length(part) - F.instr(part, F.lit("\n")) - F.lit(len(END)),
                )
            ).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """What the examples hold, read back from their texts: one row per conversation.

    The longest example holds all turns. The parts under the loss masks are joined in
    order of the examples.
    """
    masked = F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_length"))
    per_conversation = examples.withColumn("masked", masked).groupBy("conv_id").agg(
        F.max_by("text", "turn_index").alias("whole"),
        F.sort_array(F.collect_list(F.struct("turn_index", "masked"))).alias("parts"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    trained = F.array_join(F.transform("parts", lambda p: unescaped(p["masked"])), "")
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return per_conversation.withColumn("turns", read_turns(F.col("whole"))).withColumn("trained", trained).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
