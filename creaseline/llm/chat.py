"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and
only its own text trainable. Turns after the last assistant turn are kept in one closing
example without trainable text, so that each conversation can be read back whole.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``; a line feed inside a role becomes
``\\n``. Reading back undoes this, whatever the texts say.

Nulls: null role or text is empty; a null turn comes first; a null conversation id is one
conversation. Turns with equal numbers follow by role and text. Repeated rows are turns
of their own. Empty texts give empty masks. Further columns are not read.

An example holds all its context, so the output grows with the square of a conversation's
turns: that is the method. Different conversations are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """Undo ``escaped``: after it, a backslash is always followed by another or by a bar after ``<``."""
    parts = F.split(text, r"\\\\", -1)  # at doubled backslashes, from the left
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    plain = F.transform(
        parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|"))
    )
    return F.array_join(plain, "\\")


def formatted_examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (its number), text, loss_start, loss_end (code points, end exclusive)."""
    empty = lambda name: F.coalesce(F.col(name), F.lit(""))
    turn = F.struct(F.col("turn"), empty("role").alias("role"), empty("text").alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN_START), escaped_role(t["role"]), F.lit("\n"))
    written = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"),
            F.concat(head(t), escaped(t["text"]), F.lit(TURN_END)).alias("full"),
            F.length(head(t)).alias("head"),
        ),
    )
    turns = turns.select("conv_id", written.alias("turns"))
    ends = F.filter(
        F.transform("turns", lambda t, i: F.struct(i.alias("place"), (t["role"] == "assistant").alias("reply"))),
        lambda x: x["reply"] | (x["place"] == F.size("turns") - 1),
    )
    examples = turns.select("conv_id", "turns", F.posexplode(ends).alias("example", "end"))
    last = F.col("turns")[F.col("end.place")]
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("end.place")), lambda t: t["full"]), "")
    start = F.length("context") + F.when(F.col("end.reply"), last["head"]).otherwise(F.length(last["full"]))
    stop = F.length("context") + F.length(last["full"]) - F.when(F.col("end.reply"), len(TURN_END)).otherwise(0)
    return examples.withColumn("context", context).select(
        "conv_id",
        "example",
        F.concat("context", last["full"]).alias("text"),
        start.cast("long").alias("loss_start"),
        stop.cast("long").alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Turns, trained text and formatted length of each conversation, from its examples alone.

    formatted_chars is the length of all of a conversation's examples.
    """
    masked = F.substr("text", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    each = F.struct("example", unescaped(masked).alias("loss"))
    whole = F.max(F.struct(F.col("example"), F.col("text"))).getField("text")
    joined = examples.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(each)).alias("losses"),
        whole.alias("whole"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    pieces = F.split("whole", r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # nothing follows the last mark
    body = lambda p: F.substr(p, F.lit(len(TURN_START) + 1))
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescaped_role(F.substring_index(body(p), "\n", 1)).alias("role"),
            unescaped(F.substr(body(p), F.locate("\n", body(p)) + 1)).alias("text"),
        ),
    )
    return joined.select(
        "conv_id", turns.alias("turns"), F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), "formatted_chars"
    )


def conversation_digests(examples: DataFrame) -> DataFrame:
    """One row per conversation: what its examples say, as counts and digests."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_back(examples).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
