"""Trie of conversation prefixes, by truncation peeling.

A node is a distinct sequence of first turns (role and text). Nodes are found from the
greatest depth up: the nodes of a depth are the conversations that end there, merged with
the nodes one deeper that have lost their last turn. One grouping merges and aggregates
both, so each node is complete when it is found, and nothing is looked at twice.

A round takes a stretch of depths. Rows that share their prefix at the stretch's floor with no
other row have nothing to merge with, so their nodes follow at once, all the way down to the
floor; for the others the stretch is halved, down to single depths, where the last turn is
stripped and the rows are regrouped. Rounds are therefore needed where prefixes part, not for
every turn of a long conversation. Each round is stored; a lost executor costs its part of one.

Turns are digests of 128 bits and word counts, texts are not carried. A conversation's
keys, one per depth, are digests of the key before and the turn; equal conversations become
one row before the first round.

Regrouping is by key. Sums and least ids are combined before
the shuffle, so a first turn that a third of all conversations share is one row per task.
The ids that end at a node are joined in numbered ranges of 10,000 first. A conversation's
digests and keys are gathered into one row: some 40 bytes a turn and 16 bytes a depth, which
bounds the length of one conversation (some ten million turns), not their number.

Nulls: null role and text are empty, a null turn comes first, a null conv_id is one
conversation. Turns with equal numbers follow by role, then by digest. Repeated rows are
turns of their own. A conversation without turns ends at the root. Without conversations
there are no nodes. Columns that are not named here are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.sources.workspace import settled

WORD = r"[^\x20\x09-\x0D]+"
IDS_PER_RANGE = 10_000
TURN = "struct<digest:binary,words:bigint>"


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the digests and word counts of each conversation's turns, in order."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    said = F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))
    turn = F.struct(
        F.col("turn"),
        text("role").alias("role"),
        F.unhex(F.md5(said.cast("binary"))).alias("digest"),
        F.regexp_count(text("text"), F.lit(WORD)).cast("long").alias("words"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    short = F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return turns.select("conv_id", short.cast(f"array<{TURN}>").alias("turns"))


def with_shared_heads(turns: DataFrame, every: int = 20, longest: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the last conversation before with a round number.

    Of conversation c the first h turns are replaced, h being the unsigned checksum of c in
    decimal form modulo ``longest``, by those of conversation c - c % every: all it has if
    fewer, none if it is absent. A null id keeps its turns.
    """
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest, F.lit(0)).cast("int")
    heads = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, longest - 1).alias("head")
    )
    own = turns.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    both = own.join(heads, "base", "left")
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.array().cast(f"array<{TURN}>")), F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    kept = F.coalesce(head, F.array().cast(f"array<{TURN}>"))
    return both.select("conv_id", F.concat(kept, rest).alias("turns"))


def _joined_ids(ids: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(ids), lambda x: x.cast("string")), ",")


def endings(turns: DataFrame) -> DataFrame:
    """One row per distinct conversation: depth, keys (of depths 0 to depth), words, conv_id (least), n_convs, ends.

    ``ends`` are the ids of all equal conversations, ascending, comma-joined; a null id is
    counted, but has no decimal form to list.
    """
    root = F.unhex(F.md5(F.lit("").cast("binary")))
    keys = F.aggregate(
        "turns",
        F.array(root),
        lambda done, turn: F.concat(done, F.array(F.unhex(F.md5(F.concat(F.element_at(done, -1), turn["digest"]))))),
    )
    ended = turns.select("conv_id", keys.alias("keys"), F.transform("turns", lambda t: t["words"]).alias("words"))
    ended = ended.withColumn("key", F.element_at("keys", -1))
    ranges = ended.groupBy("key", "keys", "words", (F.col("conv_id") - F.pmod("conv_id", F.lit(IDS_PER_RANGE))).alias("range")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), _joined_ids(F.collect_list("conv_id")).alias("ids")
    )
    part = F.sort_array(F.collect_list(F.struct("range", "ids")))
    whole = ranges.groupBy("key", "keys", "words").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.array_join(F.transform(F.filter(part, lambda p: p["range"].isNotNull()), lambda p: p["ids"]), ",").alias("ends"),
    )
    return whole.withColumn("depth", F.size("words"))


def _ending_rows(ended: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return ended.select(
        "keys", "words", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"),
        F.sha2(F.col("ends").cast("binary"), 256).alias("ends_sha256"),
    )


def _stripped(nodes: DataFrame, depth: Column) -> DataFrame:
    """Nodes one deeper than ``depth``, less their last turn."""
    return nodes.select(
        F.slice("keys", F.lit(1), depth + 1).alias("keys"), F.slice("words", F.lit(1), depth).alias("words"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("n_children"), "n_leaves", F.col("saved_tokens").alias("saved"),
        F.lit(None).cast("string").alias("ends_sha256"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """The nodes of one depth: the rows of that depth by key."""
    merged = rows.groupBy("keys", "words").agg(
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    last = F.when(F.size("words") > 0, F.element_at("words", -1)).otherwise(0)
    return merged.select(
        "keys", "words", "conv_id", "n_convs", "n_children", F.greatest(F.col("n_leaves"), F.lit(1)).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * last).alias("saved_tokens"), "ends_sha256",
    )


def _chain(alone: DataFrame, floor: int) -> DataFrame:
    """The nodes above ``floor`` of rows that meet no other row there: nothing merges on the way."""
    steps = alone.withColumn("depth", F.size("words")).withColumn("at", F.explode(F.sequence(F.col("depth"), F.lit(floor + 1))))
    top = F.col("at") == F.col("depth")
    words = F.aggregate(F.slice("words", F.col("at"), F.col("depth") - F.col("at") + 1), F.lit(0).cast("long"), lambda a, w: a + w)
    return steps.select(
        F.slice("keys", F.lit(1), F.col("at") + 1).alias("keys"), F.slice("words", F.lit(1), F.col("at")).alias("words"), "conv_id", "n_convs",
        F.when(top, F.col("n_children")).otherwise(1).alias("n_children"), F.greatest(F.col("n_leaves"), F.lit(1)).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * words).alias("saved_tokens"), F.when(top, F.col("ends_sha256")).alias("ends_sha256"),
    )


def _peeled(rows: DataFrame, top: int, floor: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of depths floor + 1 to ``top``, and these stripped to the depth ``floor``."""
    if top - floor == 1:
        nodes = settled(_merged(rows), "trie-nodes")
        return [nodes], _stripped(nodes, F.lit(floor))
    if floor > 0:
        rows = rows.withColumn("floor", F.element_at("keys", floor + 1))
        shared = rows.groupBy("floor").count().where("count > 1").select("floor", F.lit(True).alias("shared"))
        rows = settled(rows.join(shared, "floor", "left").drop("floor"), "trie-rows")
        nodes = _chain(rows.where("shared IS NULL").drop("shared"), floor)
        found, left = [nodes], _stripped(nodes.where(F.size("words") == floor + 1), F.lit(floor))
        rows = rows.where("shared").drop("shared")
        top = rows.agg(F.max(F.size("words"))).first()[0]
        if top is None:
            return found, left
    else:
        found, left = [], rows.limit(0)
    middle = max((top + floor) // 2, floor)
    if middle > floor:
        upper, stripped = _peeled(rows.where(F.size("words") > middle), top, middle)
        lower, rest = _peeled(rows.where(F.size("words") <= middle).union(stripped), middle, floor)
        return found + upper + lower, left.union(rest)
    nodes, rest = _peeled(rows, top, floor)
    return found + nodes, left.union(rest)


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """depth, key, parent_key, conv_id (least member), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id and turns, as ``conversation_turns`` gives them, one row per
    conversation. ends_sha256 is null where no conversation ends.
    """
    ended = settled(endings(turns), "trie-endings")
    top = ended.agg(F.max("depth")).first()[0] or 0
    rows, found = _ending_rows(ended), []
    if top > 0:
        found, stripped = _peeled(rows.where(F.size("words") > 0), top, 0)
        rows = rows.where(F.size("words") == 0).union(stripped)
    return reduce(DataFrame.union, found, _merged(rows)).select(
        F.size("words").alias("depth"),
        F.element_at("keys", -1).alias("key"),
        F.when(F.size("words") > 0, F.element_at("keys", -2)).alias("parent_key"),
        "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def trie_table(turns: DataFrame) -> DataFrame:
    """The nodes with parent_conv_id, the least member of the parent, in place of keys."""
    nodes = settled(prefix_nodes(turns), "trie-nodes")
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent_key", "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
