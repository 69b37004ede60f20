"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets share all words among the sources by weight; a source whose share would exceed a
multiple of its own size stops there, and the excess goes to the others by weight. Blocks
of equal size are then allocated to the sources by highest quotients, and each source's
blocks to its shards in the same way. Within a shard the documents stand in a seeded order,
end to end, and the quota is cut from that ring of words at a seeded block.

Nulls: null text has size 0; a null source is a source of its own, ordered last; a null
document id is an id like any other. Documents of size 0 take 0. Equal rows may take
different parts of the quota. Empty tables give no rows. Input columns other than
doc_id, text and source are not read by the plan, and kept in the mix whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creaseline.sources.workspace import settled

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 16
DOCS_PER_SHARD = 2000
MOST_REPEATS = 3
COPIES_AT_ONCE = 10_000


def word_count(text: Column) -> Column:
    """Number of words: each is replaced by one mark, and the marks are counted."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\f\r", "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size, docs, target: one row per source.

    With the sources ordered by limit per weight, those that stop at their limit come
    first. A source is among them if what is left for it and those behind it, per unit
    of their weight, reaches its own limit per weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    limit = (F.col("source_size") * most).cast("double")
    table = sizes.withColumn("weight", weight).withColumn("limit", limit)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    table = table.withColumn("level", left / F.sum("weight").over(onward))
    stops = F.col("limit") <= F.col("level") * F.col("weight")
    all_in_order = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(~stops, F.col("level")), ignorenulls=True).over(all_in_order)  # of the first that does not stop
    target = F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit")))
    return table.select("source", "source_size", "docs", target.alias("target"))


def apportioned(shares: DataFrame, seats: str, key: list[str], group: list[str], limit: str, tie: list[str]) -> DataFrame:
    """Add ``quota``: Sainte-Laguë seats of each row, by column ``share``, at most ``limit``.

    Column ``seats`` says how many a group has to give. With S rows in the group, rounding
    the shares of seats - S/2 gives at most all seats, and of seats + S/2 at least all, so
    only the few quotients between the two are ranked.
    """
    whole = Window.partitionBy(*group)
    share = F.when(F.sum("share").over(whole) > 0, F.col("share") / F.sum("share").over(whole)).otherwise(0.0)
    half = F.count("*").over(whole) / 2.0 + 1.0
    rounded = lambda n: F.floor(F.greatest(n, F.lit(0.0)) * F.col("part") + 0.5)
    low = F.least(rounded(F.col(seats) - F.col("half")), F.col(limit)).cast("long")
    high = F.least(rounded(F.col(seats) + F.col("half")), F.col(limit)).cast("long")
    table = shares.withColumn("part", share).withColumn("half", half).withColumn("low", low).withColumn("high", high)
    open_seats = table.groupBy(*group).agg((F.max(seats) - F.sum("low")).alias("open"))
    several = F.when(F.col("high") > F.col("low"), F.sequence(F.col("low") + 1, F.col("high"))).otherwise(
        F.array().cast("array<bigint>")
    )
    names = dict.fromkeys([*key, *group, *tie])
    quotients = table.select(*names, "share", F.explode(several).alias("nth"))
    rank = Window.partitionBy(*group).orderBy((F.col("share") / (2 * F.col("nth") - 1)).desc(), *tie, "nth")
    won = quotients.withColumn("rank", F.row_number().over(rank))
    won = same(won, open_seats, group).where(F.col("rank") <= F.col("open"))
    won = won.groupBy(*key).agg(F.count("*").alias("won"))
    table = same(table.drop("part", "half", "high"), won, key, "left")
    return table.withColumn("quota", F.col("low") + F.coalesce("won", F.lit(0))).drop("low", "won")


def same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null keys included."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(right, match, how).drop(*(f"_{k}" for k in keys))


def sized_items(docs: DataFrame) -> DataFrame:
    """doc_id, source, _print (of the text), size and the number of equal rows."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("_print"), word_count(F.col("text")).alias("size"))
    return rows.groupBy("doc_id", "source", "_print", "size").agg(F.count("*").alias("copies"))


def mixed(
    docs: DataFrame,
    seed: int = 7,
    weights: tuple[int, ...] = (1, 2, 3),
    block_words: int = BLOCK_WORDS,
    docs_per_shard: int = DOCS_PER_SHARD,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, and the cut of a document's words.

    taken = full_copies * size + the words of [part_start, part_end) + those of
    [0, head_end); the last is not empty only for a document in which the ring's cut
    begins and ends.
    """
    sized = settled(sized_items(docs), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("docs"))
    targets = settled(source_targets(sizes, weights, most_repeats), "mix-targets")

    total = targets.select(F.floor(F.sum("target") / block_words).cast("long").alias("blocks"))
    shares = targets.withColumn("share", F.col("target")).crossJoin(F.broadcast(total))  # one row
    shares = shares.withColumn("limit", F.floor(F.col("target") / block_words + 1).cast("long")).withColumn("all", F.lit(0))
    sources = apportioned(shares, "blocks", ["source"], ["all"], "limit", ["source"])
    sources = settled(sources.select("source", "source_size", "docs", "target", F.col("quota").alias("blocks")), "mix-sources")

    shards_of = F.ceil(F.col("docs") / docs_per_shard)
    shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_print"), shards_of).cast("int")
    placed = same(sized, sources, ["source"]).withColumn("shard", shard)
    shards = placed.groupBy("source", "shard", "blocks").agg(F.sum(F.col("size") * F.col("copies")).alias("share"))
    shards = shards.withColumn("limit", F.floor(F.col("share") * most_repeats / block_words).cast("long"))
    quotas = apportioned(shards, "blocks", ["source", "shard"], ["source"], "limit", ["shard"])
    quotas = settled(quotas.select("source", "shard", "quota", F.col("share").alias("ring")), "mix-quotas")

    words = F.col("quota") * block_words
    turns = F.when(F.col("ring") > 0, F.floor(words / F.col("ring"))).otherwise(0).cast("long")
    first = F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest(F.floor(F.col("ring") / block_words), F.lit(1)))
    quotas = quotas.withColumn("turns", turns).withColumn("cut", first * block_words)
    quotas = quotas.withColumn("rest", words - F.col("turns") * F.col("ring"))
    quotas = quotas.select("source", "shard", "ring", "turns", "cut", "rest")

    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), "_print", "doc_id"), "doc_id", "_print", "size")
    length = F.col("size") * F.col("copies")
    placed = placed.withColumn("end", F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    placed = same(placed, quotas, ["source", "shard"])
    last = F.col("copies") - 1  # copies are made in two steps, so that no list holds them all
    placed = placed.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES_AT_ONCE).cast("long"))))
    placed = placed.withColumn("nth", F.explode(F.sequence("from", F.least(F.col("from") + COPIES_AT_ONCE - 1, last))))
    clip = lambda x: F.least(F.greatest(x - F.col("start"), F.lit(0)), F.col("size"))
    placed = placed.withColumn("start", F.col("end") - length + F.col("nth") * F.col("size"))
    placed = placed.withColumns(
        {
            "part_start": clip(F.col("cut")),
            "part_end": clip(F.col("cut") + F.col("rest")),
            "head_end": clip(F.col("cut") + F.col("rest") - F.col("ring")),
        }
    )
    taken = F.col("turns") * F.col("size") + F.col("part_end") - F.col("part_start") + F.col("head_end")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.col("turns").alias("full_copies"), "part_start", "part_end", "head_end", "_print", "copies",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents as often as they are taken, a part as the words it takes.

    The columns are those of the input; n_chars, where there is one, follows the text.
    """
    key = ["doc_id", "source", "_print"]
    span = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    parts = F.array(span(F.col("part_start"), F.col("part_end")), span(F.lit(0), F.col("head_end")))
    spans = F.concat(
        F.array_repeat(span(F.lit(0), F.col("size")), F.col("full_copies").cast("int")),
        F.filter(parts, lambda p: p["b"] > p["a"]),
    )
    plan = mixed(docs, **options).where("taken > 0").select(*key, "size", "copies", F.explode(spans).alias("_cut"))
    plan = settled(plan, "mix-plan")
    texts = docs.select("doc_id", "source", F.xxhash64("text").alias("_print"), F.struct(*docs.columns).alias("_row"))
    several = plan.where("copies > 1")
    one_each = same(texts, several.select(*key).distinct(), key).dropDuplicates(key)  # equal rows stand for each other
    rows = same(texts, plan.where("copies = 1"), key).unionByName(same(one_each, several, key))
    text = F.col("_row")["text"]
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    piece = F.array_join(F.slice(words, F.col("_cut.a").cast("int") + 1, (F.col("_cut.b") - F.col("_cut.a")).cast("int")), " ")
    is_whole = (F.col("_cut.a") == 0) & (F.col("_cut.b") == F.col("size"))
    rows = rows.select("_row", F.when(is_whole, text).otherwise(piece).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
