"""Sharding by jump consistent hashing.

A stable key and the number of shards decide a row's shard; no ring table is kept.
Appending one shard moves only the rows that go into it. Rows of a shard get gapless
slots, numbered within small buckets first and then shifted by the buckets' counts, so
that no task sorts a whole shard. Rows that are equal in all that is ordered by, and more
than a bucket holds, are spread over the buckets by a stored number; such rows stand for
each other.

Nulls: a null key is a key of its own. Null text has size 1 and the checksum of the
empty text. Repeated rows keep one slot each. An empty table gives no rows. Columns of
the input that have the name of a new column are replaced, all others are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.llm.mixing import same
from creaseline.sources.workspace import settled

# Multiplier of the generator and the draw's width, as published by Lamping and Veach.
MULTIPLIER = 2862933555777941757
DRAW = 1 << 31
ROWS_PER_BUCKET = 2000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, for all keys at once."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = target[moving]
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        target[moving] = ((shard[moving] + 1) * (DRAW / draw)).astype(np.int64)
        moving = moving[target[moving] < shards]
    return shard


def jump_udf(shards: int):
    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(jump(key.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return shard_of


def with_shards(df: DataFrame, key: str, shards: int, column: str = "shard") -> DataFrame:
    """Add the shard of each row; rows with equal keys share one."""
    return df.withColumn(column, jump_udf(shards)(F.xxhash64(F.col(key))))


def with_slots(df: DataFrame, shard: str, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in a repeatable order.

    The order columns also choose the bucket, so that rows that differ in any of them
    spread out, whatever the shard.
    """
    names = [f"_key{k}" for k in range(len(order) + 1)]
    table = df.select(F.struct(*df.columns).alias("_row"), *(F.col(c).alias(n) for c, n in zip([shard, *order], names)))
    groups = settled(table.groupBy(*names).agg(F.count("*").alias("_rows")), "shard-groups")
    rows = groups.groupBy("_key0").agg(F.sum("_rows").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = -(-rows // rows_per_bucket) or 1
    bucket = lambda *more: F.pmod(F.xxhash64(*names[1:], *more), F.lit(buckets)).cast("int").alias("_bucket")
    large = settled(groups.where(F.col("_rows") > rows_per_bucket).select(*names), "shard-large-groups")
    few = same(table, large, names, "left_anti").select("*", bucket())
    many = same(table, large, names, "left_semi").withColumn("_number", F.monotonically_increasing_id())
    many = settled(many, "shard-many").select("_row", *names, bucket("_number"))
    counts = same(groups, large, names, "left_anti").select("_key0", bucket(), "_rows")
    counts = counts.union(many.select("_key0", "_bucket", F.lit(1).cast("long")))
    counts = counts.groupBy("_key0", "_bucket").agg(F.sum("_rows").alias("_rows"))
    before = Window.partitionBy("_key0").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_key0", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_key0", "_bucket").orderBy(*names[1:])
    numbered = few.unionByName(many).withColumn("_place", F.row_number().over(within) - 1)
    slot = (F.col("_start") + F.col("_place")).cast("long").alias("slot")
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c != "slot"]
    return same(numbered, starts, ["_key0", "_bucket"]).select(*kept, slot)


def measured(docs: DataFrame) -> DataFrame:
    """Add size (UTF-8 bytes and one) and text_crc32 (unsigned) of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary")).cast("long")}
    )


def shard_documents(docs: DataFrame, shards: int = 16, payload: list[str] | None = None) -> DataFrame:
    """Documents with size, text_crc32, law, shard, slot and grown_shard (one more shard).

    ``payload`` names the input columns to keep; all by default.
    """
    kept = docs.columns if payload is None else payload
    kept = [c for c in kept if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    table = measured(docs).select(*kept, "size", "text_crc32")
    table = with_shards(table, "doc_id", shards)
    table = with_shards(table, "doc_id", shards + 1, "grown_shard")
    return with_slots(table, "shard", ["doc_id", "size", "text_crc32"]).withColumn("law", F.lit("key"))
