"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles. Items are partitioned by size, each
partition up to twice as large as the one before. For a partition with at most u shingles,
a document is seen through windows of 2u shingles that begin every u, so that a passage
of that size lies whole in a window, however long the document. Items and windows have
MinHash signatures; a window that shares a minimum with an item of the partition makes the
document a candidate. With containment of 0.75, item and window have a Jaccard similarity
of at least 0.17, of which 64 minima miss one in 150,000. Candidates are verified: the
item's shingles that are found in the whole document, counted exactly, must reach 0.75.

Items are searched for in blocks of limited size, one scan of the documents each.

Nulls and texts without words have no shingles and match nothing. A text with fewer than
five words is one shingle. A null id is carried along. Repeated rows of either table give
repeated matches. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.words import WordHashes, mixed_bits, shingle_set, shingles_in_order, word_hashes
from creaseline.sources.workspace import settled

HASHES = 64
SLICE = 1 << 14  # shingles that are hashed at once
FILTER_BITS = 18
FILTER_MASK = np.uint32((1 << FILTER_BITS) - 1)  # the low bits, since minima have low high bits
BLOCK_BYTES = 8_000_000  # of item texts per scan, and so of the broadcast
MULTIPLIERS = (mixed_bits(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def hashed(shingles: np.ndarray) -> np.ndarray:
    """All hash values of each shingle, in 32 bits; what these confuse is told apart by the verification."""
    return (shingles >> np.uint64(32)).astype(np.uint32)[:, None] * MULTIPLIERS


class Partition:
    """Items of one size class, found by the minima of their signatures."""

    def __init__(self, items: list[int], shingles: list[np.ndarray]):
        minima = np.concatenate([hashed(shingles[i]).min(axis=0) for i in items])
        order = np.argsort(minima)
        self.minima = minima[order]
        self.items = np.repeat(items, HASHES)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.minima & FILTER_MASK] = True

    def candidates(self, minima: np.ndarray) -> set[int]:
        found = minima[self.filter[minima & FILTER_MASK]]
        low, high = np.searchsorted(self.minima, found, "left"), np.searchsorted(self.minima, found, "right")
        return {int(i) for a, b in zip(low, high) for i in self.items[a:b]}


class Items:
    """The items of one block by size class; the key is the binary logarithm of its limit."""

    def __init__(self, ids: list, texts: list):
        seen = WordHashes()
        self.shingles = [shingle_set(t, seen) for t in texts]
        self.ids = ids
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(self.shingles):
            if len(s):
                by_size.setdefault((len(s) - 1).bit_length(), []).append(i)
        self.partitions = {size: Partition(items, self.shingles) for size, items in sorted(by_size.items())}

    def candidates(self, ordered: np.ndarray) -> set[int]:
        """Items whose partition has a window with a common minimum."""
        found: set[int] = set()
        if not len(ordered) or not self.partitions:
            return found
        smallest = next(iter(self.partitions))
        width = 1 << smallest
        step = max(width, SLICE // width * width)
        ordered = np.pad(ordered, (0, -len(ordered) % width), "edge")  # whole blocks, with the same minima
        blocks = [hashed(ordered[at : at + step]).reshape(-1, width, HASHES).min(axis=1) for at in range(0, len(ordered), step)]
        minima, size = np.concatenate(blocks), smallest
        for wanted, partition in self.partitions.items():
            while size < wanted:
                even = minima[::2]
                even[: len(minima) // 2] = np.minimum(even[: len(minima) // 2], minima[1::2])
                minima, size = even, size + 1
            windows = np.minimum(minima[:-1], minima[1:]) if len(minima) > 1 else minima
            found |= partition.candidates(windows.ravel())
        return found


def search(shared, share: tuple[int, int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seen = Items(*shared.value), WordHashes()
        schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("item_shingles", pa.int64()), ("shared_shingles", pa.int64())])
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ordered = shingles_in_order(word_hashes(text.as_py(), seen))
                candidates = sorted(items.candidates(ordered))
                whole = np.unique(ordered) if candidates else ordered
                for i in candidates:
                    own = items.shingles[i]
                    at = np.minimum(np.searchsorted(whole, own), len(whole) - 1)
                    hits = int((whole[at] == own).sum())
                    if hits * share[1] >= len(own) * share[0]:
                        out.append((doc_id, i, len(own), hits))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    return rows


def contained_items(docs: DataFrame, benchmark: DataFrame, share: tuple[int, int] = (3, 4)) -> DataFrame:
    """doc_id, item_id, item_shingles, shared_shingles of every item found in a document."""
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = None
    for k in range(blocks):
        block = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).select("item_id", "text").toArrow()
        ids, texts = block["item_id"].to_pylist(), block["text"].to_pylist()
        shared = spark.sparkContext.broadcast((ids, texts))
        hits = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            search(shared, share), "doc_id long, item long, item_shingles long, shared_shingles long"
        )
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
        hits = hits.join(F.broadcast(names), "item").select("doc_id", "item_id", "item_shingles", "shared_shingles")
        found = hits if found is None else found.union(hits)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no item is found. Rows are judged by a stored number, so ids may repeat or be null."""
    numbered = settled(docs.withColumn("_row", F.monotonically_increasing_id()), "decontaminate-rows")
    leaks = contained_items(numbered.select(F.col("_row").alias("doc_id"), "text"), benchmark)
    leaks = leaks.select(F.col("doc_id").alias("_row")).distinct()
    return numbered.join(leaks, "_row", "left_anti").select(*docs.columns)
