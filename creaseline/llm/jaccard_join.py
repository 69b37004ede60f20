"""N-gram Jaccard join by vertical partitioning.

Sets are the distinct five-word shingles of whole texts; two documents link when their
Jaccard similarity reaches 0.75. Equal sets are joined once, through their class.

The n-grams have one global order: first those of a single set, then the others, then the
frequent ones by frequency, and by hash within each. Pivots cut this order into fragments,
the same ones for all sets.

1. A first scan notes each document's class, and counts all n-grams. The counts travel as
   sorted, delta-coded lists, cut by hash range, so that no n-gram is a group of its own.
2. Sets that reach the similarity share an n-gram among the leading ones of both, which are
   just over a quarter of a set. A second scan emits these, but for those that were counted
   once. The first and the least common n-grams lie here, so passages that many documents
   share stay out of it.
3. How many leading n-grams a pair shares, and what is left of either set, bound its overlap.
   Only pairs that can still reach the similarity go on.
4. Their sets are cut at the pivots. Each fragment counts its partial overlaps by itself,
   and these are summed per pair. The first fragment, n-grams of a single set, is not
   sent: its partial overlaps are zero.

Only components are asked for, so each set is first compared with few others. A leading n-gram
names the member with the fewest rarer n-grams before it, which in a group of near copies is
the one nearest to their common core; a set meets the member that most of its n-grams name. Pairs that are connected by then need no comparison. The last round takes every pair
of members that are still unconnected; none is dropped.

Nulls and empty texts, and texts without words, have no shingles and link with nothing. A
null doc_id is the id of its row; a class takes the smallest id that is not null. Repeated
rows are documents of one class. Empty tables give no rows; other columns are not read.
Classes are told apart by a 64-bit signature.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm.components import component_labels
from creaseline.llm.words import WordHashes, set_signature, shingle_set
from creaseline.sources.workspace import settled

SIMILARITY = Fraction(3, 4)
FREQUENT = 8
MOST_FREQUENT_KEPT = 1 << 20  # entries of the frequency table that is broadcast
FILTER_BITS = 26  # the repeated n-grams' filter is broadcast as so many bits: 8 MB
TOKENS_PER_RANGE = 2_000_000
TOKENS_PER_LIST = 2_000_000
COMMON_FRAGMENTS = 4  # of the n-grams that are repeated, but not frequent
FREQUENT_FRAGMENTS = 4
HUBS = (1, 4)  # by round, how many others one set is compared with at most
SETS_REMEMBERED = 50_000
BATCH_ROWS = 500
ROW = "_row"  # the row number that stages carry
GAP = np.uint16(65535)

SCAN_SCHEMA = "doc_id long, n long, sig long, hash_range int, tokens binary"


def packed(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as 16-bit gaps; larger gaps follow in full."""
    gaps = np.diff(values, prepend=np.uint32(0)).astype(np.uint32)
    wide = gaps >= GAP
    short = np.where(wide, GAP, gaps).astype(np.uint16)
    return np.uint32(len(values)).tobytes() + short.tobytes() + gaps[wide].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    gaps = np.frombuffer(raw, np.uint16, n, 4).astype(np.uint64)
    gaps[gaps == GAP] = np.frombuffer(raw, np.uint32, -1, 4 + 2 * n)
    return np.cumsum(gaps).astype(np.uint32)


def token_lists(pieces: list[np.ndarray], range_bits: int) -> Iterator[tuple[int, bytes]]:
    """The lists of one task by hash range; a value stands at most FREQUENT times in each."""
    values = np.sort(np.concatenate(pieces))
    kept = np.ones(len(values), bool)
    kept[FREQUENT:] = values[FREQUENT:] != values[:-FREQUENT]
    values = values[kept]
    ranges = values >> np.uint32(32 - range_bits) if range_bits else np.zeros(len(values), np.uint32)
    starts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]]))
    for at, end in zip(starts, [*starts[1:], len(values)]):
        yield int(ranges[at]), packed(values[at:end])


def first_scan(range_bits: int):
    """Class of every document; what each task has counted, by hash range."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, pieces, held, known = WordHashes(), [], 0, set()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("hash_range", pa.int32()), ("tokens", pa.binary())]
        )

        def lists():
            made = list(token_lists(pieces, range_bits))
            none = [None] * len(made)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip((none, none, none, [m[0] for m in made], [m[1] for m in made]), schema)],
                schema=schema,
            )

        for batch in batches:
            sizes, signs = [], []
            for text in batch.column(1).cast(pa.binary()):
                shingles = shingle_set(text.as_py(), seen)
                sign = set_signature(shingles)
                sizes.append(len(shingles))
                signs.append(sign)
                if sign not in known:
                    if len(known) >= SETS_REMEMBERED:
                        known.clear()
                    known.add(sign)
                    pieces.append((shingles >> np.uint64(32)).astype(np.uint32))
                    held += len(shingles)
            none = pa.nulls(len(sizes))
            columns = (batch.column(0), sizes, signs, none.cast(pa.int32()), none.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) if isinstance(c, list) else c for c, t in zip(columns, schema)], schema=schema)
            if held >= TOKENS_PER_LIST:
                yield lists()
                pieces, held = [], 0
        if held:
            yield lists()

    return rows


def count_range(frames: Iterator, range_bits: int):
    """Of one hash range: which filter bits hold a repeated value, and the frequent values."""
    values = np.sort(np.concatenate([unpacked(raw) for raw in frames]))
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.append(starts, len(values)))
    values = values[starts]
    bits = np.zeros(1 << (FILTER_BITS - range_bits), bool)
    repeated = values[counts >= 2]
    bits[(repeated >> np.uint32(32 - FILTER_BITS)) & np.uint32(len(bits) - 1)] = True
    often = counts >= FREQUENT
    return np.packbits(bits, bitorder="little").tobytes(), values[often], counts[often]


def counted(lists: DataFrame, range_bits: int) -> DataFrame:
    """hash_range, bits, and the frequent values with their counts, one row per range."""
    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bits, values, counts = count_range(frame["tokens"], range_bits)
        return pd.DataFrame(
            {"hash_range": [key[0]], "bits": [bits], "often": [values.astype(np.int64)], "times": [counts.astype(np.int64)]}
        )

    return lists.groupBy("hash_range").applyInPandas(one, "hash_range int, bits binary, often array<long>, times array<long>")


def frequent_values(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most MOST_FREQUENT_KEPT values, the most frequent ones, sorted by value.

    The rest count as not frequent, which changes the order, not the result.
    """
    pairs = counts.select(F.explode(F.arrays_zip("often", "times")).alias("x")).select("x.often", "x.times")
    by_times = sorted(((r[0], r[1]) for r in pairs.groupBy("times").count().orderBy(F.desc("times")).limit(MOST_FREQUENT_KEPT).collect()), reverse=True)
    least, kept = 1 << 62, 0
    for times, number in by_times:
        if kept + number > MOST_FREQUENT_KEPT:
            break
        least, kept = times, kept + number
    found = pairs.where(F.col("times") >= least).orderBy("often").limit(MOST_FREQUENT_KEPT).toArrow()
    return found["often"].to_numpy().astype(np.uint32), found["times"].to_numpy().astype(np.uint32)


def prefix_length(n: int, similarity: Fraction = SIMILARITY) -> int:
    """So many leading n-grams of a set of n: a similar set shares one of them."""
    return n - -(-n * similarity.numerator // similarity.denominator) + 1


class Order:
    """The global order: which n-grams are repeated, and the frequent ones with their fragments."""

    def __init__(self, raw: bytes, often: np.ndarray, times: np.ndarray):
        self.bits, self.often, self.times = np.frombuffer(raw, np.uint8), often, times
        by_frequency = np.lexsort((often, times))
        mass = np.cumsum(times[by_frequency], dtype=np.int64)
        self.fragment = np.empty(len(often), np.int32)
        self.fragment[by_frequency] = (mass - 1) * FREQUENT_FRAGMENTS // mass[-1] if len(mass) else 0

    def places(self, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each value may stand among the frequent ones, and whether it does."""
        if not len(self.often):
            return np.zeros(len(short), np.int64), np.zeros(len(short), bool)
        at = np.minimum(np.searchsorted(self.often, short), len(self.often) - 1)
        return at, self.often[at] == short

    def repeated(self, short: np.ndarray) -> np.ndarray:
        slot = short >> np.uint32(32 - FILTER_BITS)
        return (self.bits[slot >> np.uint32(3)] >> (slot & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1

    def leading(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The repeated ones of a set's leading n-grams, and how many of the set precede each."""
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        repeated = self.repeated(short)
        rank = repeated.astype(np.uint32)
        at, often = self.places(short[repeated])
        if often.any():
            rank[repeated] = np.where(often, self.times[at], 1)
        order = np.argsort(rank, kind="stable")[: prefix_length(len(shingles))]  # the shingles are sorted already
        places = np.flatnonzero(repeated[order])
        return shingles[order[places]], places

    def fragments(self, shingles: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """A set cut at the pivots of the order, without its n-grams of a single set."""
        shingles = shingles[self.repeated((shingles >> np.uint64(32)).astype(np.uint32))]
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        at, often = self.places(short)
        fragment = (short.astype(np.int64) * COMMON_FRAGMENTS >> 32).astype(np.int32)
        if often.any():
            fragment[often] = COMMON_FRAGMENTS + self.fragment[at[often]]
        for k in np.unique(fragment):
            yield int(k), shingles[fragment == k]


def second_scan(shared):
    """Repeated n-grams of each set's leading fragment."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(*shared.value)
        seen, known = WordHashes(), set()
        for batch in batches:
            tokens, places, signs, sizes = [], [], [], []
            for text in batch.column(0).cast(pa.binary()):
                shingles = shingle_set(text.as_py(), seen)
                sign = set_signature(shingles)
                if not sign or sign in known:
                    continue
                if len(known) >= SETS_REMEMBERED:
                    known.clear()
                known.add(sign)
                found, before = order.leading(shingles)
                tokens.append(found.view(np.int64))
                places.append(before.astype(np.int32))
                signs.append(np.full(len(found), sign, np.int64))
                sizes.append(np.full(len(found), len(shingles), np.int32))
            if tokens:
                columns = [pa.array(np.concatenate(c)) for c in (tokens, signs, sizes, places)]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "sig", "n", "place"])

    return rows


def fragment_scan(shared):
    """Whole sets, cut into the fragments of the global order."""
    schema = pa.schema([("sig", pa.int64()), ("fragment", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = Order(*shared.value), WordHashes()
        for batch in batches:
            signs, places, parts = [], [], []
            for text in batch.column(0).cast(pa.binary()):
                shingles = shingle_set(text.as_py(), seen)
                sign = set_signature(shingles)
                for k, part in order.fragments(shingles):
                    signs.append(sign)
                    places.append(k)
                    parts.append(part.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((signs, places, parts), schema)], schema=schema)

    return rows


def scanned(docs: DataFrame) -> tuple[DataFrame, DataFrame, Broadcast]:
    """(doc_id, n, sig) of every document; (token, sig, n, place) of leading n-grams; the order."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    range_bits = min(FILTER_BITS - 3, max(6, (size // 7 // TOKENS_PER_RANGE).bit_length()))
    scan = settled(docs.select("doc_id", "text").mapInArrow(first_scan(range_bits), SCAN_SCHEMA), "jaccard-scan")
    classes = scan.where("hash_range is null").select("doc_id", "n", "sig")
    counts = settled(counted(scan.where("hash_range is not null").select("hash_range", "tokens"), range_bits), "jaccard-counts")
    bits = bytearray(1 << (FILTER_BITS - 3))
    width = len(bits) >> range_bits
    for row in counts.select("hash_range", "bits").toLocalIterator():  # fixed size in all
        bits[row[0] * width : (row[0] + 1) * width] = row[1]
    shared = spark.sparkContext.broadcast((bytes(bits), *frequent_values(counts)))
    leads = docs.select("text").mapInArrow(second_scan(shared), "token long, sig long, n int, place int")
    return classes, settled(leads, "jaccard-leads"), shared


def length_filter(a: str, b: str):
    """Sets whose sizes alone rule the similarity out."""
    low, high = F.least(a, b), F.greatest(a, b)
    return low * SIMILARITY.denominator >= high * SIMILARITY.numerator


def reaches(overlap, a: str, b: str):
    """overlap / (a + b - overlap) is at least the similarity."""
    return overlap * (SIMILARITY.denominator + SIMILARITY.numerator) >= (F.col(a) + F.col(b)) * SIMILARITY.numerator


def with_sizes(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("sig").alias(side), F.col("n").alias(f"n{side}")), side)
    return pairs


def plausible(pairs: DataFrame, sizes: DataFrame, leads: DataFrame) -> DataFrame:
    """Pairs that the sizes and the common leading n-grams still allow; one row a pair all along.

    What lies behind the leading n-grams of a set is at most three quarters of it, less one.
    """
    pairs = with_sizes(pairs, sizes).where(length_filter("na", "nb"))
    for side in ("a", "b"):
        pairs = pairs.join(leads.select(F.col("sig").alias(side), F.col("tokens").alias(f"tokens_{side}")), side)
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    behind = F.ceil(F.greatest("na", "nb") * SIMILARITY.numerator / SIMILARITY.denominator) - 1
    return pairs.where(reaches(common + behind, "na", "nb")).select("a", "b", "na", "nb")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shared: Broadcast) -> DataFrame:
    """Pairs whose partial overlaps, summed over the fragments, reach the similarity."""
    signs = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    ids = classes.join(signs, "sig").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    ids = settled(ids.select("doc_id").distinct(), "jaccard-ids")
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
    parts = texts.mapInArrow(fragment_scan(shared), "sig long, fragment int, tokens array<long>").dropDuplicates(["sig", "fragment"])
    parts = settled(parts, "jaccard-fragments")
    side = lambda s: parts.select(F.col("sig").alias(s), "fragment", F.col("tokens").alias(f"tokens_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), ["b", "fragment"])
    partial = both.withColumn("overlap", F.size(F.array_intersect("tokens_a", "tokens_b")))
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap")).where(reaches(F.col("overlap"), "na", "nb"))


def with_components(table: DataFrame, labels: DataFrame | None, sig: str, name: str) -> DataFrame:
    """Add the component of a set; its own signature where it is not linked so far."""
    if labels is None:
        return table.withColumn(name, F.col(sig))
    found = labels.select(F.col("sig").alias(sig), F.col("component").alias(name))
    return table.join(found, sig, "left").withColumn(name, F.coalesce(name, sig))


def open_members(leads: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members, with their components, of the n-grams whose members are not all connected."""
    members = with_components(leads, labels, "sig", "component")
    ends = members.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return settled(members.join(ends.where("low <> high").select("token"), "token"), "jaccard-open")


def hub_pairs(members: DataFrame, labels: DataFrame | None, hubs: int) -> DataFrame:
    """Each set with so many hubs, those that most of its n-grams name.

    An n-gram names the member in which it stands first, the same one to all members. Each
    further hub sees places in steps four times as long, and so is more a matter of chance.
    """
    low = F.lit((1 << 40) - 1)
    chance = lambda k: F.xxhash64(F.lit(hubs), F.lit(k), "sig").bitwiseAND(low)
    first = lambda k: F.shiftleft(F.shiftright("place", 2 * k).cast("long"), 40).bitwiseOR(chance(k))
    named = F.array(*[F.min_by("sig", first(k)) for k in range(hubs)])
    hubs = members.groupBy("token").agg(named.alias("hubs")).select("token", F.posexplode("hubs").alias("seed", "hub"))
    hubs = with_components(hubs, labels, "hub", "other")
    named = members.select("token", "sig", "component").join(hubs, "token").where("component <> other")
    votes = named.groupBy("sig", "seed", "hub").agg(F.count("*").alias("votes"))
    most = votes.groupBy("sig", "seed").agg(F.max("votes").alias("most"))
    return votes.join(most, ["sig", "seed"]).where("votes = most").groupBy("sig", "seed").agg(F.min("hub").alias("hub"))


def open_pairs(members: DataFrame) -> DataFrame:
    """Every two members of an n-gram that are not connected, if it can be their first common one.

    What stands from it on in either set must still allow the similarity.
    """
    theirs = members.select("token", F.col("sig").alias("hub"), F.col("component").alias("other"), F.col("n").alias("m"), F.col("place").alias("spot"))
    rest = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("spot"))
    fits = length_filter("n", "m") & reaches(rest, "n", "m") & (F.col("sig") < F.col("hub")) & (F.col("component") != F.col("other"))
    return members.join(theirs, "token").where(fits)


def linked(docs: DataFrame, classes: DataFrame, leads: DataFrame, shared: Broadcast) -> DataFrame:
    """sig and component of the classes that are linked with others."""
    sizes = settled(classes.where("n > 0").select("sig", "n").distinct(), "jaccard-sizes")
    repeated = leads.groupBy("token").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).where("low <> high")
    leads = settled(leads.join(repeated.select("token"), "token").dropDuplicates(["token", "sig"]), "jaccard-repeated")
    lists = settled(leads.groupBy("sig").agg(F.collect_list("token").alias("tokens")), "jaccard-lists")
    labels, done = None, None
    for hubs in (*HUBS, 0):
        members = open_members(leads, labels)
        pairs = hub_pairs(members, labels, hubs) if hubs else open_pairs(members)
        pairs = pairs.select(F.least("sig", "hub").alias("a"), F.greatest("sig", "hub").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = settled(pairs, "jaccard-pairs")
        done = pairs if done is None else done.union(pairs)
        likely = settled(plausible(pairs, sizes, lists), "jaccard-likely")
        if likely.isEmpty():
            continue
        edges = verified(likely, docs, classes, shared).select("a", "b")
        edges = edges if labels is None else edges.union(labels.select("sig", "component"))
        labels = settled(component_labels(edges, "a", "b").toDF("sig", "component"), "jaccard-components")
    return leads.select("sig", F.col("sig").alias("component")).limit(0) if labels is None else labels


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Whole texts go to Python in batches of so many rows meanwhile, which bounds a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    with batches_of(docs.sparkSession, BATCH_ROWS):
        classes, leads, shared = scanned(docs)
        labels = linked(docs, classes, leads, shared).toDF("sig", "root")
        shared.destroy()
    first = classes.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    first = first.join(labels, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = first.groupBy("root").agg(F.min("first").alias("component_id"))
    members = first.join(least, "root").select("sig", "component_id")
    found = classes.join(members, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """Of each component the row with the least id, then row number; ids may repeat or be null.

    Rows are told apart by a stored number, not by their id. Texts without words link with
    nothing and stay.
    """
    numbered = settled(docs.withColumn(ROW, F.monotonically_increasing_id()), "jaccard-rows")
    found = settled(jaccard_components(numbered.select(F.col(ROW).alias("doc_id"), "text")), "jaccard-result")
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = found.join(several, "component_id").select(F.col("doc_id").alias(ROW), "component_id")
    members = settled(members.join(numbered.select(ROW, "doc_id"), ROW), "jaccard-members")
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", ROW)
    first = members.groupBy("component_id").agg(F.min(rank)[ROW].alias("first"))
    gone = settled(members.join(first, "component_id").where(F.col(ROW) != F.col("first")).select(ROW), "jaccard-gone")
    return numbered.join(gone, ROW, "left_anti").select(*docs.columns)
