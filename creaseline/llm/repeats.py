"""Periodic runs of words, by the dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least four periods and six
words long, that no neighbouring word extends. The dictionary names every stretch of 1, 2, 4,
8, ... words, equal names for equal stretches, a name of twice the length being a pair of
names. At length L each position's successor is the next place of its name. Successors no
further than L, so that both stretches lie within 2 L words, propose their distance as a
period. In a run of period q, with L the first power of two from q on, every position's
successor is q words on, the places of a name are an arithmetic progression, and the
positions of the run follow each other without a gap: the block of neighbouring positions
with one and the same distance is the run, extended as far as it goes. A run is proposed at
one length only (L/2 < q <= L); a multiple of q is never a successor's distance, so what is
proposed is the smallest period.

Positions whose name occurs once can be in no longer repeated stretch and drop out, so most
texts are done after a few lengths. Texts are taken together in slices, with names of their
own; each text is scanned as a whole, by one task.

Nulls: null text is empty and has no words, no runs and an empty collapsed text. Texts shorter
than six words have no runs. Repeated rows are documents of their own. An empty table gives no
rows. The input row is carried as one struct, so its columns never clash with new ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LEAST_WORDS = 6
LEAST_PERIODS = 4
SLICE_WORDS = 200_000

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order, dense rank of each key, and whether it occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = np.concatenate([[False], keys[order[1:]] == keys[order[:-1]]])
    rank, again = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    rank[order] = np.cumsum(~same) - 1
    again[order] = same | np.append(same[1:], False)
    return order, rank, again


def successor_distances(order: np.ndarray, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Words from each place to the next place of the same name; 0 where there is none."""
    distance = np.zeros(len(places), np.int64)
    here, after = order[:-1], order[1:]
    follows = rank[here] == rank[after]
    distance[here[follows]] = (places[after] - places[here])[follows]
    return distance


def periodic_runs(names: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period.

    ``names`` are the words of several texts in a row, as integers, and ``texts`` the text
    of each; a name stands in one text only.
    """
    found = []
    places, keys, length = np.arange(len(names)), names, 1
    at = np.full(len(names), -1, np.int64)
    while len(places) > 1:
        order, rank, again = ranked(keys)
        distance = successor_distances(order, rank, places)
        proposed = (distance <= length) & (2 * distance > length)
        lasts = (places[1:] == places[:-1] + 1) & (distance[1:] == distance[:-1]) & proposed[1:]
        begins = np.flatnonzero(proposed & ~np.concatenate([[False], lasts]))
        ends = np.flatnonzero(proposed & ~np.append(lasts, False))
        period = distance[begins]
        long = ends - begins + length + period
        good = long >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append((places[begins[good]], long[good], period[good]))

        places, rank = places[again], rank[again]
        at[:] = -1
        at[places] = rank
        inside = places + length < len(names)
        places, rank = places[inside], rank[inside]
        second = at[places + length]
        paired = (second >= 0) & (texts[places] == texts[places + length])
        places, keys = places[paired], rank[paired] * (len(names) + 1) + second[paired]
        length *= 2
    start, long, period = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(3))
    order = np.lexsort((period, start))
    return start[order], long[order], period[order]


def word_slices(texts: pa.Array, most: int = SLICE_WORDS) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in runs of about so many words."""
    held, size = [], 0
    for text in texts.cast(pa.binary()):
        words = (text.as_py() or b"").split()
        held.append(words)
        size += len(words)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def scanned(texts: list[list[bytes]]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray], list[bytes]]:
    """Runs per text, the runs with starts within their texts, and the collapsed texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number: dict[bytes, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, sizes.sum())
    text_of = np.repeat(np.arange(len(texts)), sizes)
    start, long, period = periodic_runs(text_of * (len(number) + 1) + words, text_of)
    first = np.cumsum(sizes) - sizes
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + long, -1)
    dropped = np.cumsum(depth)[:-1] > 0
    owner = text_of[start] if len(start) else start
    counts = np.bincount(owner, minlength=len(texts))
    collapsed = []
    for k, own in enumerate(texts):
        if counts[k]:
            gone = dropped[first[k] : first[k] + sizes[k]]
            own = [w for w, out in zip(own, gone.tolist()) if not out]
        collapsed.append(b" ".join(own))
    return counts, (start - first[owner], long, period), collapsed


def word_runs(docs: DataFrame, text: str = "text", carried: list[str] | None = None) -> DataFrame:
    """row (the carried columns, all by default), runs by start and period, and the collapsed text.

    The collapsed text has the words that stand in no run, or among the first period of
    every run they stand in, one blank apart.
    """
    names = docs.columns if carried is None else carried
    table = docs.select(F.struct(*names).alias("row"), F.col(text).alias("text"))
    schema = T.StructType([table.schema["row"], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in word_slices(batch.column(1)):
                counts, runs, collapsed = scanned(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                fields = arrow.field(1).type.value_type
                items = pa.StructArray.from_arrays([pa.array(r, pa.int64()) for r in runs], fields=list(fields))
                lists = pa.ListArray.from_arrays(offsets, items).cast(arrow.field(1).type)
                row = batch.column(0).slice(done, len(texts)).cast(arrow.field(0).type)
                text = pa.array(collapsed, pa.binary()).cast(arrow.field(2).type)
                yield pa.RecordBatch.from_arrays([row, lists, text], schema=arrow)
                done += len(texts)

    return table.mapInArrow(scan, schema)


def longest_run(runs: str = "runs"):
    """The run with the greatest length, then the smallest start and period; null without runs."""
    order = lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    best = F.array_max(F.transform(runs, order))
    return F.when(
        best.isNotNull(),
        F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")),
    )


def run_digests(found: DataFrame) -> DataFrame:
    """row, n_runs, the longest run, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    best = found.withColumn("longest", longest_run())
    return best.select(
        "row",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, one document in ten with a tail of words made periodic.

    With h the checksum of the id's decimal form, n words, g = h div 10 and a = g mod n, a
    document with h mod 10 = 0 repeats its p = 1 + (n - a) div (3 + g mod 8) words from a on,
    up to its length. Texts without words, and null ids, stay as they are.
    """
    drawn = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    drawn = drawn.withColumn("words", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))
    n, g = F.nullif(F.size("words"), F.lit(0)), F.floor(F.col("h") / 10)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return drawn.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))
