"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are its distinct words, pairs of neighbours and pairs with one word
between, hashed to a fixed range. The model is fitted on a bounded sample of the labelled
documents (SAMPLE_ROWS, chosen by hash). Each round, the sample's shards run the updates
over their documents, PASSES times, from a common state, and what they add to the state is averaged over
the shards that met a coordinate. Rates are kept per coordinate, and the L1 term leaves
few weights, which are broadcast to score every whole text.

The L1 term also draws scores together, and those of unseen documents most. So the same
rounds fit one more model for each fold of the sample, without that fold, and a logistic
line through the margins that these give to their left-out folds is put over the weights:
a score of 0.3 then means 0.3. The line is left out if a fold lacks either label.

Labels are only read for documents outside the held-out quarter. A score depends on the
text alone.

Nulls: null text is empty and scored by the intercept, as are texts without words. Null
labels and ids do not train; an id with several labels trains with each. A null id is held
out or not by the checksum of the empty text. Repeated rows get equal scores. Without
labels of both kinds every score is the rate of the labels, or 0 without labels. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.words import WordHashes, mixed_bits, word_hashes
from creaseline.sources.workspace import settled

SAMPLE_ROWS = 8_000
SHARDS = 4
ROUNDS, PASSES = 6, 2  # passes over a shard in each round
FOLDS = 2  # of the sample, for the calibration
HASH_BITS = 28
LEAST_DOCS = 4  # of the sample, that have a feature
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0
CUTOFF = 0.3
FILTER_BITS = 18
LOWER = bytes(c + 32 if 65 <= c < 91 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == 2


def features(text: bytes | None, seen: WordHashes) -> np.ndarray:
    """Hashed features, one for each place; 0 is kept for the intercept."""
    words = word_hashes((text or b"").translate(LOWER), seen)
    n = len(words)
    total = np.empty(max(3 * n - 3, n), np.uint64)
    total[:n] = words
    for k, step in ((1, 1), (2, 2)):
        if n > step:
            at = n if step == 1 else 2 * n - 1
            total[at : at + n - step] = words[:-step] * np.uint64(2 * k + 1) + mixed_bits(words[step:] + np.uint64(k))
    return (mixed_bits(total) >> np.uint64(64 - HASH_BITS)).astype(np.int64) | np.int64(1)


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = WordHashes()
    for batch in batches:
        found = [np.unique(features(t.as_py(), seen)).astype(np.int32) for t in batch.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "found"])


def places_of(shared):
    """Features as their places in the vocabulary, the intercept first; others are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            places = []
            for found in batch.column(2):
                found = found.values.to_numpy()
                at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
                places.append(np.concatenate([[0], at[vocabulary[at] == found]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32()))], names=["doc_id", "toxic", "places"])

    return rows


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step; the intercept at place 0 has no penalty."""
    least = np.full(len(z), L1)
    least[0] = 0.0
    size = np.maximum(np.abs(z) - least, 0.0)
    return -np.sign(z) * size / ((BETA + np.sqrt(n)) / ALPHA + L2)


def run_shard(places: list[np.ndarray], toxic: np.ndarray, z: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the documents; z and n are changed."""
    for at, y in zip(places, toxic):
        w = weights_of(z[at], n[at])
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g
    return z, n


def shard_pass(shared, round_: int):
    """What one pass over a shard adds to the common state of its model."""

    def added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        z, n = shared.value[key[0]]
        frame = frame.sort_values(["doc_id", "toxic"]).sample(frac=1, random_state=round_)
        places, toxic = frame["places"].to_list(), frame["toxic"].to_numpy(float)
        new_z, new_n = z.copy(), n.copy()
        for _ in range(PASSES):
            run_shard(places, toxic, new_z, new_n)
        moved = np.flatnonzero(new_n != n)
        return pd.DataFrame({"model": key[0], "place": moved, "dz": (new_z - z)[moved], "dn": (new_n - n)[moved]})

    return added


def round_sums(shards: DataFrame, states: list[tuple[np.ndarray, np.ndarray]], round_: int) -> DataFrame:
    """What each shard adds to each model in a round. The shards are dealt already, so nothing is shuffled."""
    shared = shards.sparkSession.sparkContext.broadcast(states)
    models = shards.withColumn("model", F.explode(F.array([F.lit(k) for k in range(len(states))]))).where("model <> fold")
    return models.groupBy("model", "shard").applyInPandas(shard_pass(shared, round_), "model int, place int, dz double, dn double")


def add_averages(states: list[tuple[np.ndarray, np.ndarray]], moved: pa.Table) -> None:
    """Add to each state, at each place, what the shards that met the place add on average."""
    model, places, added = moved["model"].to_numpy(), moved["place"].to_numpy(), [moved[c].to_numpy() for c in ("dz", "dn")]
    for k, state in enumerate(states):
        mine = model == k
        met = np.maximum(np.bincount(places[mine], minlength=len(state[0])), 1)
        for held, new in zip(state, added):
            held += np.bincount(places[mine], new[mine], len(held)) / met


def trained(sample: DataFrame, size: int) -> list[np.ndarray]:
    """The weights of model 0, fitted on all rows, and of a model without each fold."""
    shards = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int"))
    shards = shards.repartitionByRange(SHARDS, "shard").persist()  # dealt once, for all rounds and models; as many rows as the sample
    states = [(np.zeros(size), np.zeros(size)) for _ in range(FOLDS + 1)]
    for round_ in range(ROUNDS):
        add_averages(states, round_sums(shards, states, round_).toArrow())  # per shard and model at most the vocabulary of the sample
    shards.unpersist()
    return [weights_of(z, n) for z, n in states]


def left_out_margins(shared):
    """The margin that each document of the sample gets from the model without its fold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [float(shared.value[k][at.values.to_numpy()].sum()) for k, at in zip(batch.column(0).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["fold", "toxic", "margin"])

    return rows


def logistic_line(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit the labels best, by Newton steps; targets keep off 0 and 1."""
    ones = toxic.sum()
    wanted = np.where(toxic == 1, (ones + 1) / (ones + 2), 1 / (len(toxic) - ones + 2))
    rows, line = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ line, -30, 30)))
        curve = rows.T @ (rows * np.maximum(p * (1 - p), 1e-9)[:, None]) + 1e-6 * np.eye(2)
        line = line - np.linalg.solve(curve, rows.T @ (p - wanted))
    return (float(line[0]), float(line[1])) if np.isfinite(line).all() and line[0] > 0 else (1.0, 0.0)


def calibration(sample: DataFrame, weights: list[np.ndarray]) -> tuple[float, float]:
    kinds = sample.select("fold", "toxic").distinct().count()
    if kinds < 2 * FOLDS:
        return 1.0, 0.0
    shared = sample.sparkSession.sparkContext.broadcast(weights)
    found = sample.select("fold", "toxic", "places").mapInArrow(left_out_margins(shared), "fold int, toxic int, margin double")
    found = found.select("toxic", "margin").orderBy("margin", "toxic").toArrow()  # as many rows as the sample
    return logistic_line(found["margin"].to_numpy(), found["toxic"].to_numpy().astype(float))


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight, their weights, and the intercept."""
    spark = docs.sparkSession
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marks = marks.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    marks = settled(marks.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE_ROWS), "toxic-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("doc_id", "toxic", "text")
    sample = settled(texts.mapInArrow(sample_features, "doc_id long, toxic int, found array<int>"), "toxic-features")

    counts = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return np.empty(0, np.int64), np.empty(0), 30.0 if counts.get(1) else -30.0
    vocabulary = sample.select(F.explode("found").alias("feature")).groupBy("feature").count()
    vocabulary = vocabulary.where(F.col("count") >= LEAST_DOCS).select("feature").toArrow()["feature"].to_numpy()
    vocabulary = np.concatenate([[0], np.sort(vocabulary.astype(np.int64))])  # the intercept first
    places = sample.mapInArrow(places_of(spark.sparkContext.broadcast(vocabulary)), "doc_id long, toxic int, places array<int>")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int") + 1
    sample = settled(places.withColumn("fold", fold), "toxic-places")
    weights = trained(sample, len(vocabulary))
    slope, offset = calibration(sample, weights)
    kept = np.flatnonzero(weights[0][1:]) + 1
    return vocabulary[kept], slope * weights[0][kept], slope * float(weights[0][0]) + offset


def scorer(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, intercept = shared.value
        known = np.zeros(1 << FILTER_BITS, bool)
        known[names & ((1 << FILTER_BITS) - 1)] = True
        seen = WordHashes()
        for batch in batches:
            scores = []
            for text in batch.column(1).cast(pa.binary()):
                found = features(text.as_py(), seen)
                found = np.unique(found[known[found & ((1 << FILTER_BITS) - 1)]])
                total = intercept
                if len(found) and len(names):
                    at = np.minimum(np.searchsorted(names, found), len(names) - 1)
                    total += float(weights[at[names[at] == found]].sum())
                scores.append(1.0 / (1.0 + np.exp(-max(-30.0, min(30.0, total)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return rows


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(scorer(shared), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )
