"""Taking in folders of match documents, again and again.

The store is a versioned table with several parts: ``files``, the manifest; ``quarantine``,
the documents that cannot be read, whole; and one per layer. One run reads the files that
are new or have changed since the last version, and ends in one version or in none. In every
part it writes a segment of the same name, so a segment of the manifest lists the
files whose rows lie in the segments of that name.

A changed file replaces its rows: segments that hold rows of such files are written anew
without them, all others are listed again as they are. A run costs what has arrived and
what it touches, not the table. Files that have vanished keep their rows.

Documents are parsed once. The job that stores them counts good and bad ones as well; if too
many are bad, the run fails before anything is committed. Files above a given size are read in
pieces, see :mod:`sources.pieces`, and unreadable ones stored in pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from creaseline.functions.keys import base_name
from creaseline.operators.quality import QUARANTINE_LIMIT_PERCENT
from creaseline.sources import pieces, schemas, versions
from creaseline.sources.documents import CORRUPT, list_files, read_files
from creaseline.sources.workspace import settled

FILES = "files"
QUARANTINE = "quarantine"
FILE_NAME = "src_file_name"
MANIFEST = schemas.fields(
    src_file_name=schemas.TEXT, file_size=schemas.BIG, modified_time=TimestampType(), ingested_ts=TimestampType(), segment=schemas.TEXT
)
BAD_DOCUMENTS = schemas.fields(**schemas.columns(schemas.TEXT, "src_file_path", "src_file_name", "record"), piece=schemas.INT)


class TooManyBadDocuments(RuntimeError):
    """More documents than the limit allows cannot be read; nothing was committed."""


@dataclass(frozen=True)
class Ingested:
    """The version after a run and what the run took in; without new files it is the version before."""

    version: versions.Version
    files: int = 0
    replaced: int = 0
    good: int = 0
    bad: int = 0


def manifest(spark: SparkSession, store: str, version: versions.Version | None = None) -> DataFrame:
    """The files taken in, with the segment their rows lie in."""
    return versions.read_part(spark, store, FILES, schema=MANIFEST, version=version)


def quarantined(spark: SparkSession, store: str, version: versions.Version | None = None, in_pieces: bool = False) -> DataFrame:
    """The documents that cannot be read, as they are; those of large files in the pieces they are stored in, if asked for."""
    held = versions.read_part(spark, store, QUARANTINE, schema=BAD_DOCUMENTS, version=version).fillna(0, "piece")
    if in_pieces:
        return held
    return held.groupBy("src_file_path", FILE_NAME).agg(pieces.joined_in_order("piece", F.col("record")).alias("record"))


def arrivals(spark: SparkSession, folder: str, pattern: str, known: DataFrame, name: Callable[[Column], Column] = base_name) -> DataFrame:
    """Files of the folder that the manifest does not hold with the same name, size and change time."""
    listed = list_files(spark, folder, pattern).select(name(F.col("path")).alias(FILE_NAME), "path", "file_size", "modified_time")
    return listed.join(known, [FILE_NAME, "file_size", "modified_time"], "left_anti")


def ingest(
    spark: SparkSession,
    folder: str,
    store: str,
    layers: Mapping[str, Callable[[DataFrame], DataFrame]],
    pattern: str = "*.json",
    limit_percent: float = QUARANTINE_LIMIT_PERCENT,
    name: Callable[[Column], Column] = base_name,
    parts_above: int | None = None,
) -> Ingested:
    """Take the new and changed files of a folder into the store.

    ``layers`` has a function per part, from documents to rows with the column
    ``src_file_path``. Files are known by what ``name`` makes of their path, the base name by
    default, which becomes ``src_file_name`` in every part. Spark's scans do not list files
    without a single byte, so they are as if absent. The paths of the new files come to
    the driver, where Spark's own scan lists them as well.

    Documents in files of more than ``parts_above`` bytes come to the layers in parts, so that no task has to hold
    one; :func:`flatten.match_rows` and :func:`flatten.ball_rows` take these. By default all come whole.
    """
    before = versions.latest(spark, store)
    known = manifest(spark, store, before)
    arrived = settled(arrivals(spark, folder, pattern, known, name), "arrived")
    sizes = {row.path: row.file_size for row in arrived.select("path", "file_size").toLocalIterator()}
    if not sizes:
        return Ingested(before)
    large = [path for path, size in sizes.items() if parts_above is not None and size > parts_above]
    small = sorted(sizes.keys() - large)
    names = arrived.select(FILE_NAME).distinct()
    replaced = known.join(names, FILE_NAME, "left_semi").groupBy("segment").count().collect()  # one row per touched run
    touched = [row.segment for row in replaced]

    if large:
        balls = pieces.staged_pieces(spark, large, max(sizes.values()))
        odd = pieces.without_frame(balls)
        small, framed = small + odd, pieces.framed_documents(balls)
    documents = bad = 0
    good, texts = [], [spark.createDataFrame([], "src_file_path string, piece int, text string")]
    if small:
        seen = Observation()
        unreadable = F.col(CORRUPT).isNotNull()
        parsed = read_files(spark, small).observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(unreadable).alias("bad"))
        staged = settled(parsed, "parsed")
        documents, bad = seen.get["documents"], seen.get["bad"]
        good.append(staged.where(~unreadable).drop(CORRUPT))
        texts.append(staged.where(unreadable).select("src_file_path", F.lit(0).alias("piece"), F.col(CORRUPT).alias("text")))
    if large:
        broken = [row.src_file_path for row in framed.where("bad").select("src_file_path").toLocalIterator()]
        documents, bad = documents + len(large) - len(odd), bad + len(broken)
    if bad * 100 > limit_percent * documents:
        raise TooManyBadDocuments(f"{bad} of {documents} documents cannot be read; the limit is {limit_percent} percent")

    run = uuid.uuid4().hex
    kept = f"{run}-kept"
    if large:
        good = [*map(pieces.whole_parts, good), pieces.document_parts(framed, balls)]
        texts += [pieces.file_texts(spark, broken)] if broken else []
    good = reduce(DataFrame.union, good)
    named = lambda rows: rows.withColumn(FILE_NAME, name(F.col("src_file_path")))
    new = {part: named(layer(good)) for part, layer in layers.items()}
    new[QUARANTINE] = named(reduce(DataFrame.union, texts)).select("src_file_path", FILE_NAME, F.col("text").alias("record"), "piece")
    new[FILES] = arrived.select(FILE_NAME, "file_size", "modified_time", F.current_timestamp().alias("ingested_ts"), F.lit(run).alias("segment"))
    parts = {}
    for part, rows in new.items():
        listed = before.parts.get(part, [])
        hit = [s for s in listed if s in touched]
        parts[part] = [s for s in listed if s not in touched]
        if hit:
            held = versions.read_part(spark, store, part, version=versions.Version(parts={part: hit}))
            rest = held.join(names, FILE_NAME, "left_anti").select(*held.columns)
            rest = rest.withColumn("segment", F.lit(kept)) if part == FILES else rest
            parts[part].append(versions.write_segment(rest, store, part, kept))
        parts[part].append(versions.write_segment(rows, store, part, run))
    version = versions.commit(spark, store, parts, before)
    return Ingested(version, len(sizes), sum(row["count"] for row in replaced), documents - bad, bad)
