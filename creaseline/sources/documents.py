"""Scans of raw match documents and register files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creaseline.functions.keys import base_name
from creaseline.sources.lineage import with_source_path
from creaseline.sources.schemas import MATCH_DOCUMENT

CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Name, size and change time of the files in a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            "path",
            base_name(F.col("path")).alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified_time"),
        )
    )


def read_documents(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.json",
    first: int | None = None,
    schema: StructType = MATCH_DOCUMENT,
    keep_malformed: bool = False,
    multiline: bool = True,
    modified_after: str | None = None,
) -> DataFrame:
    """One row per document, tagged with the path of its file.

    A file holds one document over many lines, or one per line without ``multiline``.
    ``first`` reads only that many files in path order: the paths are ranked by
    Spark, that many come to the driver, and no other file is opened. An empty
    folder is an error. Unreadable documents are left out; ``keep_malformed``
    keeps them, in a column of their own, for :func:`quality.quarantine_split`.
    ``modified_after``, a time in the session's zone, leaves out the files that are not younger.
    """
    if first is not None and first < 1:
        raise ValueError("first must be at least 1")
    files = list_files(spark, folder, pattern).select("path")
    wanted = [row.path for row in (files.limit(1) if first is None else files.orderBy("path").limit(first)).collect()]
    if not wanted:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    source = folder if first is None else wanted
    if not keep_malformed:
        return with_source_path(reader.schema(schema).option("multiLine", multiline).option("mode", "DROPMALFORMED").json(source))
    return parsed_texts(with_source_path(reader.text(source, wholetext=multiline)), schema)


def parsed_texts(bodies: DataFrame, schema: StructType = MATCH_DOCUMENT) -> DataFrame:
    """Document texts (column ``value``) parsed; the text of an unreadable or empty one is kept whole."""
    parsed = bodies.select("value", lenient_json(F.col("value"), schema).alias("parsed"), "src_file_path")
    unreadable = F.coalesce(F.col(f"parsed.{CORRUPT}"), F.when(F.col("parsed").isNull() | (F.trim("value") == ""), F.col("value")))
    fields = [F.col(f"parsed.{name}").alias(name) for name in schema.fieldNames()]
    return parsed.select(*fields, unreadable.alias(CORRUPT), "src_file_path")


def read_files(spark: SparkSession, paths: Sequence[str], schema: StructType = MATCH_DOCUMENT) -> DataFrame:
    """The documents of the given files, one each, unreadable ones kept in a column of their own."""
    return parsed_texts(with_source_path(spark.read.text(literal_paths(paths), wholetext=True)), schema)


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Paths in which nothing is a pattern."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths]


def lenient_json(body: Column, schema: StructType) -> Column:
    """JSON text as a struct whose last field holds the text when it is malformed."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return F.from_json(body, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def read_register(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A register file: CSV with header, all columns text."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_document_files(documents: DataFrame, path: str, folder_key: str | None = None) -> str:
    """Write every document to a file of its own, indented over many lines and compressed (``*.txt.gz``).

    Files are written where their documents are: deal these beforehand, in small parts. With
    ``folder_key`` each file lies in a folder named after that column, and replaces what that
    folder held.

    Documents may come as texts in pieces, column ``value``, which are written one after the other: those of a
    ``folder_key`` lie in one partition, sorted by it, in their order. No task then holds a whole document.
    """
    if "value" in documents.columns:
        pieces = documents.select("value", folder_key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        pieces.partitionBy(folder_key).text(path, compression="gzip")
        return path
    body = F.to_json(F.struct("info", "innings"), {"pretty": "true"}).alias("value")
    mode, one = ("overwrite", {"partitionOverwriteMode": "dynamic"}) if folder_key else ("append", {"maxRecordsPerFile": 1})
    if not folder_key:  # a folder per task: a task without documents then leaves no file, which even compressed nothing would
        folder_key = "task"
        documents = documents.withColumn(folder_key, F.spark_partition_id())
    # sorted as documents, so that their longer texts need not be
    writer = documents.sortWithinPartitions(folder_key).select(body, folder_key).write.mode(mode).options(**one)
    writer.partitionBy(folder_key).text(path, compression="gzip")
    return path


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files the manifest does not hold with the same name, size and change time."""
    return files.join(manifest, ["file_name", "file_size", "modified_time"], "left_anti")


def read_new_documents(spark: SparkSession, folder: str, manifest: DataFrame, pattern: str = "*.json", **options) -> tuple[DataFrame, DataFrame]:
    """The documents of files that the manifest does not hold, and these files.

    Files older than the oldest new one are not opened; of the rest, those that the
    manifest holds are left out by their paths.
    """
    new = new_files(list_files(spark, folder, pattern), manifest)
    just_before = F.min("modified_time") - F.expr("INTERVAL 1 SECOND")
    after = new.agg(F.date_format(just_before, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    documents = read_documents(spark, folder, pattern, modified_after=after, **options)
    plain = lambda path: F.regexp_replace(path, ":/+", ":/")  # noqa: E731  both forms of a local path
    paths = new.select(plain("path").alias("path"))
    return documents.join(paths, plain("src_file_path") == F.col("path"), "left_semi"), new


def manifest_rows(files: DataFrame) -> DataFrame:
    """Manifest lines for files that have been taken in."""
    return files.select("file_name", "file_size", "modified_time", F.current_timestamp().alias("ingested_ts"))
