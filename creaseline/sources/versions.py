"""Tables whose contents change as a whole, one version after the other.

A versioned table is a folder. Its rows lie in segments, folders that are written once and
never changed; a version is a small file that lists the segments of each part of the table,
and the highest version is the table. A writer first writes its segments, which no reader
sees, and then adds the next version. A reader resolves a version once and keeps reading its
segments, whatever is committed meanwhile: at no moment is there no table or half of one.

Two writers that start from one version cannot both commit: the second finds its version
taken and fails, and has changed nothing. Old versions, and segments that only they list, stay until
:func:`expire` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROWS = "rows"  # the part of a table that has only one
VERSIONS = "_versions"  # Spark's readers skip names with an underscore
SEGMENTS = "_segments"


class VersionTaken(RuntimeError):
    """Another writer has committed since the version this one started from."""


@dataclass(frozen=True)
class Version:
    """Segments of each part; number 0 is the empty table before the first version."""

    number: int = 0
    parts: Mapping[str, Sequence[str]] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """Hadoop's path and file system of a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _child(spark: SparkSession, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(names))


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Committed versions that have not expired, ascending."""
    folder, files = _files(spark, f"{path}/{VERSIONS}")
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(int(name) for name in names if name.isdigit())


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version by number, the latest by default; None where there is none."""
    known = version_numbers(spark, path)
    if not known or (number is not None and number not in known):
        return None
    number = known[-1] if number is None else number
    target, files = _files(spark, f"{path}/{VERSIONS}/{number:020d}")
    stream = files.open(target)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return Version(number, json.loads(text))


def latest(spark: SparkSession, path: str) -> Version:
    return read_version(spark, path) or Version()


def is_versioned(spark: SparkSession, path: str) -> bool:
    folder, files = _files(spark, f"{path}/{VERSIONS}")
    return files.exists(folder)


def segment_path(path: str, name: str, part: str = ROWS) -> str:
    return f"{path}/{SEGMENTS}/{part}/{name}"


def read_part(
    spark: SparkSession, path: str, part: str = ROWS, fmt: str = "parquet", schema: StructType | None = None, version: Version | None = None
) -> DataFrame:
    """The rows of a part in one version, the latest by default.

    A part without segments needs the schema, and has no rows.
    """
    version = version or latest(spark, path)
    folders = [segment_path(path, name, part) for name in version.parts.get(part, ())]
    if not folders:
        if schema is None:
            raise ValueError(f"{path} has no part {part!r} in version {version.number}, and no schema is given")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(folders)


def write_segment(
    df: DataFrame, path: str, part: str = ROWS, name: str | None = None, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Write rows that no version lists yet; the segment's name, a new one by default, is returned."""
    name = name or uuid.uuid4().hex
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("errorifexists").format(fmt).partitionBy(*partition_by).save(segment_path(path, name, part))
    return name


def commit(spark: SparkSession, path: str, parts: Mapping[str, Sequence[str]], after: Version) -> Version:
    """Add the version that follows ``after``.

    The list is written aside and then renamed to its number, which fails if that number
    exists, so a version is seen whole or not at all.
    """
    new = Version(after.number + 1, {part: list(names) for part, names in parts.items()})
    target = _child(spark, path, VERSIONS, f"{new.number:020d}")
    aside = _child(spark, path, VERSIONS, f"_{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if version_numbers(spark, path)[-1:] > [after.number]:
        raise VersionTaken(f"version {new.number} of {path} exists")
    stream = files.create(aside, False)
    stream.write(bytearray(json.dumps(dict(new.parts)).encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    keep = getattr(hadoop, "Options$Rename")
    choice = spark._sc._gateway.new_array(keep, 1)
    choice[0] = keep.NONE
    try:
        hadoop.FileContext.getFileContext(files.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, choice)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise VersionTaken(f"version {new.number} of {path} exists") from error
        raise
    return new


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions, and the segments that only those listed.

    Segments that no version lists may be another writer's, and stay.
    """
    if keep < 1:
        raise ValueError("the latest version is always kept")
    known = version_numbers(spark, path)
    old, kept = known[:-keep], known[-keep:]
    listed = lambda numbers: {
        (part, s) for n in numbers for part, names in read_version(spark, path, n).parts.items() for s in names
    }
    gone = listed(old) - listed(kept)
    _, files = _files(spark, path)
    for number in old:
        files.delete(_child(spark, path, VERSIONS, f"{number:020d}"), False)
    for part, name in gone:
        files.delete(_child(spark, segment_path(path, name, part)), True)
    return old
