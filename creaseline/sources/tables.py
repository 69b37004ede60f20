"""Layer tables: reading, writing, replacement by versions, export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from creaseline.sources import versions


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Scan a table by format name, a versioned one in its latest version.

    Give the schema of partitioned tables: it keeps season labels text, which
    Spark would otherwise read from folder names as numbers.
    """
    if versions.is_versioned(spark, path):
        return versions.read_part(spark, path, fmt=fmt, schema=schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame | None:
    """The table, or None when it was never written (an optional dimension)."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if _missing(error):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or no rows of the given schema when it was never written."""
    found = read_or_none(spark, path, fmt, schema)
    return spark.createDataFrame([], schema) if found is None else found


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    touched_partitions_only: bool = False,
) -> str:
    """Write a table, rows of one partition value kept together.

    The rebalance hint lets adaptive execution cut a season that outgrows one
    file and merge those that do not, so no season depends on a single task.
    With ``touched_partitions_only`` an overwrite leaves other partitions alone.
    """
    if versions.is_versioned(df.sparkSession, path):
        raise ValueError(f"{path} has versions; replace_table adds the next one")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt).partitionBy(*partition_by)
    if touched_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Write a table in ``buckets`` parts by the hash of a key, each sorted by it, and read it back.

    Tables of one key and number of buckets join and aggregate on the key without a shuffle.
    The catalogue knows the table by its name, its files lie at ``path``. The rows are dealt by the
    key first, so a bucket is one file; ``dealt`` tells that they are already, in so many parts.
    """
    writer = (df if dealt else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key).option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Give a table new contents, which ``df`` may compute from the old ones.

    The rows become the table's next version. Readers of the old version finish on it, new
    ones see the new version, and a second writer that started from the same version fails.
    A plain table becomes versioned by its first replacement; its old files stay beside it.
    """
    spark = df.sparkSession
    before = versions.latest(spark, path)
    segment = versions.write_segment(df, path, fmt=fmt, partition_by=partition_by)
    versions.commit(spark, path, {versions.ROWS: [segment]}, before)
    return path


def export_csv(df: DataFrame, path: str, n: int, *order: str) -> str:
    """Write the first ``n`` rows in order as CSV with a header."""
    df.orderBy(*order).limit(n).write.option("header", True).csv(path)
    return path


def table_size(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def files_per_layout(df: DataFrame, path: str, widths: Sequence[int]) -> DataFrame:
    """Write the rows once per partition count and count the files each time."""
    spark = df.sparkSession
    found = None
    for width in widths:
        target = f"{path}/n{width}"
        df.repartition(width).write.parquet(target)
        counted = (
            spark.read.schema(df.schema)
            .parquet(target)
            .select(F.col("_metadata.file_name").alias("file"))
            .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows"))
            .select(F.lit(width).alias("partitions"), "files", "rows")
        )
        found = counted if found is None else found.union(counted)
    return found
