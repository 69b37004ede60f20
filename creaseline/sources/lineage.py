"""Where a row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.keys import base_name, record_hash


def with_source_path(df: DataFrame) -> DataFrame:
    """Tag each row of a file scan with the path of its file, as it is written (the scan gives it as a URI)."""
    return df.withColumn("src_file_path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def with_lineage(df: DataFrame, payload: Column, path_col: str = "src_file_path") -> DataFrame:
    """File name, ingest time and record hash next to the source path."""
    return df.withColumns(
        {
            "src_file_name": base_name(F.col(path_col)),
            "src_ingest_ts": F.current_timestamp(),
            "src_record_hash": record_hash(payload),
        }
    )


def with_rollup_lineage(df: DataFrame, source: str, hashed: list[str]) -> DataFrame:
    """Lineage of an aggregated row: a constant source and a hash over its values."""
    return df.withColumns(
        {
            "src_file_path": F.lit(source),
            "src_file_name": F.lit(source),
            "src_ingest_ts": F.current_timestamp(),
            "src_record_hash": F.sha1(F.concat_ws("|", *(F.col(c).cast("string") for c in hashed))),
        }
    )
