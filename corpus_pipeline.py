"""From raw documents to mixed, sharded training text, as stages that store their results.

Each stage reads what the one before has stored, and returns the columns of ``documents``;
the last adds where each row goes. Documents of low quality go, of near copies one stays,
documents with benchmark passages go, sources are mixed to their target weights (a document
may stand several times or in part), and every row gets a shard and a slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creaseline.llm import decontaminate, jaccard_join, mixing, quality, sharding
from creaseline.sources.workspace import settled


BATCH_ROWS = 500


def use_small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of so many rows, which bounds a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_small_batches(spark)
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_small_batches(spark)
    return jaccard_join.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_small_batches(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_small_batches(spark)
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_small_batches(spark)
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

# The quality classifier and the mix's seeded order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with jaccard_join.batches_of(spark, BATCH_ROWS):  # the session gets its own setting back
        for name, stage in STAGES:
            docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
