"""From documents to shards: quality, near duplicates, benchmark passages, source mix, sharding.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the
columns of documents; the last returns a row for each document with its shard and slot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verso.keep import drop, fresh
from verso.llm import decontaminate, jaccard_join, quality_cnn, shard_pack, source_mix
from verso.llm.shared import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; all columns stay.

    Null and empty texts are scored like any other; repeated rows stay or go together. An empty
    table stays empty; without labels nothing is rejected.
    """
    return quality_cnn.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on runs of five words stays; all columns do.

    Texts without a word, null too, are one group. Of repeated rows one stays, of a group's
    documents that of the least doc_id; null ids come last. An empty table stays empty.
    """
    return jaccard_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go; all columns stay.

    Null and empty texts have no words and stay; repeated rows stay or go together. Empty tables
    take nothing away.
    """
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; all columns stay.

    Null is a source of its own; a null text has no words, and is taken as often as its place among
    its source's documents has it. Repeated rows share their copies. An empty table stays empty.
    """
    return source_mix.mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; a row for each row of docs.

    Equal texts, null with empty, share a shard; null ids keep their rows. An empty table gives no rows.
    """
    return shard_pack.packed(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix), ("shards", shards)]

#: A trained classifier, components and packing are not for SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents; what each returns is written in the shared folder and read again.

    A stage's table is dropped once the next one is written. The last one belongs to the caller and
    goes with verso.keep.clear(spark).
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop(spark, before)
        before = path
    return docs
