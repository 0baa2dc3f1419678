"""Pages as they arrive: a stream of page files whose words replace what a table has of their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.export import replace_pages
from ..sources.wire import PAGE, words_of


def arriving(spark: SparkSession, path: str) -> DataFrame:
    """A stream of page documents from JSON lines in a folder, plain or gzip."""
    return spark.readStream.schema(PAGE).json(path)


def keep_words(pages: DataFrame, table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Writes the words of each batch of pages into the Parquet table, page by page; a batch that is repeated changes nothing."""

    def put(batch: DataFrame, _: int) -> None:
        replace_pages(words_of(batch.dropDuplicates(["pageNum"])), table)

    writer = pages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
