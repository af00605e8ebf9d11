"""Chunking of a stream of markdown files. Every operator is keyed by document, so each micro-batch is complete in itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators import blocks, chunks
from leafmill.operators.config import DEFAULT, Config


def markdown_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    files = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path, wholetext=True)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return files.select(stem.alias("doc_id"), stem.alias("source_file"), F.col("value").alias("text"))


def chunk_stream(md: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, cfg: Config = DEFAULT, **trigger) -> StreamingQuery:
    """Starts chunking md; sink gets the linked chunks of each micro-batch and its number."""

    def batch(df: DataFrame, number: int) -> None:
        sink(chunks.link_captions(chunks.assemble(blocks.parse(df), cfg), cfg), number)

    return md.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
