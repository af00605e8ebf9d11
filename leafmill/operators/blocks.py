"""Typed blocks of markdown documents: islands of classified lines.

Headings, formulas and figures (with a caption line right below) stand alone; tables and lists are runs of rows or items;
everything in between is a paragraph, blank lines included. Offsets follow the flush rules of the line reader: a table or
list that an ordinary line ends is told to end after that line, and the paragraph to start there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import heading_text, image_refs, strip
from leafmill.operators.lines import HEADING, classify, explode_lines, heading_paths


def parse(md: DataFrame) -> DataFrame:
    """(doc_id, block_id, block_type, content, heading_level, image_refs, has_formula, char_start, char_end, total_chars)."""
    lines = classify(explode_lines(md))
    group = F.when(F.col("kind").isin("blank", "text"), "paragraph").when(F.col("kind") == "caption", "figure").otherwise(F.col("kind"))
    lines = lines.withColumn("block_type", group)
    order = Window.partitionBy("doc_id").orderBy("ln")
    alone = F.col("kind").isin("heading", "formula", "figure")
    changed = F.coalesce(F.lag("block_type").over(order) != F.col("block_type"), F.lit(True))
    lines = lines.withColumn("fresh", (alone | changed).cast("int"))
    lines = lines.withColumn("island", F.sum("fresh").over(order))
    islands = lines.groupBy("doc_id", "island").agg(
        F.first("block_type").alias("block_type"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda s: s["line"]), "\n").alias("content"),
        F.min("char_start").alias("start"),
        F.max("char_end").alias("stop"),
        F.min("char_end").alias("first_end"),
    )
    order = Window.partitionBy("doc_id").orderBy("island")
    before, after = F.lag("block_type").over(order), F.lead("block_type").over(order)
    drifted = (F.col("block_type") == "paragraph") & before.isin("table", "list")
    ended = (F.col("block_type").isin("table", "list") & (after == "paragraph")) | ((F.col("block_type") == "table") & (after == "list"))
    islands = islands.select(
        "doc_id",
        "island",
        "block_type",
        F.when(F.col("block_type").isin("paragraph", "table", "list"), strip(F.col("content"))).otherwise(F.col("content")).alias("content"),
        F.when(F.coalesce(drifted, F.lit(False)), F.col("first_end")).otherwise(F.col("start")).alias("char_start"),
        F.when(F.coalesce(ended, F.lit(False)), F.lead("first_end").over(order)).otherwise(F.col("stop")).alias("char_end"),
        F.max("stop").over(Window.partitionBy("doc_id")).alias("total_chars"),
    ).where("content <> ''")
    return islands.select(
        "doc_id",
        (F.row_number().over(order) - 1).alias("block_id"),
        "block_type",
        "content",
        F.when(F.col("block_type") == "heading", F.length(F.regexp_extract("content", HEADING, 1))).alias("heading_level"),
        image_refs(F.col("content")).alias("image_refs"),
        (F.col("block_type") == "formula").alias("has_formula"),
        "char_start",
        "char_end",
        "total_chars",
    )


def with_paths(blocks: DataFrame) -> DataFrame:
    """Adds heading_path (array of titles open at each block)."""
    titled = blocks.withColumn("title", F.when(F.col("block_type") == "heading", heading_text(F.col("content"))))
    return heading_paths(titled, "block_id").drop("title", "headings")


def type_counts(blocks: DataFrame) -> DataFrame:
    """Number of blocks by type, most frequent first."""
    return blocks.groupBy("block_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "block_type")
