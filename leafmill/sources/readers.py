"""Readers of documents, and the registry of layout engines that can be plugged in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import strip

#: Relations of a page layout, with their columns.
RELATIONS = {
    "md": "doc_id string, source_file string, text string",
    "words": "doc_id string, page int, word_id bigint, text string, x0 double, x1 double, top double, bottom double",
    "raw_tables": "doc_id string, page int, tbl_ord int, top double, bottom double, rows array<array<string>>",
    "layout_tables": "doc_id string, page int, id bigint, top double, bottom double, markdown string, n_cols int",
    "raster_images": "doc_id string, page int, xref bigint, ord bigint, rects array<struct<x0:double,y0:double,x1:double,y1:double>>, ext string, width int, height int, has_bytes boolean",
    "graphics": "doc_id string, page int, obj_id bigint, top double, bottom double, x0 double, x1 double",
    "text_blocks": "doc_id string, page int, cap_id bigint, top double, bottom double, x0 double, x1 double, text string",
    "page_dims": "doc_id string, page int, width double, height double",
}

LAYOUTS: dict[str, Callable[[SparkSession, str], dict[str, DataFrame]]] = {}


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """md(doc_id, source_file, text): one row for each file; doc_id and source_file are the file name without its ending."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("name"))
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    return files.select(stem.alias("doc_id"), stem.alias("source_file"), "text")


def read_html(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """md(doc_id, text) of pages (page_id, html): headings, list items and paragraphs as markdown lines (an extension)."""
    html = F.regexp_replace("html", r"(?is)<!--.*?-->|<(script|style|nav|footer|head|aside)\b.*?</\1\s*>", " ")
    html = F.regexp_replace(html, r"\s+", " ")
    for k in range(1, 7):
        html = F.regexp_replace(html, rf"(?i)<h{k}\b[^>]*>", "\n" + "#" * k + " ")
    html = F.regexp_replace(html, r"(?i)<li\b[^>]*>", "\n- ")
    html = F.regexp_replace(html, r"(?i)</?(?:p|div|article|section|ul|ol|h[1-6]|li|tr|table|blockquote)\b[^>]*>", "\n")
    html = F.regexp_replace(html, r"<[^>]*>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        html = F.replace(html, F.lit(name), F.lit(char))
    return pages.select(F.col("page_id").alias("doc_id"), strip(F.regexp_replace(html, r"\n\s*\n*", "\n")).alias("text"))


def register_layout(name: str, reader: Callable[[SparkSession, str], dict[str, DataFrame]]) -> None:
    """Registers a layout engine: a function of (spark, path) that returns the relations it can read (words, graphics, ...)."""
    LAYOUTS[name] = reader


def read_layout(spark: SparkSession, path: str, engine: str) -> dict[str, DataFrame]:
    """Relations of the files under path. ImportError without the engine; the reader raises FileNotFoundError for no file."""
    if engine not in LAYOUTS:
        raise ImportError(f"layout engine {engine!r} is not registered; registered: {sorted(LAYOUTS)}")
    return LAYOUTS[engine](spark, path)


def stored_layout(spark: SparkSession, path: str, kind: str = "parquet") -> dict[str, DataFrame]:
    """The relations stored below path, one folder or file <relation> or <relation>.<kind> each, with the columns of RELATIONS.

    Columns are cast to their types and others are left out; a missing relation is an empty table. ValueError for a missing
    column or a type that can't be cast; malformed JSON fails when it is read. FileNotFoundError where no relation is stored.
    """
    found, missing = {}, 0
    for name, ddl in RELATIONS.items():
        wanted = spark.createDataFrame([], ddl)
        stored = _stored(spark, [f"{path}/{name}", f"{path}/{name}.{kind}"], kind)
        if stored is None:
            missing += 1
            found[name] = wanted
            continue
        absent = sorted({f.name for f in wanted.schema} - set(stored.columns))
        if absent:
            raise ValueError(f"relation {name!r} has no column {', '.join(absent)}")
        try:
            found[name] = stored.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.schema))
        except AnalysisException as problem:
            raise ValueError(f"relation {name!r}: {problem.getMessage()}") from problem
    if missing == len(RELATIONS):
        raise FileNotFoundError(f"no layout relations in {path}")
    return found


def _stored(spark: SparkSession, places: list[str], kind: str) -> DataFrame | None:
    for place in places:
        try:
            return spark.read.format(kind).option("mode", "FAILFAST").load(place)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


register_layout("parquet", lambda spark, path: stored_layout(spark, path, "parquet"))
register_layout("json", lambda spark, path: stored_layout(spark, path, "json"))


def flip(tables: DataFrame, page_dims: DataFrame, default_height: float = 842.0) -> DataFrame:
    """Tables with bottom-up y coordinates (t, b) as top-down (top, bottom); pages of unknown height count 842 points."""
    known = tables.join(page_dims.select("doc_id", "page", "height"), ["doc_id", "page"], "left").withColumn("height", F.coalesce("height", F.lit(default_height)))
    one, two = F.col("height") - F.col("t"), F.col("height") - F.col("b")
    return known.withColumn("top", F.least(one, two)).withColumn("bottom", F.greatest(one, two)).drop("height", "t", "b")
