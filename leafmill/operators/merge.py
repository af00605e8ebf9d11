"""Rewriting of a document's markdown: tables, page marks, images and captions.

All operators take md(doc_id, text) and work on lines or ordinals, so that no offset moves under another edit. Texts are
read with universal newlines: positions count, and results have, one \\n for each line break. A document with a null text
stays, with a null text; one without anything to insert or drop stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import figure_markdown
from leafmill.operators.lines import TABLE_ROW, explode_lines, newlines
from leafmill.operators.tables import SEPARATOR

#: The image placeholder, page marks and how a figure caption begins.
PLACEHOLDER = "<!-- image -->"
PAGE_MARK = r"<!--\s*[Pp]age\s+(\d+)\s*-->|^\*[Pp]age\s+(\d+)\*"
CAPTION_LINE = r"(?i)^(?:fig(?:ure)?[\s:.]|figure\s*:)"


def markdown_tables(md: DataFrame) -> DataFrame:
    """(doc_id, table_no, start, end, table): runs of pipe lines whose second line is a separator."""
    order = Window.partitionBy("doc_id").orderBy("ln")
    lines = explode_lines(md).withColumn("row", F.col("line").rlike(TABLE_ROW))
    lines = lines.withColumn("run", F.sum(F.when(F.col("row"), 0).otherwise(1)).over(order)).where("row")
    parts = F.array_sort(F.collect_list(F.struct("ln", "line")))
    runs = lines.groupBy("doc_id", "run").agg(parts.alias("rows"), F.min("char_start").alias("start"), F.max("char_end").alias("end"))
    runs = runs.where(F.get("rows", F.lit(1))["line"].rlike(SEPARATOR))
    no = (F.row_number().over(Window.partitionBy("doc_id").orderBy("run")) - 1).alias("table_no")
    return runs.select("doc_id", no, "start", "end", F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("table"))


def page_marks(md: DataFrame) -> DataFrame:
    """(doc_id, page, pos): where pages begin; page 1 at 0 in documents without marks."""
    lines = explode_lines(md)
    page = F.coalesce(F.nullif(F.regexp_extract("line", PAGE_MARK, 1), F.lit("")), F.nullif(F.regexp_extract("line", PAGE_MARK, 2), F.lit("")))
    found = lines.select("doc_id", page.cast("int").alias("page"), F.col("char_start").alias("pos")).where("page is not null")
    return md.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("pos", F.lit(0)).alias("pos"))


def insert_positions(md: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, page, pos): after the last table of each wanted page (doc_id, page), or at the page's end.

    A page that has no mark lies at the end of the document.
    """
    total = md.select("doc_id", F.length(newlines(F.col("text"))).alias("total"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    pages = page_marks(md).join(total, "doc_id").withColumn("stop", F.coalesce(F.lead("pos").over(order), F.col("total")))
    pages = pages.groupBy("doc_id", "page").agg(F.min("pos").alias("pos"), F.min_by("stop", "pos").alias("stop"))
    tables = markdown_tables(md).select("doc_id", F.col("start").alias("t_start"), F.col("end").alias("t_end"))
    placed = wanted.select("doc_id", "page").distinct().join(pages, ["doc_id", "page"], "left").join(total, "doc_id")
    inside = placed.join(tables, "doc_id", "left")
    last = F.max(F.when((F.col("t_start") >= F.col("pos")) & (F.col("t_end") <= F.col("stop")), F.col("t_end")))
    return inside.groupBy("doc_id", "page").agg(F.coalesce(last, F.first("stop"), F.first("total")).alias("pos"))


def inject_images(md: DataFrame, images: DataFrame) -> DataFrame:
    """md with the n-th placeholder replaced by the n-th image (doc_id, page, top, path, caption), by page and top.

    Placeholders beyond the images stay; images beyond the placeholders go to the end, in order.
    """
    link = figure_markdown(F.col("path"), F.col("caption"), F.col("page"))
    links = images.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "top", "path", link.alias("md")))), lambda i: i["md"]).alias("links"))
    joined = md.join(links, "doc_id", "left").withColumn("links", F.coalesce("links", F.array().cast("array<string>")))
    parts = F.split("text", PLACEHOLDER)
    holes = F.size("parts") - 1
    filled = F.transform("parts", lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.coalesce(F.get("links", i - 1), F.lit(PLACEHOLDER)), p)))
    rest = F.when(F.size("links") > holes, F.concat(F.lit("\n\n"), F.array_join(F.slice("links", holes + 1, F.size("links")), "\n\n"), F.lit("\n\n"))).otherwise("")
    return joined.withColumn("parts", parts).select("doc_id", F.concat(F.array_join(filled, ""), rest).alias("text"))


def _spliced(md: DataFrame, pieces: DataFrame) -> DataFrame:
    """md with each piece (doc_id, start, end, rank, insert) put in place of the characters from start to end."""
    cuts = F.array_sort(F.collect_list(F.struct("start", "rank", "end", "insert"))).alias("cuts")
    joined = md.select("doc_id", newlines(F.col("text")).alias("text")).join(pieces.groupBy("doc_id").agg(cuts), "doc_id", "left")
    after = lambda i: F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))
    kept = lambda start, stop: F.col("text").substr(start + 1, stop - start)
    parts = F.transform("cuts", lambda c, i: F.concat(kept(after(i), c["start"]), c["insert"]))
    whole = F.concat(F.array_join(parts, ""), kept(after(F.size("cuts")), F.length("text")))
    return joined.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(whole).alias("text"))


def inject_tables(md: DataFrame, tables: DataFrame) -> DataFrame:
    """md with tables (doc_id, page, top, markdown) put at insert_positions, in order of page and top.

    All positions refer to the text before any edit, so tables of one position follow each other.
    """
    placed = tables.join(insert_positions(md, tables), ["doc_id", "page"])
    insert = F.concat(F.lit("\n\n"), "markdown", F.lit("\n\n")).alias("insert")
    return _spliced(md, placed.select("doc_id", F.col("pos").alias("start"), F.col("pos").alias("end"), F.struct("page", "top").alias("rank"), insert))


def replace_tables(md: DataFrame, replacements: DataFrame) -> DataFrame:
    """md with its table_no-th table replaced, for replacements (doc_id, table_no, markdown); edits don't move each other."""
    found = markdown_tables(md).join(replacements, ["doc_id", "table_no"])
    return _spliced(md, found.select("doc_id", "start", "end", F.col("table_no").alias("rank"), F.concat("markdown", F.lit("\n")).alias("insert")))


def drop_plain_captions(md: DataFrame) -> DataFrame:
    """md without paragraphs that begin as a figure caption and stand right before or after an image placeholder."""
    lines = explode_lines(md)
    order = Window.partitionBy("doc_id").orderBy("ln")
    blank = F.trim("line") == ""
    lines = lines.withColumn("blank", blank).withColumn("fresh", F.when(blank | F.coalesce(F.lag(blank).over(order), F.lit(True)), 1).otherwise(0))
    lines = lines.withColumn("para", F.sum("fresh").over(order))
    paras = lines.groupBy("doc_id", "para").agg(F.min_by("line", "ln").alias("first"), F.max("blank").alias("blank"), F.min("ln").alias("ln"), F.max("ln").alias("last"))
    solid = Window.partitionBy("doc_id").orderBy("ln")
    words = paras.where("not blank")
    is_hole = F.trim("first") == PLACEHOLDER
    near = F.coalesce(F.lag(is_hole).over(solid) & (F.col("ln") - F.lag("last").over(solid) == 2), F.lit(False)) | F.coalesce(
        F.lead(is_hole).over(solid) & (F.lead("ln").over(solid) - F.col("last") == 2), F.lit(False)
    )
    gone = words.withColumn("gone", near & F.col("first").rlike(CAPTION_LINE)).where("gone").select("doc_id", "para")
    kept = lines.join(gone, ["doc_id", "para"], "left_anti")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda s: s["line"]), "\n")
    return kept.groupBy("doc_id").agg(text.alias("text")).union(md.where("text is null").select("doc_id", "text"))


def drop_repeated_captions(md: DataFrame, images: DataFrame) -> DataFrame:
    """md without paragraphs that repeat an injected image's caption word for word."""
    captions = images.where("caption <> ''").groupBy("doc_id").agg(F.array_sort(F.collect_set("caption")).alias("captions"))
    joined = md.join(captions, "doc_id", "left")
    text = F.aggregate("captions", F.col("text"), lambda t, c: F.replace(t, F.concat(F.lit("\n\n"), c, F.lit("\n\n")), F.lit("\n\n")))
    return joined.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))
