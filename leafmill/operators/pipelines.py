"""Composites: relations of a page layout to tables, figures and one markdown text, and markdown to chunks.

The relations come from a layout engine (see sources.readers.register_layout) or from stored tables:
md(doc_id, source_file, text), words, graphics, raw_tables, layout_tables, raster_images, text_blocks, page_dims. A
missing relation counts as an empty one where that makes sense. Intermediate tables that several steps read are written to
the shared folder once, so that nothing is computed twice and plans stay short.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.raster import contrast, png
from leafmill.functions.session import materialize
from leafmill.functions.text import render_table
from leafmill.operators import blocks, chunks, fenced, figures, geometry, merge, tables
from leafmill.operators.config import DEFAULT, Config

PAGE = geometry.PAGE


def bordered_tables(raw: DataFrame) -> DataFrame:
    """Logical tables of ruled raw tables, with their markdown."""
    found = tables.logical_tables(raw)
    return found.withColumn("markdown", render_table(F.col("header"), F.col("data"))).where("size(header) > 0")


def zones_of(found: DataFrame) -> DataFrame:
    """(doc_id, page, top, bottom): the segments of tables, as zones that hold no other table."""
    return found.select("doc_id", F.explode("segments").alias("s")).select("doc_id", "s.page", "s.top", "s.bottom")


def borderless_tables(words: DataFrame, zones: DataFrame | None = None, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, table_id, page, top, bottom, header, data, markdown): tables of words aligned by blanks, merged over pages."""
    free = words if zones is None else geometry.outside_zones(words, zones, cfg)
    rows = materialize(geometry.visual_rows(free, cfg), "rows")
    placed = rows.join(geometry.table_blocks(rows), [*PAGE, "row_id"])
    block = [*PAGE, "block_id"]
    spans = placed.groupBy(*block).agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.countDistinct("row_id").alias("rows"))
    need = F.when((F.col("page") > 1) & (F.col("top") < cfg.page_top), 2).otherwise(3)
    spans = spans.where(F.col("rows") >= need)
    spans = materialize(spans, "blocks")
    placed = materialize(placed.join(spans.select(*block), block, "left_semi"), "placed")
    edges = geometry.column_boundaries(placed, cfg)
    wide = edges.groupBy(*block).agg(F.count("*").alias("n")).where("n >= 2").select(*block)
    edges = materialize(edges.join(wide, block, "left_semi"), "edges")
    grids = geometry.merge_split_columns(geometry.grids(geometry.assign_columns(placed, edges, cfg), edges), cfg).where("size(edges) >= 2")
    grids = materialize(grids.withColumn("grid", geometry.merge_orphan_rows(F.col("grid"))).join(spans, block), "grids")
    width = F.size("edges")
    valid = tables.is_valid(F.col("grid"), width, cfg)
    rest = tables.is_page_top_rest(F.col("grid"), F.col("top"), F.col("page"), cfg)
    header, data = tables.grid_to_table(F.col("grid"), width)
    parts = grids.withColumn("is_cont", rest & ~valid).where(valid | rest)
    parts = parts.select("doc_id", "page", "top", "bottom", header.alias("header"), data.alias("data"), "grid", "is_cont").where("size(header) >= 2 and size(data) > 0")
    merged = tables.merge_pages(parts)
    return merged.withColumn("markdown", render_table(F.col("header"), F.col("data")))


def raster_figures(rasters: DataFrame, page_dims: DataFrame, text_blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, top, bottom, caption, path, width, height) of embedded images (doc_id, page, xref, rects, ext, width, height).

    The first occurrence of an xref on a page counts, images under the size gate or without content don't; an image
    without a rectangle covers its page.
    """
    once = F.row_number().over(Window.partitionBy(*PAGE, "xref").orderBy("ord"))
    kept = rasters.withColumn("_n", once).where(F.col("_n") == 1).where((F.col("width") >= cfg.raster_min) & (F.col("height") >= cfg.raster_min) & F.col("has_bytes"))
    kept = kept.join(page_dims.select("doc_id", "page", F.col("width").alias("page_w"), F.col("height").alias("page_h")), [*PAGE], "left")
    rect = F.get("rects", F.lit(0))
    number = F.row_number().over(Window.partitionBy(*PAGE).orderBy("ord"))
    placed = kept.select(
        "doc_id",
        "page",
        F.col("xref").cast("long").alias("obj_id"),
        F.coalesce(rect["y0"], F.lit(0.0)).alias("top"),
        F.coalesce(rect["y1"], F.col("page_h")).alias("bottom"),
        F.coalesce(rect["x0"], F.lit(0.0)).alias("x0"),
        F.coalesce(rect["x1"], F.col("page_w")).alias("x1"),
        F.concat(F.lit("images/page"), F.col("page").cast("string"), F.lit("_img"), number.cast("string"), F.lit("."), F.col("ext")).alias("path"),
        "width",
        "height",
    )
    captions = figures.caption_below(placed, text_blocks, cfg)
    return placed.join(captions, [*PAGE, "obj_id"], "left").select("doc_id", "page", "top", "bottom", "caption", "path", "width", "height")


def vector_figures(lines: DataFrame, graphics: DataFrame, page_dims: DataFrame, rasters: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, top, bottom, caption, path, width, height) of figures drawn on the page, found by their captions.

    Widths and heights are those of the crop in pixels. Captions that a raster image has are left out; numbers count
    every matched caption, also where the crop is too small to keep.
    """
    found = figures.full_captions(figures.find_captions(lines), lines, cfg).withColumnRenamed("line_id", "cap_id")
    found = materialize(figures.without_raster(found, rasters), "captions")
    clusters = materialize(geometry.clusters(graphics, cfg), "clusters")
    own = figures.match_clusters(found, clusters, cfg).join(clusters.select(*PAGE, "cluster_id", "x0", "x1"), [*PAGE, "cluster_id"])
    own = own.where((F.col("fig_bottom") - F.col("fig_top") >= cfg.figure_height) & (F.col("x1") - F.col("x0") >= cfg.figure_width))
    number = F.row_number().over(Window.partitionBy(*PAGE).orderBy("fig_bottom", "cap_id")).cast("string")
    own = materialize(own, "own-figures")
    own = own.withColumn("path", F.concat(F.lit("images/page"), F.col("page").cast("string"), F.lit("_fig"), number, F.lit(".png")))
    next_page = found.join(page_dims.select("doc_id", "page", F.col("height").alias("page_h")), [*PAGE])
    matched = own.select(*PAGE, "cap_id")
    next_page = next_page.join(matched, [*PAGE, "cap_id"], "left_anti")
    over = figures.cross_page(found, clusters, F.col("page_h"), cfg, next_page).join(clusters, [*PAGE, "cluster_id"])
    over = over.select(*PAGE, "cap_id", F.col("top").alias("fig_top"), F.col("bottom").alias("fig_bottom"), "x0", "x1", F.concat(F.lit("images/page"), F.col("page").cast("string"), F.lit("_figX.png")).alias("path"), (F.col("page") + 1).alias("cap_page"))
    own = own.select(*PAGE, "cap_id", "fig_top", "fig_bottom", "x0", "x1", "path", F.col("page").alias("cap_page"))
    both = own.unionByName(over).join(page_dims.select("doc_id", "page", F.col("width").alias("page_w"), F.col("height").alias("page_h")), [*PAGE])
    box = figures.crop_box(F.col("fig_top"), F.col("fig_bottom"), F.col("x0"), F.col("x1"), F.col("page_w"), F.col("page_h"))
    texts = found.select("doc_id", F.col("page").alias("cap_page"), "cap_id", F.col("text").alias("caption"))
    cropped = both.withColumn("box", box).where("box is not null").join(texts, ["doc_id", "cap_page", "cap_id"])
    return cropped.select("doc_id", "page", F.col("fig_top").alias("top"), F.col("fig_bottom").alias("bottom"), "caption", "path", (F.col("box.right") - F.col("box.left")).alias("width"), (F.col("box.bottom") - F.col("box.top")).alias("height"))


def render(found: DataFrame, crop: Callable[[object, int, tuple], tuple[bytes | None, float]], contrast: float = 15.0) -> DataFrame:
    """found with content: crop(doc_id, page, box) draws a region and tells its contrast; near-blank ones are dropped.

    Rows are grouped by (doc_id, page), so that a plug-in can keep the page that it rendered last.
    """
    schema = found.schema
    names = found.columns

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                content, seen = crop(row.doc_id, row.page, (row.top, row.bottom))
                if content is not None and seen >= contrast:
                    rows.append((*row, content))
            yield pd.DataFrame(rows, columns=[*names, "content"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return found.repartition(*PAGE).sortWithinPartitions(*PAGE).mapInPandas(run, f"{ddl}, content binary")


def render_crops(boxes: DataFrame, page_pixels: Callable[[object, int], np.ndarray | None], blank: float = 15.0) -> DataFrame:
    """(doc_id, page, path, content) of boxes (doc_id, page, path, box): PNG files of regions, without near-blank ones.

    page_pixels(doc_id, page) draws a page as bytes of shape (height, width[, channels]), None if it can't; box is the
    struct of figures.crop_box. Each page is drawn once for all its boxes. Rows without a box or a drawn page are left out.
    """
    kind = boxes.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held, pixels = None, None
        for batch in batches:
            kept = []
            for row in batch.to_pylist():
                if (row["doc_id"], row["page"]) != held:
                    held = (row["doc_id"], row["page"])
                    pixels = page_pixels(*held)
                box = row["box"]
                if pixels is not None and contrast(crop := pixels[box["top"] : box["bottom"], box["left"] : box["right"]]) >= blank:
                    kept.append((row["doc_id"], row["page"], row["path"], png(crop)))
            columns = list(zip(*kept, strict=True)) or [[]] * 4
            types = [*(batch.schema.field(n).type for n in ("doc_id", "page", "path")), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "page", "path", "content"])

    rows = boxes.select("doc_id", F.col("page").cast("int").alias("page"), "path", "box").where("box is not null")
    return rows.repartition(*PAGE).sortWithinPartitions(*PAGE).mapInArrow(run, f"doc_id {kind}, page int, path string, content binary")


def images(raster: DataFrame, vector: DataFrame) -> DataFrame:
    """Both kinds of images, ordered by page and top."""
    return raster.unionByName(vector).orderBy("doc_id", "page", "top", "path")


def better_tables(md: DataFrame, bordered: DataFrame, layout: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, table_no, markdown): markdown tables to replace by a bordered table that beats the layout engine's.

    A bordered table is matched with the layout table that it overlaps most; the first table of the text that looks like
    the layout table is the one to replace. If two want the same one, the first gets it.
    """
    left = bordered.select("doc_id", "page", F.col("table_id").cast("long").alias("id"), "top", "bottom")
    right = layout.select("doc_id", "page", F.col("id").cast("long").alias("id"), "top", "bottom")
    pairs = tables.match(left, right, cfg).where("match_id is not null").select("doc_id", F.col("id").alias("table_id"), "match_id")
    theirs = layout.select("doc_id", F.col("id").cast("long").alias("match_id"), F.col("markdown").alias("layout_md"), "n_cols")
    ours = bordered.select("doc_id", F.col("table_id").cast("long").alias("table_id"), "header", "data", "markdown")
    pairs = pairs.join(ours, ["doc_id", "table_id"]).join(theirs, ["doc_id", "match_id"])
    layout_header, layout_data = tables.parse_markdown(F.col("layout_md"))
    wins = tables.is_better(F.size("header"), tables.quality(F.col("header"), F.col("data")), F.col("n_cols"), tables.quality(layout_header, layout_data), cfg)
    looks = pairs.where(wins).join(merge.markdown_tables(md).select("doc_id", "table_no", "table"), "doc_id").where(tables.similar(F.col("layout_md"), F.col("table"), cfg))
    first = looks.groupBy("doc_id", "table_id").agg(F.min_by(F.struct("table_no", "markdown"), "table_no").alias("x")).select("doc_id", "table_id", "x.*")
    rank = F.row_number().over(Window.partitionBy("doc_id", "table_no").orderBy("table_id"))
    return first.withColumn("_n", rank).where("_n = 1").select("doc_id", "table_no", "markdown")


def parse_documents(md: DataFrame, bordered: DataFrame, layout: DataFrame, borderless: DataFrame, pictures: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, text, n_replaced, n_borderless, n_images): the markdown with better tables, borderless tables and images."""
    text = md.select("doc_id", "text")
    swaps = materialize(better_tables(text, bordered, layout, cfg), "swaps")
    text = materialize(merge.replace_tables(text, swaps), "text")
    text = merge.inject_tables(text, borderless.select("doc_id", "page", "top", "markdown"))
    text = merge.drop_plain_captions(materialize(text, "text"))
    text = merge.drop_repeated_captions(merge.inject_images(text, pictures), pictures)
    count = lambda df, name: df.groupBy("doc_id").agg(F.count("*").alias(name))
    for df, name in ((swaps, "n_replaced"), (borderless, "n_borderless"), (pictures, "n_images")):
        text = text.join(count(df, name), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return text


def chunk_markdown(md: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Blocks, chunks, linked captions."""
    return chunks.link_captions(chunks.assemble(blocks.parse(md), cfg), cfg)


def chunk_fenced(md: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Fenced sections, split, enriched; captions linked to tables. Numbers run without gaps afterwards."""
    found = fenced.chunk(md, cfg)
    shaped = found.select(
        "doc_id",
        F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"), F.col("content"))).alias("chunk_id"),
        "chunk_index",
        "content",
        "page_number",
        "heading_path",
        "block_type",
        "image_refs",
        "has_formula",
        "char_start",
        "char_end",
        "token_count",
    )
    return chunks.link_captions(shaped, cfg)
