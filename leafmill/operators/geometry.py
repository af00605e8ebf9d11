"""Page geometry: rows of words, blocks of rows, columns, cells, clusters of graphic objects.

Everything is keyed by (doc_id, page), so one exchange serves a chain of these operators. Gaps and islands are windows;
only rules that compare with the first word of a row are folds, over the sorted words of one page.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import upper_median
from leafmill.operators.config import DEFAULT, Config

PAGE = ("doc_id", "page")


def _anchored(words: DataFrame, key: Column, snap: float, name: str) -> DataFrame:
    """Numbers the words of each page by rows: a row begins where the key leaves the row's first key by more than snap."""
    kind = words.schema["doc_id"].dataType.simpleString()
    pages = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("x0").alias("x"), F.col("word_id").alias("w"), F.col("top").alias("t")))).alias("words"))

    def run(batches):
        for batch in batches:
            docs, pages_, ids, rows = [], [], [], []
            for doc, page, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row, anchor = -1, None
                for word in found:
                    if anchor is None or abs(word["t"] - anchor) > snap:
                        row, anchor = row + 1, word["t"]
                    ids.append(word["w"])
                    rows.append(row)
                docs += [doc] * len(found)
                pages_ += [page] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, batch.column(0).type), pa.array(pages_, pa.int32()), pa.array(ids, pa.int64()), pa.array(rows, pa.int32())], ["doc_id", "page", "word_id", name]
            )

    return pages.mapInArrow(run, f"doc_id {kind}, page int, word_id long, {name} int")


def visual_rows(words: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """words with row_id: words within row_snap of the first word of their row."""
    return words.join(_anchored(words, F.col("top"), cfg.row_snap, "row_id"), [*PAGE, "word_id"])


def visual_lines(words: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, line_id, top, bottom, x0, x1, text): lines of words, sorted by rounded top, then x0."""
    placed = words.join(_anchored(words, F.bround("top"), cfg.line_snap, "line_id"), [*PAGE, "word_id"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word_id", "text"))), lambda s: s["text"]), " ")
    return placed.groupBy(*PAGE, "line_id").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), text.alias("text"))


def row_boxes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PAGE, "row_id").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"))


def table_blocks(rows: DataFrame) -> DataFrame:
    """(doc_id, page, row_id, block_id): rows split where the gap exceeds 1.5 upper-median row heights and 12 points."""
    boxes = row_boxes(rows)
    height = upper_median(F.collect_list(F.col("bottom") - F.col("top")).over(Window.partitionBy(*PAGE)))
    order = Window.partitionBy(*PAGE).orderBy("row_id")
    gap = F.col("top") - F.lag("bottom").over(order)
    boxes = boxes.withColumn("limit", F.greatest(1.5 * height, F.lit(12.0))).withColumn("gap", gap)
    return boxes.select(*PAGE, "row_id", F.sum(F.when(F.col("gap") > F.col("limit"), 1).otherwise(0)).over(order).cast("int").alias("block_id"))


def column_boundaries(placed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, block_id, col, x): clusters of word starts that enough rows of the block share.

    placed: words with row_id and block_id.
    """
    block = (*PAGE, "block_id")
    order = Window.partitionBy(*block).orderBy("x0", "word_id")
    fresh = F.when(F.col("x0") - F.lag("x0").over(order) > cfg.column_snap, 1).otherwise(0)
    marked = placed.withColumn("fresh", fresh).withColumn("cluster", F.sum("fresh").over(order))
    clusters = marked.groupBy(*block, "cluster").agg(upper_median(F.collect_list("x0")).alias("x"))
    n_rows = placed.groupBy(*block).agg(F.countDistinct("row_id").alias("n_rows"))
    near = clusters.join(placed.select(*block, "row_id", "x0"), list(block)).where(F.abs(F.col("x0") - F.col("x")) <= cfg.column_snap)
    present = near.groupBy(*block, "cluster", "x").agg(F.countDistinct("row_id").alias("rows")).join(n_rows, list(block))
    kept = present.where(F.col("rows") / F.col("n_rows") >= cfg.column_presence)
    return kept.select(*block, (F.row_number().over(Window.partitionBy(*block).orderBy("x")) - 1).cast("int").alias("col"), "x")


def assign_columns(placed: DataFrame, boundaries: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, block_id, row_id, col, text): words at the last boundary that starts at most column_snap after them."""
    block = (*PAGE, "block_id")
    edges = boundaries.groupBy(*block).agg(F.array_sort(F.collect_list("x")).alias("edges"))
    at = F.greatest(F.size(F.filter("edges", lambda x: F.col("x0") >= x - cfg.column_snap)) - 1, F.lit(0))
    words = placed.join(edges, list(block)).withColumn("col", at.cast("int"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word_id", "text"))), lambda s: s["text"]), " ")
    return words.groupBy(*block, "row_id", "col").agg(text.alias("text"))


def grids(cells: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(doc_id, page, block_id, grid, edges): rows of cells, empty where a row has none."""
    block = (*PAGE, "block_id")
    edges = boundaries.groupBy(*block).agg(F.array_sort(F.collect_list("x")).alias("edges"))
    rows = cells.groupBy(*block, "row_id").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("by_col"))
    rows = rows.join(edges, list(block)).withColumn("row", F.transform("edges", lambda x, i: F.coalesce(F.try_element_at("by_col", i), F.lit(""))))
    grid = F.transform(F.array_sort(F.collect_list(F.struct("row_id", "row"))), lambda s: s["row"])
    return rows.groupBy(*block).agg(grid.alias("grid"), F.first("edges").alias("edges"))


def _joined(grid: list[list[str]], edges: list[float], gap: float, sparse: float):
    """Merges neighbouring columns to a fixpoint, leftmost pair first."""
    columns = [list(c) for c in zip(*grid, strict=True)]
    i = 0
    while i + 1 < len(columns):
        left, right = columns[i], columns[i + 1]
        has_left, has_right = [bool(c.strip()) for c in left], [bool(c.strip()) for c in right]
        few = min(sum(has_left), sum(has_right)) / max(1, len(grid)) < sparse
        inside = any(has_right) and all(a for a, b in zip(has_left, has_right, strict=True) if b)
        if edges[i + 1] - edges[i] <= gap and (few or inside):
            columns[i : i + 2] = [[f"{a} {b}".strip() for a, b in zip(left, right, strict=True)]]
            edges = edges[: i + 1] + edges[i + 2 :]
            i = 0
        else:
            i += 1
    return [list(r) for r in zip(*columns, strict=True)], edges


def merge_split_columns(tables: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, block_id, grid, edges) with columns joined that belong together."""
    kind = tables.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [_joined(g, e, cfg.column_merge_gap, cfg.sparse_column) if g and e else (g, e) for g, e in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.string()))), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                ["doc_id", "page", "block_id", "grid", "edges"],
            )

    return tables.select(*PAGE, "block_id", "grid", "edges").mapInArrow(run, f"doc_id {kind}, page int, block_id int, grid array<array<string>>, edges array<double>")


def merge_orphan_rows(grid: Column) -> Column:
    """A row with one filled cell goes to the row above, if that one has the cell's column filled."""

    def step(done, row):
        above = F.element_at(done, -1)
        filled = F.size(F.filter(row, lambda c: F.trim(c) != ""))
        fits = F.exists(F.zip_with(row, above, lambda c, p: (F.trim(c) != "") & (F.trim(p) != "")), lambda b: b)
        joined = F.zip_with(above, row, lambda p, c: F.when(F.trim(c) != "", F.trim(F.concat_ws(" ", p, c))).otherwise(p))
        return F.when((filled == 1) & fits, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(row)))

    return F.when(F.size(grid) < 2, grid).otherwise(F.aggregate(F.slice(grid, 2, F.greatest(F.size(grid), F.lit(1))), F.slice(grid, 1, 1), step))


def clusters(graphics: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, cluster_id, top, bottom, x0, x1): objects in top order, split where a gap opens below all before."""
    seen = graphics.where("bottom > top or x1 > x0")
    order = Window.partitionBy(*PAGE).orderBy("top", "obj_id")
    lowest = F.max("bottom").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = seen.withColumn("fresh", F.when(F.col("top") - lowest > cfg.cluster_gap, 1).otherwise(0))
    marked = marked.withColumn("cluster_id", F.sum("fresh").over(order).cast("int"))
    found = marked.groupBy(*PAGE, "cluster_id").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    return found.where((F.col("bottom") - F.col("top") >= cfg.figure_height) & (F.col("x1") - F.col("x0") >= cfg.figure_width))


def outside_zones(words: DataFrame, zones: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Words that overlap no zone (doc_id, page, top, bottom) of their page by more than zone_overlap points."""
    w, z = words.alias("w"), zones.alias("z")
    shared = F.least("w.bottom", "z.bottom") - F.greatest("w.top", "z.top")
    return w.join(z, (F.col("w.doc_id") == F.col("z.doc_id")) & (F.col("w.page") == F.col("z.page")) & (shared > cfg.zone_overlap), "left_anti")
