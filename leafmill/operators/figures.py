"""Figures: captions on lines, captions below images, captions matched to clusters of graphics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import figure_markdown
from leafmill.operators.config import DEFAULT, Config
from leafmill.operators.geometry import PAGE

#: How a caption line begins, where one may begin inside a line, and what follows the number in a mere
#: reference, at the start of a line and inside one.
CAPTION_START = r"^(?:figure|fig\.?)\s*\d+[.:\-\s]"
CAPTION_INSIDE = r"(?:figure|fig\.?)\s*\d+[.:\-]"
REFERENCE_WORDS = "first second third show middle left right top bottom above below also see similar here note both".split()
REFERENCE_INSIDE = [*REFERENCE_WORDS, "this", r"the\s"]
PREFIX = r"(?i)^(?:fig(?:ure)?|table|chart|plot|image|photo)"


def find_captions(lines: DataFrame) -> DataFrame:
    """(doc_id, page, line_id, top, bottom, x0, text): caption lines of (doc_id, page, line_id, top, bottom, x0, text).

    A line that begins as a caption and does not go on as a reference, else the rest of a line from the first place that
    reads as one, if more than 20 characters follow there that begin neither as a reference nor with a bracket. One for
    each whole point of top, the first line wins.
    """
    text = F.trim("text")
    starts = text.rlike(f"(?i){CAPTION_START}") & ~text.rlike(rf"(?i){CAPTION_START}(?:\(|{'|'.join(REFERENCE_WORDS)})")
    inside = F.regexp_extract(text, f"(?i){CAPTION_INSIDE}.*", 0)
    rest = F.trim(F.regexp_replace(inside, f"(?i)^{CAPTION_INSIDE}", ""))
    usable = (inside != "") & (F.length(rest) > 20) & ~rest.rlike(rf"(?i)^(?:\(|{'|'.join(REFERENCE_INSIDE)})")
    found = lines.withColumn("text", F.when(starts, text).when(usable, inside)).where("text is not null")
    first = F.row_number().over(Window.partitionBy(*PAGE, F.col("top").cast("int")).orderBy("line_id"))
    return found.withColumn("_n", first).where("_n = 1").drop("_n")


def full_captions(captions: DataFrame, lines: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Captions with the lines right below appended, until one begins with a capital where no comma leads to it."""
    c, x = captions.alias("c"), lines.alias("x")
    below = (F.col("x.top") - F.col("c.bottom") > 0) & (F.col("x.top") - F.col("c.bottom") <= cfg.caption_next) & (F.col("x.x0") >= F.col("c.x0") - cfg.caption_slack)
    on = (F.col("c.doc_id") == F.col("x.doc_id")) & (F.col("c.page") == F.col("x.page")) & below
    rest = c.join(x, on, "left").groupBy("c.doc_id", "c.page", "c.line_id", "c.top", "c.bottom", "c.x0", "c.text")
    rows = rest.agg(F.array_sort(F.collect_list(F.when(F.col("x.line_id").isNotNull(), F.struct(F.col("x.top").alias("t"), F.col("x.line_id").alias("i"), F.col("x.text").alias("s"))))).alias("more"))

    def step(z, line):
        stop = z["done"] | (line["s"].rlike(r"^\p{Lu}") & ~z["s"].endswith(","))
        return F.struct(F.when(stop, z["s"]).otherwise(F.concat_ws(" ", z["s"], line["s"])).alias("s"), stop.alias("done"))

    whole = F.aggregate("more", F.struct(F.col("text").alias("s"), F.lit(False).alias("done")), step, lambda z: z["s"])
    return rows.select("doc_id", "page", "line_id", "top", "bottom", "x0", whole.alias("text"))


def caption_below(images: DataFrame, blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, obj_id, caption): the nearest text below each image (doc_id, page, obj_id, top, bottom, x0, x1); "" without."""
    i, b = images.alias("i"), blocks.alias("b")
    gap = F.col("b.top") - F.col("i.bottom")
    across = F.least("i.x1", "b.x1") - F.greatest("i.x0", "b.x0")
    named = F.col("b.text").rlike(PREFIX)
    on = (F.col("i.doc_id") == F.col("b.doc_id")) & (F.col("i.page") == F.col("b.page")) & (gap >= -2) & (gap <= cfg.caption_gap) & (across >= 10) & (named | (F.length("b.text") <= cfg.caption_chars))
    pairs = i.join(b, on, "left").select("i.doc_id", "i.page", "i.obj_id", gap.alias("gap"), (~named).alias("plain"), F.col("b.cap_id").alias("cap_id"), F.col("b.text").alias("text"))
    best = pairs.groupBy("doc_id", "page", "obj_id").agg(F.min_by("text", F.struct("gap", "plain", "cap_id")).alias("caption"))
    return best.withColumn("caption", F.coalesce("caption", F.lit("")))


def match_clusters(captions: DataFrame, clusters: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, cap_id, cluster_id, fig_top, fig_bottom): the cluster that reaches lowest among those that begin above."""
    c, g = captions.alias("c"), clusters.alias("g")
    on = (F.col("c.doc_id") == F.col("g.doc_id")) & (F.col("c.page") == F.col("g.page")) & (F.col("c.top") - F.col("g.top") >= cfg.figure_height)
    pairs = c.join(g, on).select("c.doc_id", "c.page", "c.cap_id", "g.cluster_id", F.col("g.top").alias("fig_top"), F.col("g.bottom").alias("reach"), F.col("c.top").alias("fig_bottom"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "page", "cap_id").orderBy(F.desc("reach"), "fig_top", "cluster_id"))
    return pairs.withColumn("_n", rank).where("_n = 1").drop("_n", "reach")


def cross_page(captions: DataFrame, clusters: DataFrame, heights: Column, cfg: Config = DEFAULT, candidates: DataFrame | None = None) -> DataFrame:
    """(doc_id, page, cap_id, cluster_id): captions high on a page with the largest unmatched cluster of the page before.

    heights: page height, as a column over candidates: the captions that may take a cluster, all by default. One figure
    for each page.
    """
    c, g = captions.alias("c"), clusters.alias("g")
    own = (F.col("c.doc_id") == F.col("g.doc_id")) & (F.col("c.page") == F.col("g.page")) & (F.col("c.top") - F.col("g.top") >= cfg.figure_height)
    free = g.join(c, own, "left_anti").withColumn("area", (F.col("bottom") - F.col("top")) * (F.col("x1") - F.col("x0")))
    free = free.groupBy(*PAGE).agg(F.max_by("cluster_id", F.struct("area", -F.col("cluster_id"))).alias("cluster_id"))
    high = (captions if candidates is None else candidates).where(F.col("top") <= cfg.next_page_band * heights).withColumn("before", F.col("page") - 1)
    pairs = high.alias("h").join(free.alias("f"), (F.col("h.doc_id") == F.col("f.doc_id")) & (F.col("h.before") == F.col("f.page")))
    pairs = pairs.select("h.doc_id", F.col("f.page").alias("page"), "h.cap_id", "f.cluster_id", "h.top")
    rank = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("top", "cap_id"))
    return pairs.withColumn("_n", rank).where("_n = 1").drop("_n", "top")


def without_raster(captions: DataFrame, rasters: DataFrame) -> DataFrame:
    """Captions whose first 30 characters no raster image of the page has as its caption's."""
    key = [F.col("doc_id"), F.col("page"), F.substring("text", 1, 30).alias("head")]
    seen = rasters.select("doc_id", "page", F.substring("caption", 1, 30).alias("head")).distinct()
    return captions.withColumn("head", key[2]).join(seen, ["doc_id", "page", "head"], "left_anti").drop("head")


def number_images(images: DataFrame) -> DataFrame:
    """Adds img_no (1, 2, ... on each page) and path."""
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("top", "obj_id"))
    return images.withColumn("img_no", n).withColumn("path", F.concat(F.lit("images/page"), F.col("page").cast("string"), F.lit("_fig"), F.col("img_no").cast("string"), F.lit(".png")))


def link(images: DataFrame) -> DataFrame:
    return images.withColumn("markdown", figure_markdown(F.col("path"), F.col("caption"), F.col("page")))


def crop_box(top: Column, bottom: Column, x0: Column, x1: Column, width: Column, height: Column, dpi: int = 150, pad: float = 6.0) -> Column:
    """Pixel box of a padded, clamped region; null if under 10 pixels."""
    px = lambda v, most: F.greatest(F.lit(0), F.least(most, (v * (dpi / 72.0)).cast("int")))
    w, h = (width * (dpi / 72.0)).cast("int"), (height * (dpi / 72.0)).cast("int")
    box = F.struct(px(x0 - pad, w).alias("left"), px(top - pad, h).alias("top"), px(x1 + pad, w).alias("right"), px(bottom + pad, h).alias("bottom"))
    return F.when((box["right"] - box["left"] >= 10) & (box["bottom"] - box["top"] >= 10), box)
