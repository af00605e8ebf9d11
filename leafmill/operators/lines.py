"""Markdown lines: positions, kinds, headings.

Input md(doc_id, text); extra columns are dropped. Null and empty texts give no lines but an empty text's single blank
line. All windows are partitioned by doc_id, so one exchange serves them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Line patterns, in order of precedence.
HEADING = r"^(#{1,6})\s+(.+)$"
FORMULA = r"^<!--\s*formula-not-decoded\s*-->"
IMAGE_LINE = r"^!\[([^\]]*)\]\(([^)]+)\)"
ITALIC = r"^\*(.+)\*$"
TABLE_ROW = r"^\|"
LIST_ITEM = r"^(\s*[-*+]|\s*\d+[.)]) "


def newlines(text: Column) -> Column:
    """text with every line break of one or two characters as one \\n; positions of this module refer to such texts."""
    return F.regexp_replace(text, "\r\n?", "\n")


def explode_lines(md: DataFrame) -> DataFrame:
    """(doc_id, ln, line, char_start, char_end); char_end counts the line's break, where one follows.

    Positions are code points of newlines(text). The text itself is cut once and not carried on to its lines.
    """
    text = F.regexp_replace(newlines(F.col("text")), "[\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n")
    lines = md.select("doc_id", F.posexplode(F.split(text, "\n")).alias("ln", "line"))
    order = Window.partitionBy("doc_id").orderBy("ln")
    start = F.coalesce(F.sum(F.length("line") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    broken = F.lead("ln").over(order).isNotNull().cast("int")
    placed = lines.select("*", start.alias("char_start"), broken.alias("broken"))
    return placed.select("doc_id", "ln", "line", "char_start", (F.col("char_start") + F.length("line") + F.col("broken")).alias("char_end"))


def classify(lines: DataFrame) -> DataFrame:
    """Adds kind: heading, formula, figure, caption (italic, right after a figure), table, list, blank or text."""
    line = F.col("line")
    first = (
        F.when(line.rlike(HEADING), "heading")
        .when(line.rlike(FORMULA), "formula")
        .when(line.rlike(IMAGE_LINE), "figure")
        .when(line.rlike(ITALIC) & ~line.rlike(LIST_ITEM), "italic")
        .when(line.rlike(TABLE_ROW), "table")
        .when(line.rlike(LIST_ITEM), "list")
        .when(line == "", "blank")
        .otherwise("text")
    )
    order = Window.partitionBy("doc_id").orderBy("ln")
    known = lines.withColumn("kind", first)
    after_figure = F.lag("kind").over(order) == "figure"
    caption = line.rlike(ITALIC) & F.coalesce(after_figure, F.lit(False)) & F.col("kind").isin("italic", "list")
    return known.withColumn("kind", F.when(caption, "caption").when(F.col("kind") == "italic", "text").otherwise(F.col("kind")))


def heading_paths(items: DataFrame, order_col: str, level: str = "heading_level", title: str = "title") -> DataFrame:
    """Adds headings (the open title of each of the six levels, or null) and heading_path (those that are open) to each row.

    Rows with null level are no headings.
    A heading of level L is open if it came after the last headings of all smaller levels.
    """
    upto = Window.partitionBy("doc_id").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.max(F.when(F.col(level) == k, F.struct(F.col(order_col).alias("at"), F.col(title).alias("title")))).over(upto) for k in range(1, 7)]
    named = items.select("*", *[x.alias(f"_h{k}") for k, x in enumerate(last, 1)])
    open_now = []
    for k in range(1, 7):
        later = [F.col(f"_h{k}.at") > F.coalesce(F.col(f"_h{j}.at"), F.lit(-1)) for j in range(1, k)]
        cond = F.col(f"_h{k}").isNotNull()
        for c in later:
            cond = cond & c
        open_now.append(F.when(cond, F.col(f"_h{k}.title")))
    named = named.withColumn("headings", F.array(*open_now)).drop(*[f"_h{k}" for k in range(1, 7)])
    return named.withColumn("heading_path", F.filter("headings", lambda t: t.isNotNull()))
