"""Scalar functions of the document engine, as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: an image link of markdown.
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often and however deep in lambdas body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode blanks included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def approx_tokens(text: Column, chars_per_token: int = 4) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / chars_per_token).cast("int"))


def image_refs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(IMAGE), F.lit(2))


def page_of(refs: Column, position: Column, chars_per_page: int = 3000) -> Column:
    """Page named by the first image path that names one, else an estimate from the character position."""
    named = F.get(F.filter(refs, lambda r: r.rlike(r"(?i)page\d+")), F.lit(0))
    estimate = F.greatest(F.lit(1), F.floor(position / chars_per_page).cast("int") + 1)
    return F.coalesce(F.regexp_extract(named, r"(?i)page(\d+)", 1).cast("int"), estimate)


def heading_text(line: Column) -> Column:
    return strip(F.regexp_replace(line, r"(?U)^#+\s*", ""))


def is_table_caption(text: Column) -> Column:
    return text.rlike(r"(?i)^Table\s+\d+[.:]")


def fix_wrapped(text: Column) -> Column:
    """Joins the lines of a cell: glued where a word or an address was broken, else by a blank."""
    text = F.coalesce(text, F.lit(""))

    def join(done, part):
        glue = (
            F.when((done == "") | (part == ""), False)
            .when(done.rlike("[_@]"), True)
            .when(done.rlike("(?U)\\d$") & part.rlike("(?U)^\\w"), True)
            .when(part.rlike("^\\p{Ll}") & (F.length(done) + F.length(part) <= 8), True)
            .otherwise(False)
        )
        return F.when(glue, F.concat(done, part)).otherwise(F.concat(done, F.lit(" "), part))

    fold = lambda parts: F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), F.get(parts, F.lit(0)), join)
    folded = let(F.transform(F.split(text, "\n"), lambda p: strip(p)), fold)
    return F.trim(F.when(text.contains("\n"), folded).otherwise(strip(text)))


def clean_cell(text: Column) -> Column:
    return F.trim(F.regexp_replace(fix_wrapped(text), r"\s+", " "))


def table_row(line: Column) -> Column:
    """Cells of a pipe row: outer bars stripped, cells trimmed, no escapes."""
    inner = F.regexp_replace(F.trim(line), r"^\|+|\|+$", "")  # cells can be empty, so only the ends lose their bars
    return F.transform(F.split(inner, r"\|"), lambda c: F.trim(c))


def overlap_ratio(top_a: Column, bottom_a: Column, top_b: Column, bottom_b: Column) -> Column:
    """Vertical intersection over union; 0 for an empty union."""
    shared = F.greatest(F.lit(0.0), F.least(bottom_a, bottom_b) - F.greatest(top_a, top_b))
    return F.coalesce(F.try_divide(shared, F.greatest(bottom_a, bottom_b) - F.least(top_a, top_b)), F.lit(0.0))


def headers_similar(a: Column, b: Column, share: float = 0.6) -> Column:
    """Equal numbers of columns, and enough equal headers in place, without regard to case."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (F.lower(F.trim(x)) == F.lower(F.trim(y))).cast("int")), F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0)))
    return (F.size(a) == F.size(b)) & (F.size(a) > 0) & (same >= share * F.size(a))


def upper_median(values: Column) -> Column:
    return F.element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


#: Fixed value: a cell that reads as a number.
NUMBER = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def render_table(header: Column, rows: Column) -> Column:
    """Pipe table. A column is two characters wider than its name, or as wide as its widest cell.

    Columns of numbers are aligned to the right, at their points; all others, with or without some numbers, to the left.
    """
    cell = lambda r, i: F.coalesce(F.get(r, i), F.lit(""))
    behind = lambda c: F.when(c.contains("."), F.length(F.substring_index(c, ".", -1))).otherwise(-1)

    def shape(i):
        def of(cells):
            right = (F.size(cells) > 0) & F.forall(cells, lambda c: c.rlike(NUMBER))
            places = F.when(right, F.array_max(F.transform(cells, behind))).otherwise(-1)
            wide = lambda c: F.length(c) + F.when(right, places - behind(c)).otherwise(0)
            widest = F.coalesce(F.array_max(F.transform(cells, wide)), F.lit(0))
            return F.struct(F.greatest(F.length(cell(header, i)) + 2, widest).alias("w"), right.alias("right"), places.alias("places"))

        return let(F.transform(rows, lambda r: cell(r, i)), of)

    def drawn(shapes):
        def line(cells, named=False):
            def put(s, i):
                c = cell(cells, i)
                padded = c if named else F.concat(c, F.repeat(F.lit(" "), s["places"] - behind(c)))
                return F.when(s["right"], F.lpad(padded, s["w"], " ")).otherwise(F.rpad(c, s["w"], " "))

            return F.concat(F.lit("| "), F.array_join(F.transform(shapes, put), " | "), F.lit(" |"))

        dashes = lambda s: F.repeat(F.lit("-"), s["w"] + 1)
        rule = F.transform(shapes, lambda s: F.when(s["right"], F.concat(dashes(s), F.lit(":"))).otherwise(F.concat(F.lit(":"), dashes(s))))
        body = F.transform(rows, lambda r: line(r))
        return F.array_join(F.concat(F.array(line(header, True), F.concat(F.lit("|"), F.array_join(rule, "|"), F.lit("|"))), body), "\n")

    return let(F.transform(F.sequence(F.lit(0), F.size(header) - 1), shape), drawn)


def figure_markdown(path: Column, caption: Column, page: Column) -> Column:
    """Image link with the figure's label as text, and the caption in italics below."""
    label = F.regexp_extract(caption, r"(?i)^(fig(?:ure)?\s*\d+)", 1)
    alt = F.when(F.coalesce(label, F.lit("")) != "", label).otherwise(F.concat(F.lit("Figure (page "), page.cast("string"), F.lit(")")))
    below = F.when(F.coalesce(caption, F.lit("")) != "", F.concat(F.lit("\n*"), caption, F.lit("*"))).otherwise("")
    return F.concat(F.lit("!["), alt, F.lit("]("), path, F.lit(")"), below)
