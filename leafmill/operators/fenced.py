"""Header sections with fenced atoms: the second chunking path.

Tables, figures and formulas are fenced by sentinels, texts are cut at headers, sections over the limit are split at the
first separator that fits, recursively, and pieces carry the headers above them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import approx_tokens, heading_text, image_refs, page_of, strip
from leafmill.operators.config import DEFAULT, Config
from leafmill.operators.lines import FORMULA, HEADING, classify, explode_lines, heading_paths

#: Sentinels around atoms, and separators in order of preference.
FENCES = {k: (f"<!-- ATOMIC:{k} -->", f"<!-- /ATOMIC:{k} -->") for k in ("table", "figure", "formula")}
SEPARATORS = [*(FENCES[k][1] for k in ("table", "figure", "formula")), "\n\n", ". ", "! ", "? ", " ", ""]


def fence_lines(md: DataFrame) -> DataFrame:
    """(doc_id, ln, fenced): runs of table rows, figures with the caption that follows (blanks between), and formulas in sentinels."""
    lines = classify(explode_lines(md))
    order = Window.partitionBy("doc_id").orderBy("ln")
    solid = F.when(F.col("line") != "", F.struct("ln", F.col("kind"), F.col("line")))
    after = F.first(solid, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    before = F.last(solid, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    italic = F.col("line").rlike(r"^\*(.+)\*$")
    lines = lines.withColumn("after", after).withColumn("before", before)
    has_caption = (F.col("kind") == "figure") & F.coalesce(F.col("after.line").rlike(r"^\*(.+)\*$"), F.lit(False))
    is_caption = italic & F.coalesce(F.col("before.kind") == "figure", F.lit(False))
    in_gap = (F.col("line") == "") & F.coalesce((F.col("before.kind") == "figure") & F.col("after.line").rlike(r"^\*(.+)\*$"), F.lit(False))
    table = F.col("kind") == "table"
    opens = table & F.coalesce(F.lag("kind").over(order) != "table", F.lit(True))
    closes = table & F.coalesce(F.lead("kind").over(order) != "table", F.lit(True))
    wrap = lambda kind, start, end: F.concat(
        F.when(start, F.lit(FENCES[kind][0] + "\n")).otherwise(""), F.col("line"), F.when(end, F.lit("\n" + FENCES[kind][1])).otherwise("")
    )
    fenced = (
        F.when(table, wrap("table", opens, closes))
        .when(F.col("kind") == "figure", wrap("figure", F.lit(True), ~has_caption))
        .when(is_caption, wrap("figure", F.lit(False), F.lit(True)))
        .when(F.col("kind") == "formula", wrap("formula", F.lit(True), F.lit(True)))
        .otherwise(F.col("line"))
    )
    return lines.withColumn("fenced", fenced).withColumn("gap", in_gap).where("not gap").select("doc_id", "ln", "fenced")


def fence(md: DataFrame) -> DataFrame:
    """(doc_id, text): texts with their atoms fenced; null texts stay null."""
    rows = fence_lines(md)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "fenced"))), lambda s: s["fenced"]), "\n")
    return rows.groupBy("doc_id").agg(text.alias("text")).union(md.where("text is null").select("doc_id", "text"))


def header_sections(md: DataFrame) -> DataFrame:
    """(doc_id, section_id, headings, content): texts cut before every header; the header stays in its section."""
    lines = explode_lines(md)
    level = F.length(F.nullif(F.regexp_extract("line", HEADING, 1), F.lit("")))
    lines = lines.withColumn("heading_level", level).withColumn("title", F.when(level.isNotNull(), heading_text(F.col("line"))))
    lines = heading_paths(lines, "ln")
    order = Window.partitionBy("doc_id").orderBy("ln")
    lines = lines.withColumn("part", F.sum(F.when(F.col("heading_level").isNotNull(), 1).otherwise(0)).over(order))
    content = strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda s: s["line"]), "\n"))
    parts = lines.groupBy("doc_id", "part").agg(content.alias("content"), F.first("headings").alias("headings")).where("content <> ''")
    n = (F.row_number().over(Window.partitionBy("doc_id").orderBy("part")) - 1).alias("section_id")
    return parts.select("doc_id", n, "headings", "content")


def split_recursively(text: str, limit: int, overlap: int, separators: list[str] = SEPARATORS) -> list[tuple[str, int]]:
    """(piece, start): pieces of at most limit characters where separators allow it, with up to overlap carried over."""
    found = next((s for s in separators if s and s in text), "")
    rest = separators[separators.index(found) + 1 :] if found else []
    if found:
        cut, at = [], 0
        while (i := text.find(found, at)) >= 0:  # a separator stays at the head of what follows it
            if i > at:
                cut.append((at, text[at:i]))
            end = text.find(found, i + len(found))
            end = len(text) if end < 0 else end
            cut.append((i, text[i:end]))
            at = end
            if end == len(text):
                break
        parts = cut
    else:
        parts = [(i, c) for i, c in enumerate(text)]
    out: list[tuple[str, int]] = []
    held: list[tuple[int, str]] = []

    def emit():
        if held:
            joined = "".join(p for _, p in held)
            piece = joined.strip()
            if piece:
                out.append((piece, held[0][0] + len(joined) - len(joined.lstrip())))

    for at, part in parts:
        if len(part) > limit and rest:
            emit()
            held = []
            out += [(p, s + at) for p, s in split_recursively(part, limit, overlap, rest)]
            continue
        if held and sum(len(p) for _, p in held) + len(part) > limit:
            emit()
            while held and (sum(len(p) for _, p in held) > overlap or sum(len(p) for _, p in held) + len(part) > limit):
                held.pop(0)
        held.append((at, part))
    emit()
    return out


def size_guard(sections: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_id, piece_id, headings, content, start): sections split to the limit; an atom alone is kept whole."""
    kind = sections.schema["doc_id"].dataType.simpleString()
    limit, overlap = cfg.max_chars, cfg.overlap_chars
    piece = pa.struct([("content", pa.string()), ("start", pa.int32())])

    def whole(text):
        return any(text.startswith(a) and text.endswith(b) and text.count(a) == 1 for a, b in FENCES.values())

    def run(batches):
        for batch in batches:
            cut = [[(t, 0)] if len(t) <= limit or whole(t) else split_recursively(t, limit, overlap) for t in batch.column(3).to_pylist()]
            rows = [[{"content": c, "start": s} for c, s in x] for x in cut]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.list_(piece))], ["doc_id", "section_id", "headings", "pieces"])

    split = sections.select("doc_id", "section_id", "headings", "content").mapInArrow(
        run, f"doc_id {kind}, section_id int, headings array<string>, pieces array<struct<content:string,start:int>>"
    )
    return split.select("doc_id", "section_id", "headings", F.posexplode("pieces").alias("piece_id", "p")).select("doc_id", "section_id", "piece_id", "headings", "p.content", "p.start")


def block_type(content: Column) -> Column:
    found = F.when(F.lit(False), "")
    for kind in ("table", "figure", "formula"):
        found = found.when(content.contains(FENCES[kind][0]), kind)
    return found.when(content.rlike(r"^(\s*[-*+]|\s*\d+[.)]) "), "list").otherwise("paragraph")


def strip_fences(content: Column) -> Column:
    for a, b in FENCES.values():
        content = F.replace(F.replace(content, F.lit(a + "\n"), F.lit("")), F.lit("\n" + b), F.lit(""))
        content = F.replace(F.replace(content, F.lit(a), F.lit("")), F.lit(b), F.lit(""))
    return strip(content)


def enrich(pieces: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Chunks of pieces: type, plain content, images, page, headings, formulas, tokens."""
    plain = pieces.withColumn("block_type", block_type(F.col("content"))).withColumn("content", strip_fences(F.col("content"))).where("content <> ''")
    refs = image_refs(F.col("content"))
    order = Window.partitionBy("doc_id").orderBy("section_id", "piece_id")
    return plain.select(
        "doc_id",
        (F.row_number().over(order) - 1).alias("chunk_index"),
        "content",
        "block_type",
        "headings",
        F.filter("headings", lambda t: t.isNotNull()).alias("heading_path"),
        refs.alias("image_refs"),
        F.col("content").rlike(FORMULA).alias("has_formula"),
        page_of(refs, F.col("start"), cfg.chars_per_page).alias("page_number"),
        F.col("start").alias("char_start"),
        (F.col("start") + F.length("content")).alias("char_end"),
        approx_tokens(F.col("content"), cfg.chars_per_token).alias("token_count"),
    )


def chunk(md: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The whole path: fence, cut at headers, split, enrich."""
    return enrich(size_guard(header_sections(fence(md)), cfg), cfg)


def store_metadata(chunks: DataFrame, source_file: Column) -> DataFrame:
    """Chunks of enrich() with what vector stores take, strings and numbers only: source_file, header_1 to header_6, breadcrumb, image_list."""
    header = [F.get("headings", F.lit(k)).alias(f"header_{k + 1}") for k in range(6)]
    lists = [F.array_join("heading_path", " > ").alias("breadcrumb"), F.array_join("image_refs", ", ").alias("image_list")]
    return chunks.select(*[c for c in chunks.columns if c not in ("headings", "heading_path", "image_refs")], source_file.alias("source_file"), *header, *lists)
