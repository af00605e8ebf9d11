"""Size-bounded chunks of blocks, with heading paths, pages, overlap and caption linking.

Headings and atoms (tables, figures, formulas) bound the runs of prose between them. A run under the limit is one chunk, by
built-in expressions alone. A longer one is cut into groups where its length reaches the limit; the cuts follow from the
lengths of its blocks, and only the tail of a piece is carried from one group to the next, in one Arrow call. No step holds
more than one run of prose.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import approx_tokens, is_table_caption, page_of
from leafmill.operators.blocks import with_paths
from leafmill.operators.config import DEFAULT, Config

_END = re.compile(r"(?<=[.!?])\s+")
ATOMIC = ("table", "figure", "formula")


def cut_points(lengths: list[int], limit: int, seams: frozenset[int] = frozenset()) -> list[int]:
    """Where packs of items of these lengths begin, each pack as long as the limit allows with a blank between items.

    A pack also begins at every seam. An item over the limit is a pack of its own.
    """
    reach = [0, *accumulate(n + 1 for n in lengths)]
    bounds = sorted({0, len(lengths)} | {s for s in seams if s < len(lengths)})
    cuts = []
    for first, end in zip(bounds, bounds[1:], strict=False):
        while first < end:
            cuts.append(first)
            first = min(end, max(first + 1, bisect_right(reach, reach[first] + limit + 1) - 1))
    return cuts


def _packed(items: list[str], limit: int, seams: frozenset[int] = frozenset()) -> list[str]:
    starts = cut_points([len(x.strip()) for x in items], limit, seams)
    packs = [items[i:j] for i, j in zip(starts, [*starts[1:], len(items)], strict=False)]
    return [" ".join(p).strip() if len(p) > 1 else p[0] for p in packs]


def pack_words(sentence: str, limit: int) -> list[str]:
    """Greedy packs of words, at most limit characters where words allow it."""
    return _packed(sentence.split(), limit)


def pack_sentences(text: str, limit: int) -> list[str]:
    """Greedy packs of sentences; one over the limit counts as words that begin a pack, and its last pack goes on."""
    items: list[str] = []
    seams = set()
    for sentence in _END.split(text):
        if len(sentence) > limit:
            seams.add(len(items))
            items += sentence.split()
        elif sentence:
            items.append(sentence)
    return _packed(items, limit, frozenset(seams)) or [text]


def _pieces(batches, limit):
    for batch in batches:
        packed = [pack_sentences(t, limit) if t is not None else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.list_(pa.string()))], ["doc_id", "pieces"])


def sentence_pieces(texts: DataFrame, limit: int = DEFAULT.max_chars) -> DataFrame:
    """(doc_id, piece_id, content): each text of (doc_id, text) in packs of sentences."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    packed = texts.select("doc_id", "text").mapInArrow(lambda b: _pieces(b, limit), f"doc_id {kind}, pieces array<string>")
    return packed.select("doc_id", F.posexplode("pieces").alias("piece_id", "content"))


def word_pieces(texts: DataFrame, limit: int = DEFAULT.max_chars) -> DataFrame:
    """(doc_id, piece_id, content): each text of (doc_id, text) in packs of words."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            packed = [pack_words(t, limit) if t is not None else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.list_(pa.string()))], ["doc_id", "pieces"])

    packed = texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, pieces array<string>")
    return packed.select("doc_id", F.posexplode("pieces").alias("piece_id", "content"))


_ROW = "pos int, piece int, content string, heading_path array<string>, block_type string, image_refs array<string>, has_formula boolean, char_start int, char_end int"
_ARROW = pa.list_(
    pa.struct(
        [("pos", pa.int32()), ("piece", pa.int32()), ("content", pa.string()), ("heading_path", pa.list_(pa.string())), ("block_type", pa.string()),
         ("image_refs", pa.list_(pa.string())), ("has_formula", pa.bool_()), ("char_start", pa.int32()), ("char_end", pa.int32())]
    )
)


def _long_run(parts: list[dict], stop: int, cfg: Config) -> list[dict]:
    """Pieces of a run that is over the limit.

    A group ends with the block that brings it to max_chars, two characters between blocks counted; its pieces begin
    with the tail of the pieces before it.
    """
    reach = [0, *accumulate(len(p["content"]) + 2 for p in parts)]
    cuts = [0]
    while cuts[-1] < len(parts):
        cuts.append(min(bisect_left(reach, reach[cuts[-1]] + cfg.max_chars + 2), len(parts)))
    out, tail = [], ""
    for i, j in zip(cuts, cuts[1:], strict=False):
        group = parts[i:j]
        whole = "\n\n".join([tail, *(p["content"] for p in group)]).strip()
        pieces = pack_sentences(whole, cfg.max_chars) if len(whole) > cfg.max_chars else [whole]
        tail = pieces[-1][-cfg.overlap_chars :] if cfg.overlap_chars else ""
        full = reach[j] - reach[i] - 2 >= cfg.max_chars
        shared = {"pos": group[0]["block_id"], "block_type": "paragraph", "has_formula": False, "heading_path": group[0]["heading_path"], "image_refs": [r for p in group for r in p["image_refs"]]}
        shared |= {"char_start": group[0]["char_start"], "char_end": group[-1]["char_end"] if full else stop}
        out += [shared | {"piece": n, "content": piece} for n, piece in enumerate(pieces)]
    return out


_ROWS = "array<struct<" + _ROW.replace(", ", ",").replace(" ", ":") + ">>"


def _run_rows(blocks: DataFrame) -> DataFrame:
    """(doc_id, parts, atom, stop, size): a run is a hard block, if any, and the prose up to the next one.

    parts are the prose blocks, size their joined length. All runs of a document come from one pass.
    """
    order = Window.partitionBy("doc_id").orderBy("block_id")
    hard = F.col("block_type").isin("heading", *ATOMIC)
    # stop: where the hard block that ends the run begins
    next_hard = F.first(F.when(hard, F.col("char_start")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    paths = with_paths(blocks).select("*", F.sum(hard.cast("int")).over(order).alias("run"), F.coalesce(next_hard, F.col("total_chars")).alias("stop"))

    part = F.struct("block_id", "content", "image_refs", "heading_path", "char_start", "char_end")
    size = F.sum(F.when(~hard, F.length("content") + 2)) - 2
    prose = F.array_sort(F.collect_list(F.when(~hard, part)))
    atom = F.struct("block_id", F.lit(0), "content", "heading_path", "block_type", "image_refs", "has_formula", "char_start", "char_end")
    return paths.groupBy("doc_id", "run").agg(prose.alias("parts"), F.max(F.when(F.col("block_type").isin(*ATOMIC), atom)).alias("atom"), F.max("stop").alias("stop"), size.alias("size"))


def _known(fits: Column) -> Column:
    """Rows of a run that built-in expressions give: its atom, and its prose as one chunk where it fits."""
    one = F.array(
        F.struct(
            F.col("parts")[0]["block_id"], F.lit(0), F.array_join("parts.content", "\n\n"), F.col("parts")[0]["heading_path"], F.lit("paragraph"), F.flatten("parts.image_refs"), F.lit(False),
            F.col("parts")[0]["char_start"], F.col("stop"),
        )
    )
    none = F.array().cast(_ROWS)
    return F.concat(F.when(F.col("atom").isNotNull(), F.array("atom").cast(_ROWS)).otherwise(none), F.when((F.size("parts") > 0) & fits, one.cast(_ROWS)).otherwise(none))


def _numbered(rows: DataFrame, cfg: Config) -> DataFrame:
    """Chunks of (doc_id, c), in order."""
    number = (F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "piece")) - 1).alias("chunk_index")
    chunks = rows.select("doc_id", "c.*").select("*", number)
    return chunks.select(
        "doc_id", chunk_id().alias("chunk_id"), "chunk_index", "content", page_of(F.col("image_refs"), F.col("char_start"), cfg.chars_per_page).alias("page_number"), "heading_path", "block_type",
        "image_refs", "has_formula", "char_start", "char_end", approx_tokens(F.col("content"), cfg.chars_per_token).alias("token_count"),
    )


def sections(blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The chunks of assemble without a bound on their size: each run of prose is one chunk, however long; max_tokens and
    overlap_tokens count for nothing."""
    return _numbered(_run_rows(blocks).select("doc_id", F.explode(_known(F.lit(True))).alias("c")), cfg)


def assemble(blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Chunks (doc_id, chunk_index, chunk_id, content, ...) of blocks.

    chunk_id names the document, the place and the content of a chunk at this step; linking captions keeps it and
    renumbers chunk_index. Documents without blocks have no chunks.
    """
    kind = blocks.schema["doc_id"].dataType.simpleString()
    known = _known(F.col("size") < cfg.max_chars)
    runs = _run_rows(blocks).select("doc_id", known.alias("known"), F.when(F.col("size") >= cfg.max_chars, F.col("parts")).alias("long"), "stop")

    def pack(batches):
        for batch in batches:
            packed = [_long_run(p, s, cfg) if p else None for p, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, _ARROW)], ["doc_id", "known", "packed"])

    packed = runs.mapInArrow(pack, f"doc_id {kind}, known {_ROWS}, packed {_ROWS}")
    return _numbered(packed.select("doc_id", F.explode(F.concat("known", F.coalesce("packed", F.array().cast(_ROWS)))).alias("c")), cfg)


def chunk_id() -> Column:
    """Deterministic id of a chunk."""
    return F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"), F.col("content")))


def link_captions(chunks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Merges a table with the short "Table N." paragraph before or after it, greedily from the left; renumbers chunks.

    Neighbours that can merge form runs; in a run, every second link is taken, which is what the greedy pass does.
    """
    order = Window.partitionBy("doc_id").orderBy("chunk_index")
    caption = (F.col("block_type") == "paragraph") & (approx_tokens(F.col("content"), cfg.chars_per_token) < cfg.caption_tokens) & is_table_caption(F.col("content"))
    table = F.col("block_type") == "table"
    c = chunks.withColumn("_caption", caption).withColumn("_table", table)
    link = (F.col("_caption") & F.lead("_table").over(order)) | (F.col("_table") & F.lead("_caption").over(order))
    c = c.withColumn("_link", F.coalesce(link, F.lit(False)))
    c = c.withColumn("_breaks", F.sum(F.when(F.col("_link"), 0).otherwise(1)).over(order))
    run = Window.partitionBy("doc_id", "_breaks").orderBy("chunk_index")
    # rows of a run: links first, then the row that ends it (which is counted to the next value of _breaks)
    c = c.withColumn("_nth", F.sum(F.col("_link").cast("int")).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    c = c.withColumn("_takes", F.col("_link") & (F.col("_nth") % 2 == 1))
    c = c.withColumn("_taken", F.coalesce(F.lag("_takes").over(order), F.lit(False)))
    nxt = lambda name: F.lead(name).over(order)
    own = lambda name: F.when(F.col("_takes") & F.col("_caption"), nxt(name)).otherwise(F.col(name))
    merged = c.select(
        "doc_id",
        own("chunk_id").alias("chunk_id"),
        F.col("chunk_index").alias("_at"),
        F.when(F.col("_takes"), F.concat_ws("\n\n", "content", nxt("content"))).otherwise(F.col("content")).alias("content"),
        own("page_number").alias("page_number"),
        own("heading_path").alias("heading_path"),
        own("block_type").alias("block_type"),
        own("image_refs").alias("image_refs"),
        own("has_formula").alias("has_formula"),
        "char_start",
        F.when(F.col("_takes"), nxt("char_end")).otherwise(F.col("char_end")).alias("char_end"),
        "_taken",
    ).where("not _taken")
    again = Window.partitionBy("doc_id").orderBy("_at")
    return merged.withColumn("chunk_index", F.row_number().over(again) - 1).withColumn("token_count", approx_tokens(F.col("content"), cfg.chars_per_token)).drop("_at", "_taken")


def summary(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("block_type").agg(F.count("*").alias("n"), F.sum("token_count").alias("tokens")).orderBy(F.desc("n"), "block_type")

