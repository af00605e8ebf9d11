import itertools
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.operators import blocks, chunks, fenced, lines, merge
from leafmill.operators.config import Config

LINES = [
    "# Top", "## Sub one", "### Deep", "###### Six", "plain text here. And more of it! Really?", "short", "", "", "| a | b |", "|---|---|", "- item", "  2) item two",
    "![Figure 1](images/page7_fig1.png)", "*Figure 1. Caption*", "*not after image*", "<!-- formula-not-decoded -->", "Table 3. A caption.", "see ![x](y/page12.png) inline", "longer " * 30,
]


KINDS = [
    ("heading", r"#{1,6}\s+.+$"), ("formula", r"<!--\s*formula-not-decoded\s*-->"), ("figure", r"!\[[^\]]*\]\([^)]+\)"),
    ("table", r"\|"), ("list", r"(\s*[-*+]|\s*\d+[.)]) "),
]


def islands(text):
    """[kind, lines, first position, position behind]: neighbouring lines of one kind, single lines of the first three kinds."""
    lines = text.splitlines(keepends=True)
    ends = list(itertools.accumulate(map(len, lines)))
    kinds = [next((k for k, p in KINDS if re.match(p, x)), "paragraph") for x in lines]
    caption = [i > 0 and kinds[i - 1] == "figure" and kinds[i] in ("list", "paragraph") and bool(re.match(r"\*.+\*$", x.rstrip("\n"))) for i, x in enumerate(lines)]
    keys = list(itertools.accumulate(
        not caption[i] and (i == 0 or kinds[i] in ("heading", "formula", "figure") or kinds[i] != kinds[i - 1] or caption[i - 1]) for i in range(len(lines))
    ))
    out = []
    for _, part in itertools.groupby(range(len(lines)), lambda i: keys[i]):
        part = list(part)
        out.append([kinds[part[0]], "".join(lines[i] for i in part), ends[part[0]] - len(lines[part[0]]), ends[part[-1]], ends[part[0]]])
    return out


def model_blocks(text):
    found = islands(text)
    out = []
    for before, (kind, body, start, stop, first), after in zip([None, *found], found, [*found[1:], None]):
        # the line that ends a table or list counts to it, as far as positions go
        if kind == "paragraph" and before and before[0] in ("table", "list"):
            start = first
        if after and (kind in ("table", "list") and after[0] == "paragraph" or (kind, after[0]) == ("table", "list")):
            stop = after[4]
        body = body.rstrip("\n") if kind in ("heading", "formula", "figure") else body.strip()
        if body:
            out.append([kind, body, start, stop])
    return out


def model_packs(text, limit):
    """By trying: the longest head of what is left that fits, of whole sentences, or of words up to the sentence's end."""
    units = []  # (string, begins a pack)
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        words = sentence.split() if len(sentence) > limit else [sentence] if sentence else []
        units += [(w, len(sentence) > limit and i == 0) for i, w in enumerate(words)]
    out = []
    while units:
        stops = [n for n in range(1, len(units) + 1) if n == 1 or not any(seam for _, seam in units[1:n]) and len(" ".join(w for w, _ in units[:n]).strip()) <= limit]
        n = max(stops)
        out.append(units[0][0] if n == 1 else " ".join(w for w, _ in units[:n]).strip())
        units = units[n:]
    return out or [text]


def model_chunks(found, total, cfg):
    paths, open_now = [], {}
    for kind, body, _, _ in found:
        if kind == "heading":
            level = len(re.match("#+", body)[0])
            open_now = {k: v for k, v in open_now.items() if k < level} | {level: body.lstrip("#").strip()}
        paths.append(tuple(open_now[k] for k in sorted(open_now)))
    hard = [kind in ("heading", "table", "figure", "formula") for kind, *_ in found]
    out = []
    for is_hard, part in itertools.groupby(range(len(found)), lambda i: hard[i]):
        part = list(part)
        if is_hard:
            out += [(found[i][0], found[i][1], found[i][2], found[i][3], paths[i]) for i in part if found[i][0] != "heading"]
            continue
        tail = ""
        stop = found[part[-1] + 1][2] if part[-1] + 1 < len(found) else total
        while part:
            n = next((n for n in range(1, len(part) + 1) if len("\n\n".join(found[i][1] for i in part[:n])) >= cfg.max_chars), 0)
            group, part = (part[:n], part[n:]) if n else (part, [])
            whole = (tail + "\n\n" + "\n\n".join(found[i][1] for i in group)).strip()
            pieces = model_packs(whole, cfg.max_chars) if len(whole) > cfg.max_chars else [whole]
            out += [("paragraph", p, found[group[0]][2], found[group[-1]][3] if n else stop, paths[group[0]]) for p in pieces]
            tail = pieces[-1][max(0, len(pieces[-1]) - cfg.overlap_chars) :]
    return out


@given(st.lists(st.sampled_from(["One.", "Two words!", "a", "longer-word", "Is it?", "x" * 30, "end"]), max_size=25), st.integers(3, 40))
@settings(max_examples=200, deadline=None)
def test_packs_are_the_longest_that_fit(parts, limit):
    text = " ".join(parts)
    assert chunks.pack_sentences(text, limit) == model_packs(text, limit)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 40))) + rng.choice(["", "\n"])) for i in range(150)]


def test_blocks_match_islands(spark, corpus):
    df = blocks.parse(spark.createDataFrame(corpus, "doc_id long, text string"))
    got = {}
    for r in df.orderBy("doc_id", "block_id").collect():
        got.setdefault(r.doc_id, []).append([r.block_type, r.content, r.char_start, r.char_end])
    for doc, text in corpus:
        assert got.get(doc, []) == model_blocks(text), text


@pytest.mark.parametrize("cfg", [Config(), Config(max_tokens=20, overlap_tokens=5), Config(max_tokens=9, overlap_tokens=0)])
def test_chunks_match_sections_packed_by_trying(spark, corpus, cfg):
    df = chunks.assemble(blocks.parse(spark.createDataFrame(corpus, "doc_id long, text string")), cfg)
    got = {}
    for r in df.orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r.doc_id, []).append((r.block_type, r.content, r.char_start, r.char_end, tuple(r.heading_path)))
    for doc, text in corpus:
        assert got.get(doc, []) == model_chunks(model_blocks(text), len(text), cfg)


def test_caption_links_are_greedy(spark):
    rng = random.Random(1)
    rows = []
    for doc in range(60):
        for i in range(rng.randint(1, 12)):
            kind = rng.choice(["table", "caption", "caption", "text"])
            body = {"table": "| t |", "caption": f"Table {i}. c", "text": "words"}[kind]
            rows.append((doc, f"{doc}-{i}", i, body, 1, ["h"], "table" if kind == "table" else "paragraph", [], False, i * 10, i * 10 + 9, 1))
    names = "doc_id long, chunk_id string, chunk_index int, content string, page_number int, heading_path array<string>, block_type string, image_refs array<string>, has_formula boolean, char_start int, char_end int, token_count int"
    got = {}
    for r in chunks.link_captions(spark.createDataFrame(rows, names)).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r.doc_id, []).append((r.chunk_index, r.chunk_id, r.content, r.char_start, r.char_end))
    for doc in range(60):
        mine, want, i = [r for r in rows if r[0] == doc], [], 0
        is_cap = lambda r: r[3].startswith("Table ")
        while i < len(mine):
            a, b = mine[i], mine[i + 1] if i + 1 < len(mine) else None
            if b and (is_cap(a) and b[6] == "table" or a[6] == "table" and is_cap(b)):
                want.append((len(want), (b if is_cap(a) else a)[1], a[3] + "\n\n" + b[3], a[9], b[10]))
                i += 2
            else:
                want.append((len(want), a[1], a[3], a[9], a[10]))
                i += 1
        assert got[doc] == want


def test_pack_sentences():
    assert chunks.pack_sentences("One. Two! Three?", 9) == ["One. Two!", "Three?"]
    assert chunks.pack_sentences("aaa bbb ccc", 7) == ["aaa bbb", "ccc"]
    assert chunks.pack_sentences("", 5) == [""]
    assert chunks.pack_words("abcdefgh ij", 4) == ["abcdefgh", "ij"]


def test_recursive_split_covers_the_text():
    text = "\n\n".join("Sentence number %d is here. Another one follows it!" % i for i in range(40))
    pieces = fenced.split_recursively(text, 120, 0)
    assert all(len(p) <= 120 and text[s : s + len(p)] == p for p, s in pieces)
    assert "".join("".join(p.split()) for p, _ in pieces) == "".join(text.split())
    assert fenced.split_recursively("x" * 50, 20, 0) == [("x" * 20, 0), ("x" * 20, 20), ("x" * 10, 40)]
    assert len(fenced.split_recursively("aa bb cc dd ee", 6, 3)) > 2


def test_fenced_chunks_keep_tables_whole(spark):
    text = "# H\n\nintro words\n\n| a |\n|---|\n" + "| row |\n" * 40 + "\n![f](images/page3_x.png)\n\n*Figure 1. c*\nend"
    rows = fenced.chunk(spark.createDataFrame([(1, text)], "doc_id long, text string"), Config(max_tokens=30, overlap_tokens=0)).orderBy("chunk_index").collect()
    assert any(r.block_type == "figure" and r.page_number == 3 and "Figure 1. c" in r.content for r in rows)
    assert all(r.heading_path == ["H"] for r in rows) and not any("ATOMIC" in r.content for r in rows if r.block_type == "figure")


def test_store_metadata(spark):
    text = "# A > B\n\n<!-- formula-not-decoded -->\n\n### C, d\n\nsee ![x](images/page4_a.png) and ![y](b, c.png)"
    found = fenced.chunk(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    rows = fenced.store_metadata(found, F.lit("f.md")).orderBy("chunk_index").collect()
    assert [(r.source_file, r.header_1, r.header_2, r.header_3, r.breadcrumb) for r in rows] == [("f.md", "A > B", None, None, "A > B"), ("f.md", "A > B", None, "C, d", "A > B > C, d")]
    assert rows[1].image_list == "images/page4_a.png, b, c.png" and rows[1].page_number == 4
    only = fenced.chunk(spark.createDataFrame([(1, "<!-- formula-not-decoded -->"), (2, "x\n<!-- formula-not-decoded -->")], "doc_id long, text string"))
    assert [r.has_formula for r in only.orderBy("doc_id").collect()] == [True, False]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert chunks.assemble(blocks.parse(empty)).collect() == [] and fenced.chunk(empty).collect() == []
    odd = spark.createDataFrame([(1, ""), (2, "\n\n"), (3, "|"), (None, "x")], "doc_id long, text string")
    assert [r.content for r in blocks.parse(odd).orderBy("doc_id").collect()] == ["x", "|"]


def test_long_documents_and_line_breaks(spark):
    """Lines of one document cost in proportion to their number; \\r\\n counts as one character."""
    text = "\n".join(f"| a | {i} |" if i % 5 == 0 else f"line {i} of text" for i in range(16_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    blocks.parse(df).count()
    began = time.time()
    assert blocks.parse(df).count() == 6400
    assert time.time() - began < 10
    windows = spark.createDataFrame([(1, "a\r\n| x |\r\n|---|\r\nend\r\n"), (2, None), (3, "")], "doc_id long, text string")
    assert [(r.char_start, r.char_end, r.line) for r in lines.explode_lines(windows.where("doc_id = 1")).orderBy("ln").collect()] == [(0, 2, "a"), (2, 8, "| x |"), (8, 14, "|---|"), (14, 18, "end"), (18, 18, "")]
    swap = spark.createDataFrame([(1, 0, "| y |")], "doc_id long, table_no int, markdown string")
    assert [r.text for r in merge.replace_tables(windows, swap).orderBy("doc_id").collect()] == ["a\n| y |\nend\n", None, ""]
    extra = spark.createDataFrame([(1, 1, 0.0, "| z |"), (2, 1, 0.0, "| z |")], "doc_id long, page int, top double, markdown string")
    assert [r.text for r in merge.inject_tables(windows, extra).orderBy("doc_id").collect()] == ["a\n| x |\n|---|\n\n\n| z |\n\nend\n", None, ""]
    assert [r.text for r in merge.drop_plain_captions(windows).orderBy("doc_id").collect()] == ["a\n| x |\n|---|\nend\n", None, ""]
    assert [r.doc_id for r in fenced.fence(windows).orderBy("doc_id").collect()] == [1, 2, 3]
