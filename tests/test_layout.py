import json
import random
from statistics import mean

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as fn
from leafmill.operators import figures, geometry, merge, tables, vectors
from leafmill.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def rows_of(*rows):
    return F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows])


@pytest.mark.parametrize(
    ("raw", "want"),
    [(None, ""), ("a\nb", "ab"), ("Hello\nworld", "Hello world"), ("x_\ny", "x_y"), ("v1\n2b", "v12b"), ("Net\nwork", "Network"), ("A\n\nB", "A B"), ("longer word\nnext", "longer word next")],
)
def test_wrapped_words(spark, raw, want):
    assert one(spark, fn.clean_cell(F.lit(raw).cast("string"))) == want


def test_scalars(spark):
    assert one(spark, fn.approx_tokens(F.lit("abc"))) == 1 and one(spark, fn.approx_tokens(F.lit("a" * 9))) == 2
    assert one(spark, fn.page_of(F.array(F.lit("x"), F.lit("images/PAGE12_f.png")), F.lit(0))) == 12
    assert one(spark, fn.page_of(F.array().cast("array<string>"), F.lit(6500))) == 3
    assert one(spark, fn.upper_median(F.array(F.lit(1), F.lit(2)))) == 2
    assert one(spark, fn.table_row(F.lit(" || a | b |"))) == ["a", "b"]
    assert one(spark, fn.overlap_ratio(F.lit(0.0), F.lit(10.0), F.lit(5.0), F.lit(15.0))) == pytest.approx(1 / 3)
    assert one(spark, fn.figure_markdown(F.lit("p.png"), F.lit("Figure 2. Net"), F.lit(4))) == "![Figure 2](p.png)\n*Figure 2. Net*"
    assert one(spark, fn.render_table(F.array(F.lit("a"), F.lit("bb")), rows_of(["1", "22222"]))) == "|   a |    bb |\n|----:|------:|\n|   1 | 22222 |"
    mixed = fn.render_table(F.array(F.lit("name"), F.lit("error(%)"), F.lit("n")), rows_of(["Maxout[10]", "9.38", ""], ["x", "10", "2"]))
    assert one(spark, mixed).split("\n") == ["| name       |   error(%) | n   |", "|:-----------|-----------:|:----|", "| Maxout[10] |       9.38 |     |", "| x          |      10    | 2   |"]


def test_predicates(spark):
    assert one(spark, tables.is_paragraph(rows_of(["w" * 60], ["v" * 50])))
    assert not one(spark, tables.is_paragraph(rows_of(["w" * 60], ["a", "b"])))
    assert one(spark, tables.looks_like_header(F.array(F.lit("Name"), F.lit("12")))) and not one(spark, tables.looks_like_new_header(F.array(F.lit("1"), F.lit("12"))))
    assert one(spark, tables.repeats_header(F.array(F.lit("A"), F.lit("b")), F.array(F.lit("a"), F.lit("B"))))
    good = rows_of(["Model", "Score"], ["ViT", "88"], ["ResNet", "76"], ["MLP", "60"])
    assert one(spark, tables.is_valid(good, F.lit(2)))
    assert not one(spark, tables.is_valid(rows_of(["a@b.com", "x"], ["c", "d"], ["e", "f"], ["g", "1"]), F.lit(2)))
    assert not one(spark, tables.is_valid(rows_of(["John Smith", "Ann Lee"], ["Bob Ray", "Tim Orr"], ["Eve Moe", "Al Poe"]), F.lit(2)))
    assert one(spark, tables.is_page_top_rest(rows_of(["a", "1"]), F.lit(100.0), F.lit(2))) and not one(spark, tables.is_page_top_rest(rows_of(["of the", "1"], ["cut of", "2"]), F.lit(100.0), F.lit(2)))
    header, data = tables.grid_to_table(rows_of(["Name", "", "X"], ["a", "", "1"]), F.lit(3))
    assert (one(spark, header), one(spark, data)) == (["Name", "X"], [["a", "1"]])


def test_merging_of_grids(spark):
    assert one(spark, geometry.merge_orphan_rows(rows_of(["Path", "1"], ["Slides", ""], ["x", "2"]))) == [["Path Slides", "1"], ["x", "2"]]
    assert geometry._joined([["Chest", "X-Ray", "1"], ["Head", "", "2"]], [10.0, 40.0, 200.0], 50, 0.4) == ([["Chest X-Ray", "1"], ["Head", "2"]], [10.0, 200.0])
    assert geometry._joined([["a", "1"], ["b", "2"]], [10.0, 90.0], 50, 0.4) == ([["a", "1"], ["b", "2"]], [10.0, 90.0])


def test_rows_compare_with_the_first_word(spark):
    rng = random.Random(3)
    rows = [("d", p, i, "w", rng.uniform(0, 500), 0.0, round(rng.uniform(0, 80), 1), 0.0) for p in range(4) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, page int, word_id long, text string, x0 double, x1 double, top double, bottom double")
    got = {(r.page, r.word_id): r.row_id for r in geometry.visual_rows(df).collect()}
    for page in range(4):
        row, anchor = -1, None
        for r in sorted((r for r in rows if r[1] == page), key=lambda r: (r[6], r[4])):
            if anchor is None or abs(r[6] - anchor) > 4:
                row, anchor = row + 1, r[6]
            assert got[page, r[2]] == row


def test_clusters_match_a_loop(spark):
    rng = random.Random(7)
    rows = [("d", p, i, t := rng.randint(0, 2000), t + rng.randint(0, 80), 0, 100) for p in range(6) for i in range(25)]
    df = spark.createDataFrame([(d, p, i, float(t), float(b), float(x), float(y)) for d, p, i, t, b, x, y in rows], "doc_id string, page int, obj_id int, top double, bottom double, x0 double, x1 double")
    got = sorted((r.page, r.top, r.bottom) for r in geometry.clusters(df).collect())
    want = []
    for p in range(6):
        found = []
        for _, _, _, t, b, _, _ in sorted((r for r in rows if r[1] == p), key=lambda r: (r[3], r[2])):
            if found and t - found[-1][1] <= 60:
                found[-1][1] = max(found[-1][1], b)
            else:
                found.append([t, b])
        want += [(p, float(t), float(b)) for t, b in found if b - t >= 30]
    assert got == sorted(want)


def test_logical_tables_and_page_merge(spark):
    raw = spark.createDataFrame(
        [(1, 1, 0, 0.0, 9.0, [["Name", "Value"], ["a", "1"]]), (1, 2, 0, 0.0, 9.0, [["12", "3"], ["c", "4"]]), (1, 3, 0, 0.0, 9.0, [["Key", "Other"], ["d", "5"]])],
        "doc_id int, page int, tbl_ord int, top double, bottom double, rows array<array<string>>",
    )
    got = tables.logical_tables(raw).orderBy("table_id").collect()
    assert [(r.header, r.data) for r in got] == [(["Name", "Value"], [["a", "1"], ["12", "3"], ["c", "4"]]), (["Key", "Other"], [["d", "5"]])]
    parts = spark.createDataFrame(
        [(1, 1, 0.0, 9.0, ["Col1", "Col2"], [["a", "1"]], [["a", "1"]], False), (1, 2, 0.0, 8.0, ["x", "2"], [], [["x", "2"]], True), (1, 3, 0.0, 7.0, ["Name", "Score"], [["q", "w"]], [["q", "w"]], False)],
        "doc_id int, page int, top double, bottom double, header array<string>, data array<array<string>>, grid array<array<string>>, is_cont boolean",
    )
    assert [(r.page, r.bottom, r.header, r.data) for r in tables.merge_pages(parts).orderBy("table_id").collect()] == [
        (1, 8.0, ["Col1", "Col2"], [["a", "1"], ["x", "2"]]),
        (3, 7.0, ["Name", "Score"], [["q", "w"]]),
    ]


def test_figures(spark):
    lines = spark.createDataFrame(
        [("d", 1, 1, 100.0, 110.0, 50.0, "Figure 1. A net"), ("d", 1, 2, 115.0, 125.0, 50.0, "of layers, and"), ("d", 1, 3, 128.0, 138.0, 50.0, "Next paragraph"), ("d", 1, 4, 300.0, 310.0, 50.0, "Figure 2 shows the net")],
        "doc_id string, page int, line_id int, top double, bottom double, x0 double, text string",
    )
    captions = figures.find_captions(lines)
    assert [r.text for r in captions.collect()] == ["Figure 1. A net"]
    assert figures.full_captions(captions, lines).first().text == "Figure 1. A net of layers, and"
    box = one(spark, figures.crop_box(F.lit(0.0), F.lit(72.0), F.lit(72.0), F.lit(144.0), F.lit(612.0), F.lit(792.0)))
    assert tuple(box) == (137, 0, 312, 162)
    assert one(spark, figures.crop_box(F.lit(0.0), F.lit(0.1), F.lit(700.0), F.lit(701.0), F.lit(612.0), F.lit(792.0))) is None


def test_caption_lines(spark):
    lines_ = {
        "Figure 1. A net": "Figure 1. A net", "Fig.3: loss": "Fig.3: loss", "Figure 2 and the rest": "Figure 2 and the rest", "FIGURE 5 - plot": "FIGURE 5 - plot", "Fig 2 A": "Fig 2 A",
        "Figure 4 top panel": None, "Figure 2 first": None, "Figure 3 (left) is": None, "Figure 12abc": None, "Figure 7": None, "Figure 2 shows it": None,
        "left column text Figure 6. A long enough description of it": "Figure 6. A long enough description of it", "as in Fig. 4. right": None,
        "see Figure 8. The description is long but a reference": None, "see Figure 8: (as described before, and at length)": None, "see Figure 9: this shows a great many things at once": None,
    }
    rows = [("d", 1, i, 20.0 * i, 20.0 * i + 9, 50.0, t) for i, t in enumerate(lines_)]
    df = spark.createDataFrame(rows, "doc_id string, page int, line_id int, top double, bottom double, x0 double, text string")
    assert {r.line_id: r.text for r in figures.find_captions(df).collect()} == {i: t for i, t in enumerate(lines_.values()) if t}


def test_rewriting(spark):
    md = spark.createDataFrame([(1, "a\n\nFigure 1: plain\n\n<!-- image -->\n\nb\n\n<!-- image -->\n\n| x |\n|---|\n| 1 |\nend")], "doc_id int, text string")
    assert merge.drop_plain_captions(md).first().text == "a\n\n\n<!-- image -->\n\nb\n\n<!-- image -->\n\n| x |\n|---|\n| 1 |\nend".replace("a\n\n\n", "a\n\n\n")
    images = spark.createDataFrame([(1, 2, 5.0, "p2.png", ""), (1, 1, 5.0, "p1.png", "Figure 1. c")], "doc_id int, page int, top double, path string, caption string")
    text = merge.inject_images(md, images).first().text
    assert text.index("p1.png") < text.index("p2.png") and "<!-- image -->" not in text
    assert merge.inject_images(md, images.where("page = 1")).first().text.count("<!-- image -->") == 1
    table = spark.createDataFrame([(1, 1, 0.0, "| new |")], "doc_id int, page int, top double, markdown string")
    assert merge.inject_tables(md, table).first().text.endswith("| 1 |\n\n\n| new |\n\nend")
    swap = spark.createDataFrame([(1, 0, "| y |")], "doc_id int, table_no int, markdown string")
    assert merge.replace_tables(md, swap).first().text.endswith("| y |\nend")
    doubled = spark.createDataFrame([(1, "t\n\nFigure 1. c\n\nu")], "doc_id int, text string")
    assert merge.drop_repeated_captions(doubled, images).first().text == "t\n\nu"


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text("# A\n\nb ü", encoding="utf-8")
    md = readers.read_markdown(spark, str(tmp_path / "in"))
    assert [tuple(r) for r in md.collect()] == [("one", "one", "# A\n\nb ü")]
    sinks.write_markdown(md, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).first().value.strip() == "# A\n\nb ü"
    chunks = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "doc_id int, chunk_index int, content string")
    assert json.loads(sinks.chunk_arrays(chunks).first()["json"]) == [{"chunk_index": 0, "content": "a"}, {"chunk_index": 1, "content": "b"}]
    sinks.write_chunks(chunks, str(tmp_path / "chunks"))
    assert spark.read.json(str(tmp_path / "chunks")).count() == 2
    sinks.write_vectors(chunks.withColumn("chunk_id", F.lit("x")), lambda c: c.withColumn("embedding", F.array(F.lit(1.0).cast("float"))), str(tmp_path / "vectors"))
    assert spark.read.parquet(str(tmp_path / "vectors")).count() == 2
    with pytest.raises(ImportError):
        readers.read_layout(spark, "x", "none")
    flipped = readers.flip(spark.createDataFrame([(1, 1, 700.0, 600.0)], "doc_id int, page int, t double, b double"), spark.createDataFrame([], "doc_id int, page int, height double"))
    assert flipped.select("top", "bottom").first() == (142.0, 242.0)
    html = readers.read_html(spark, spark.createDataFrame([(1, "<nav>x</nav><h2>T</h2><ul><li>a &amp; b</li></ul><p>c")], "page_id int, html string"))
    assert html.first().text.split("\n") == ["## T", "- a & b", "c"]


def test_stream(spark, tmp_path):
    from leafmill.streaming import chunk_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# H\n\ntext\n\n| a |\n|---|\n")
    seen = []
    stream = chunk_stream.markdown_stream(spark, str(tmp_path / "in"))
    query = chunk_stream.chunk_stream(stream, lambda df, n: seen.extend(df.select("doc_id", "block_type").collect()), str(tmp_path / "state"))
    query.awaitTermination(120)
    assert sorted(tuple(r) for r in seen) == [("a", "paragraph"), ("a", "table")]


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r.vec_id) for r in vectors.top_k(df, df.where("vec_id % 20 = 0"), 2).orderBy("query_id", "rank").collect()]
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = []
    for q, v in rows:
        if q % 20 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)) / norm(v) / norm(w), i) for i, w in rows if i != q))
            want += [(q, i) for _, i in best[:2]]
    assert got == want
    assert mean(x for x, _ in got) == 20
