from pyspark.sql import functions as F

from leafmill.operators import pipelines

WORDS = "doc_id string, page int, word_id long, text string, x0 double, x1 double, top double, bottom double"


def page_of_words(page, rows, top=200.0):
    out, n = [], 0
    for r, cells in enumerate(rows):
        for c, cell in enumerate(cells):
            n += 1
            out.append(("d", page, page * 1000 + n, cell, 72.0 + 110 * c, 100.0 + 110 * c, top + 14 * r, top + 10 + 14 * r))
    return out


def test_borderless_tables(spark):
    table = [["Model", "Score", "Year"], ["ViT", "88", "2020"], ["ResNet", "76", "2015"], ["MLP", "60", "2010"]]
    words = page_of_words(1, table) + page_of_words(2, [["Deep", "51", "2001"], ["Wide", "40", "1999"]], top=60.0)
    df = spark.createDataFrame(words, WORDS)
    got = pipelines.borderless_tables(df).orderBy("table_id").collect()
    assert [(r.page, r.header, r.data) for r in got][0] == (1, ["Model", "Score", "Year"], table[1:])
    zones = spark.createDataFrame([("d", 1, 190.0, 300.0)], "doc_id string, page int, top double, bottom double")
    assert all(r.page != 1 for r in pipelines.borderless_tables(df, zones).collect())
    assert pipelines.borderless_tables(df.where("false")).collect() == []


def test_bordered_tables_and_zones(spark):
    raw = spark.createDataFrame(
        [("d", 1, 0, 10.0, 50.0, [["Name", "Value"], ["a", "1"]]), ("d", 2, 0, 5.0, 20.0, [["12", "3"]])], "doc_id string, page int, tbl_ord int, top double, bottom double, rows array<array<string>>"
    )
    found = pipelines.bordered_tables(raw)
    assert found.first().data == [["a", "1"], ["12", "3"]]
    assert sorted((r.page, r.top, r.bottom) for r in pipelines.zones_of(found).collect()) == [(1, 10.0, 50.0), (2, 5.0, 20.0)]


def figure_inputs(spark):
    dims = spark.createDataFrame([("d", 1, 612.0, 800.0), ("d", 2, 612.0, 800.0)], "doc_id string, page int, width double, height double")
    text = spark.createDataFrame([("d", 1, 1, 205.0, 215.0, 50.0, 400.0, "Figure 1. A raster image of a cat")], "doc_id string, page int, cap_id int, top double, bottom double, x0 double, x1 double, text string")
    rasters = spark.createDataFrame(
        [("d", 1, 7, 1, [(60.0, 100.0, 300.0, 200.0)], "png", 100, 90, True), ("d", 1, 7, 2, [(0.0, 0.0, 1.0, 1.0)], "png", 100, 90, True), ("d", 1, 8, 3, [], "jpg", 20, 90, True), ("d", 2, 9, 1, [], "jpg", 90, 90, True)],
        "doc_id string, page int, xref int, ord int, rects array<struct<x0:double,y0:double,x1:double,y1:double>>, ext string, width int, height int, has_bytes boolean",
    )
    return dims, text, rasters


def test_raster_and_vector_figures(spark):
    dims, text, rasters = figure_inputs(spark)
    got = pipelines.raster_figures(rasters, dims, text).orderBy("page").collect()
    assert [(r.path, r.top, r.bottom, r.caption) for r in got] == [("images/page1_img1.png", 100.0, 200.0, "Figure 1. A raster image of a cat"), ("images/page2_img1.jpg", 0.0, 800.0, "")]
    lines = spark.createDataFrame(
        [("d", 1, 1, 205.0, 215.0, 50.0, "Figure 1. A raster image of a cat"), ("d", 1, 2, 500.0, 510.0, 50.0, "Figure 2. A plot"), ("d", 2, 1, 90.0, 100.0, 50.0, "Figure 3. Over the page")],
        "doc_id string, page int, line_id int, top double, bottom double, x0 double, text string",
    )
    graphics = spark.createDataFrame([("d", 1, 1, 400.0, 480.0, 60.0, 300.0), ("d", 1, 2, 600.0, 780.0, 60.0, 300.0)], "doc_id string, page int, obj_id int, top double, bottom double, x0 double, x1 double")
    found = pipelines.vector_figures(lines, graphics, dims, pipelines.raster_figures(rasters, dims, text)).orderBy("top").collect()
    assert [(r.page, r.top, r.caption, r.path) for r in found] == [(1, 400.0, "Figure 2. A plot", "images/page1_fig1.png"), (1, 600.0, "Figure 3. Over the page", "images/page1_figX.png")]
    both = pipelines.images(pipelines.raster_figures(rasters, dims, text), pipelines.vector_figures(lines, graphics, dims, pipelines.raster_figures(rasters, dims, text)))
    assert [r.path for r in both.collect()] == ["images/page1_img1.png", "images/page1_fig1.png", "images/page1_figX.png", "images/page2_img1.jpg"]
    drawn = pipelines.render(both, lambda doc, page, box: (b"png", 3.0 if page == 2 else 99.0))
    assert drawn.count() == 3


def test_parse_documents(spark):
    text = "intro\n\n<!-- image -->\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\nend"
    md = spark.createDataFrame([("d", text), ("e", "no table")], "doc_id string, text string")
    layout = spark.createDataFrame([("d", 1, 0, 100.0, 200.0, "| a | b |\n|---|---|\n| 1 | 2 |", 2)], "doc_id string, page int, id int, top double, bottom double, markdown string, n_cols int")
    bordered = spark.createDataFrame([("d", 0, 1, 105.0, 200.0, ["a", "b", "c"], [["1", "2", "3"]], "| a | b | c |")], "doc_id string, table_id int, page int, top double, bottom double, header array<string>, data array<array<string>>, markdown string")
    borderless = spark.createDataFrame([("e", 1, 3.0, "| n |")], "doc_id string, page int, top double, markdown string")
    pictures = spark.createDataFrame([("d", 1, 5.0, "p.png", "Figure 1. c")], "doc_id string, page int, top double, path string, caption string")
    got = {r.doc_id: r for r in pipelines.parse_documents(md, bordered, layout, borderless, pictures).collect()}
    assert got["d"].text == "intro\n\n![Figure 1](p.png)\n*Figure 1. c*\n\n| a | b | c |\n\nend"
    assert got["e"].text == "no table\n\n| n |\n\n"
    assert [got["d"][c] for c in ("n_replaced", "n_borderless", "n_images")] == [1, 0, 1]


def test_chunk_pipelines(spark):
    md = spark.createDataFrame([("d", "# H\n\nText.\n\n| a |\n|---|\n| 1 |\n# Next\nTable 1. Late caption")], "doc_id string, text string")
    assert pipelines.chunk_markdown(md).select("block_type").orderBy("chunk_index").collect()[1][0] == "table"
    assert [r.chunk_index for r in pipelines.chunk_fenced(md).orderBy("chunk_index").collect()] == list(range(pipelines.chunk_fenced(md).count()))
    assert pipelines.chunk_markdown(md.where(F.lit(False))).collect() == []
