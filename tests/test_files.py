"""Files of documents and images, stored layouts, crops."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import raster
from leafmill.operators import figures, pipelines
from leafmill.sources import readers, sinks


def names_of(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_markdown_and_chunk_files(spark, tmp_path):
    md = spark.createDataFrame([("a/b", "x\ny ü"), ("a/b", "z"), ("..", ""), ("n", None), (None, "w")], "doc_id string, text string")
    sinks.write_markdown(md, str(tmp_path / "md"), buckets=1)
    assert names_of(tmp_path / "md") == ["bucket=0/%2E%2E.md", "bucket=0/a%2Fb.md", "bucket=0/a%2Fb~2.md", "bucket=0/null.md"]
    assert (tmp_path / "md/bucket=0/a%2Fb.md").read_text("utf-8") == "x\ny ü"
    with pytest.raises(FileExistsError):
        sinks.write_markdown(md, str(tmp_path / "md"))
    sinks.write_markdown(md.limit(0), str(tmp_path / "md"), mode="overwrite")
    assert names_of(tmp_path) == []
    chunks = spark.createDataFrame([(1, 1, "b"), (1, 0, "ä"), (2, 0, "c")], "doc_id int, chunk_index int, content string")
    sinks.write_chunk_files(chunks, "file://" + str(tmp_path / "json"), buckets=1)
    found = (tmp_path / "json/bucket=0/1.json").read_text("utf-8")
    assert json.loads(found) == [{"chunk_index": 0, "content": "ä"}, {"chunk_index": 1, "content": "b"}] and "ä" in found and "\n" in found


def decoded(content):
    """Pixels of an unfiltered PNG."""
    assert content[:8] == b"\x89PNG\r\n\x1a\n"
    at, data = 8, b""
    while at < len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        assert struct.unpack(">I", content[at + 8 + size : at + 12 + size])[0] == zlib.crc32(kind + body)
        if kind == b"IHDR":
            width, height, depth, colour = struct.unpack(">IIBB", body[:10])
        data += body if kind == b"IDAT" else b""
        at += 12 + size
    channels = {0: 1, 2: 3, 6: 4}[colour]
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, 1 + width * channels)
    assert depth == 8 and not lines[:, 0].any()
    return lines[:, 1:].reshape(height, width, channels)


def test_contrast_and_png():
    rng = np.random.default_rng(1)
    for shape in ((3, 5), (4, 2, 3), (1, 1, 4)):
        pixels = rng.integers(0, 256, shape, np.uint8)
        assert (decoded(raster.png(pixels)).reshape(shape) == pixels).all()
    assert raster.contrast(np.full((4, 4, 3), 250, np.uint8)) == 0 and raster.contrast(np.zeros((0, 4), np.uint8)) == 0
    assert raster.contrast(np.array([[0, 200]], np.uint8)) == 200


def test_crops_are_drawn_once_a_page_and_written(spark, tmp_path):
    marks = tmp_path / "drawn"
    marks.mkdir()

    def draw(doc, page):
        with open(marks / f"{doc}-{page}", "a") as out:
            out.write("x")
        pixels = np.full((1666, 1275), 255, np.uint8)
        pixels[300:500, 300:500] = 7
        return None if doc == "gone" else pixels

    rows = [("d", 1, "images/a.png", 100.0, 200.0), ("d", 1, "images/b.png", 600.0, 700.0), ("gone", 1, "images/c.png", 100.0, 200.0), ("d", 2, "images/d.png", 100.0, 101.0)]
    found = spark.createDataFrame(rows, "doc_id string, page int, path string, top double, bottom double")
    box = figures.crop_box(F.col("top"), F.col("bottom"), F.lit(100.0), F.lit(200.0), F.lit(612.0), F.lit(800.0))
    crops = pipelines.render_crops(found.withColumn("box", box), draw)
    sinks.write_images(crops, str(tmp_path / "out"), buckets=1)
    assert names_of(tmp_path / "out") == ["bucket=0/d/images/a.png"]
    assert decoded((tmp_path / "out/bucket=0/d/images/a.png").read_bytes()).shape == (234, 234, 1)
    assert {p.name: p.read_text() for p in marks.iterdir()} == {"d-1": "x", "d-2": "x", "gone-1": "x"}


def test_stored_layouts(spark, tmp_path):
    dims = spark.createDataFrame([("d", 1, 612, 800, "more")], "doc_id string, page long, width int, height int, note string")
    dims.write.parquet(str(tmp_path / "p/page_dims"))
    dims.coalesce(1).write.json(str(tmp_path / "j/page_dims.json"))
    for engine, folder in (("parquet", "p"), ("json", "j")):
        found = readers.read_layout(spark, str(tmp_path / folder), engine)
        assert set(found) == set(readers.RELATIONS) and found["words"].count() == 0
        assert found["page_dims"].collect() == [("d", 1, 612.0, 800.0)] and found["page_dims"].schema["page"].dataType.simpleString() == "int"
    with pytest.raises(FileNotFoundError):
        readers.read_layout(spark, str(tmp_path / "none"), "parquet")
    dims.drop("height").write.parquet(str(tmp_path / "q/page_dims"))
    with pytest.raises(ValueError, match="height"):
        readers.read_layout(spark, str(tmp_path / "q"), "parquet")
    spark.range(1).select(F.lit("d").alias("doc_id"), F.array(F.lit(1)).alias("page"), F.lit(1).alias("width"), F.lit(1).alias("height")).write.parquet(str(tmp_path / "r/page_dims"))
    with pytest.raises(ValueError, match="page_dims"):
        readers.read_layout(spark, str(tmp_path / "r"), "parquet")
