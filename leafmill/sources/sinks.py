"""Writers: chunks as JSON, markdown files, images, vectors.

Files of single documents and images are written by the executors, so their folder has to be one that all of them reach:
a local path in local mode, else a URI. They are spread over `bucket=<n>` folders, so that no folder holds them all. A task
that runs again writes the same files again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))


def _prepare(folder: str, mode: str) -> None:
    """mode as in Spark's writers: error, append or overwrite."""
    store, path = _store(folder)
    if store.get_file_info(path).type != fs.FileType.NotFound:
        if mode in ("error", "errorifexists"):
            raise FileExistsError(folder)
        if mode == "overwrite":
            store.delete_dir(path)


def write_files(files: DataFrame, folder: str, mode: str = "error") -> None:
    """One file for each row of (path string, content binary), path below folder. Rows without content make no file."""
    _prepare(folder, mode)

    def run(rows):
        store, root = _store(folder)
        made = set()
        for row in rows:
            target = f"{root}/{row['path']}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            with store.open_output_stream(target) as out:
                out.write(bytes(row["content"]))

    files.select("path", "content").where("path is not null and content is not null").foreachPartition(run)


def _safe(name: Column) -> Column:
    """A name that is one path part; null is "null"."""
    return F.coalesce(F.replace(F.url_encode(name.cast("string")), F.lit("."), F.lit("%2E")), F.lit("null"))


def _bucketed(name: Column, buckets: int) -> Column:
    return F.concat(F.lit("bucket="), F.pmod(F.hash(name), F.lit(buckets)).cast("string"), F.lit("/"), name)


def _document_files(texts: DataFrame, ending: str, buckets: int) -> DataFrame:
    """(path, content) of (doc_id, text); repeated ids count on: a.md, a~2.md, ..."""
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    name = F.concat(_safe(F.col("doc_id")), F.when(F.col("_n") > 1, F.concat(F.lit("~"), F.col("_n").cast("string"))).otherwise(""))
    path = F.concat(_bucketed(name, buckets), F.lit(ending)).alias("path")
    return texts.where("text is not null").withColumn("_n", number).select(path, F.encode("text", "UTF-8").alias("content"))


def write_chunks(chunks: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines, one object for each chunk, written in parallel."""
    chunks.write.mode(mode).json(path)


def chunk_arrays(chunks: DataFrame, pretty: bool = False) -> DataFrame:
    """(doc_id, json): each document's chunks as one JSON array, in order."""
    fields = [c for c in chunks.columns if c not in ("doc_id", "chunk_index")]
    rows = F.array_sort(F.collect_list(F.struct("chunk_index", *fields)))
    return chunks.groupBy("doc_id").agg(F.to_json(rows, {"pretty": str(pretty).lower()}).alias("json"))


def write_chunk_files(chunks: DataFrame, path: str, mode: str = "error", buckets: int = BUCKETS) -> None:
    """One JSON file for each document, an array of its chunks in order: <path>/bucket=<n>/<doc_id>.json."""
    texts = chunk_arrays(chunks, pretty=True).withColumnRenamed("json", "text")
    write_files(_document_files(texts, ".json", buckets), path, mode)


def write_markdown(md: DataFrame, path: str, mode: str = "error", buckets: int = BUCKETS) -> None:
    """One markdown file for each document, <path>/bucket=<n>/<doc_id>.md. Documents with a null text make no file."""
    write_files(_document_files(md.select("doc_id", "text"), ".md", buckets), path, mode)


def write_images(images: DataFrame, write: str | Callable[[str, bytes], None], mode: str = "error", buckets: int = BUCKETS) -> None:
    """Writes images (doc_id, path, content) to <write>/bucket=<n>/<doc_id>/<path>, or hands (path, content) to write, on the executors."""
    if isinstance(write, str):
        write_files(images.select(F.concat(_bucketed(_safe(F.col("doc_id")), buckets), F.lit("/"), "path").alias("path"), "content"), write, mode)
        return

    def run(rows):
        for row in rows:
            write(row["path"], bytes(row["content"]))

    images.select("path", "content").where("content is not null").foreachPartition(run)


def write_vectors(chunks: DataFrame, embed: Callable[[DataFrame], DataFrame], path: str, mode: str = "error") -> None:
    """Parquet of (chunk_id, embedding, metadata); embed adds a column embedding (array<float>) to the chunks."""
    meta = [c for c in chunks.columns if c not in ("chunk_id", "embedding")]
    embed(chunks).select("chunk_id", "embedding", F.to_json(F.struct(*meta)).alias("metadata")).write.mode(mode).parquet(path)
