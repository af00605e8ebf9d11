"""Corpus pipeline: documents pass five stages, each written as Parquet and read again before the next.

The first four keep the columns of `documents`; the last tells how many words the training mix takes of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.session import materialize
from leafmill.llm import decontaminate, jaccard_join, mixing, quality, secrets


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that names each row, and its name. Written out, so that every later reading sees the same names."""
    name = _unused(docs, "row")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _unused(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (score under 0.3).

    Null texts are rejected. Empty texts are scored as such. Equal texts have equal scores. Other columns, one named score
    too, stay as they are. Without labels of both classes the score is the share of 1 among them.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out(labels["doc_id"])))
    name = _unused(docs, "score")
    return quality.score(docs, model, score_col=name).where((F.col(name) >= 0.3) & F.col("text").isNotNull()).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five-word shingles, similarity 0.8 or more): that with the smallest doc_id.

    Groups are of rows, not of ids: of repeated rows one stays, a row without an id only where no row of its group has
    one, and different texts of one id are judged each by its own. Rows without words are in no group and stay.
    """
    rows, name = _numbered(docs)
    found = jaccard_join.link_components(rows, n=5, percent=80, id_col=name).where("n_shingles > 0")
    found = found.select(F.col("doc_id").alias(name), "component_id").join(rows.select(name, F.col("doc_id").alias("id")), name)
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", F.col(name).alias("at"))
    first = F.min(order).alias("first")
    found = materialize(found, "near-copies")
    kept = found.groupBy("component_id").agg(first).select(F.col("first.at").alias(name))
    copies = found.join(kept, name, "left_anti").select(name)  # by row: a large group is no key of this join
    return decontaminate.semi(rows, materialize(copies, "copies"), name, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, whatever their id; null and empty texts hold none.

    A text is named by its hash, so repeated rows and rows without an id are judged by their text.
    """
    name = _unused(docs, "text_hash")
    named = docs.withColumn(name, F.xxhash64("text"))
    found = decontaminate.leaks(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=name)
    texts = materialize(found.select(F.col("doc_id").alias(name)).distinct(), "leaks")
    return decontaminate.semi(named, texts, name, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark and counts n_chars again; every row stays, null texts as null."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the training mix takes of each document: one row for each, rows without words take 0.

    The weight of a text is its share of letters, as the stages before hand on the columns of documents only.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("drop_near_copies", drop_near_copies),
    ("drop_leaks", drop_leaks),
    ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources),
]
#: The classifier, the lexer and the redaction have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
