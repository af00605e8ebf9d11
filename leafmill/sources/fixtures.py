"""Deterministic inputs for the document operators, made from the driver's tables.

Documents in the test data hold no markdown and no table holds page geometry; these views give the operators both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = """
case cast((doc_id * 7 + ln) % 16 as int)
 when 0 then concat('## ', substr(raw, 1, 40))
 when 2 then concat('![Figure ', ln, '](images/page', 1 + (doc_id + ln) % 9, '_fig1.png)')
 when 3 then concat('*Figure ', ln, '. ', substr(raw, 1, 30), '*')
 when 4 then ''
 when 5 then concat('Table ', 1 + ln % 7, '. ', substr(raw, 1, 50))
 when 6 then '| h1 | h2 | h3 |'
 when 7 then '|----|----|----|'
 when 8 then concat('| ', substr(raw, 1, 8), ' | ', ln, ' |  |')
 when 9 then ''
 when 11 then concat('- ', raw)
 when 12 then concat('2) ', raw)
 when 13 then '<!-- formula-not-decoded -->'
 when 14 then concat('### ', substr(raw, 1, 25))
 else raw end
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md(doc_id, source_file, text): each document's lines turned into markdown."""
    text = F.expr(f"array_join(transform(split(text, '\\n'), (raw, ln) -> {_LINE}), '\\n')")
    docs = read(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"), text.alias("text"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """words(doc_id, page, word_id, text, x0, x1, top, bottom): rows of `part` as a four-column page layout."""
    part = read(spark, sf_dir, "part")
    cells = part.select(
        F.expr("1 + cast(floor((p_partkey - 1) / 20) as int)").alias("page"),
        "p_partkey",
        F.posexplode(F.array("p_brand", "p_type", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"))).alias("col", "txt"),
    )
    top = "100 + ((p_partkey - 1) % 20) * 14 + (p_partkey + col) % 3 + case when (p_partkey - 1) % 20 >= 10 then 40 else 0 end"
    placed = cells.select(
        F.lit("part").alias("doc_id"),
        "page",
        (F.col("p_partkey") * 4 + F.col("col")).alias("word_id"),
        F.col("txt").alias("text"),
        F.expr("cast(72 + col * 110 + (p_partkey * 3 + col) % 4 as double)").alias("x0"),
        F.expr(f"cast({top} as double)").alias("top"),
    )
    return placed.select("doc_id", "page", "word_id", "text", "x0", (F.col("x0") + 5.0 * F.length("text")).alias("x1"), "top", (F.col("top") + 10.0).alias("bottom"))


def graphics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """graphics(doc_id, page, obj_id, top, bottom, x0, x1) from `orders`."""
    return read(spark, sf_dir, "orders").select(
        F.lit("orders").alias("doc_id"),
        F.expr("cast(floor(o_orderkey / 10) as int)").alias("page"),
        F.col("o_orderkey").alias("obj_id"),
        F.expr("cast((o_custkey * 37) % 750 as double)").alias("top"),
        F.expr("cast((o_custkey * 37) % 750 + o_orderkey % 45 as double)").alias("bottom"),
        F.expr("cast(50 + (o_custkey % 5) * 60 as double)").alias("x0"),
        F.expr("cast(80 + (o_custkey % 5) * 60 + o_orderkey % 50 as double)").alias("x1"),
    )


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """captions(doc_id, page, cap_id, top, bottom, x0, x1, text) from `customer`."""
    return read(spark, sf_dir, "customer").select(
        F.lit("orders").alias("doc_id"),
        F.col("c_custkey").cast("int").alias("page"),
        F.col("c_custkey").alias("cap_id"),
        F.expr("cast((c_custkey * 53) % 760 as double)").alias("top"),
        F.expr("cast((c_custkey * 53) % 760 + 10 as double)").alias("bottom"),
        F.lit(60.0).alias("x0"),
        F.lit(420.0).alias("x1"),
        F.expr("concat('Figure ', 1 + c_custkey % 9, '. ', c_name)").alias("text"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two sets of vertical intervals (doc_id, page, id, top, bottom); a page holds what 60 order keys have."""
    left = read(spark, sf_dir, "lineitem")
    left = left.selectExpr("'boxes' as doc_id", "cast(floor(l_orderkey / 60) as int) as page", "l_orderkey * 10 + l_linenumber as id", "l_quantity * 12.0D as top", "l_quantity * 12.0D + 20 + 10 * l_linenumber as bottom")
    right = read(spark, sf_dir, "orders")
    right = right.selectExpr("'boxes' as doc_id", "cast(floor(o_orderkey / 60) as int) as page", "o_orderkey as id", "(o_orderkey % 50) * 12.0D as top", "(o_orderkey % 50) * 12.0D + 20 + 10 * (o_custkey % 7) as bottom")
    return left, right
