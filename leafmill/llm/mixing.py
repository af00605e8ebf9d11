"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target in words. It first gives as many complete epochs of its documents as the target holds; the
rest is filled in the order of exponential keys, -ln(u) / weight, by prefix sums up to the rest of the target, and the
document at the boundary gives its leading words. u is a hash of the id, so reruns agree.

Prefix sums never run over a whole source in one task: keys fall into bins, as many as keep a bin near `bin_rows` rows
if one source has them all; sums of the bins are accumulated for each source (narrow rows), and within a bin the rows of
one (source, bin) are accumulated. Targets are found by rounds of sums over all sources, also when every host is one.

Cases: null text has size 0; a null source is a source of its own, last; a null weight or one under 0.05 counts as
0.05; rows of size 0 take 0 words; an empty table gives an empty result; equal rows are told apart by nothing and share
one key, so which of them stands at the boundary does not matter.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight of a text: its share of letters and spaces."""
    rest = F.length(F.regexp_replace(text, "[\\p{L} ]+", ""))
    return F.when(F.length(text) > 0, (F.length(text) - rest) / F.length(text)).otherwise(0.0)


def mix(
    df: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: Column | None = None,
    seed: str = "mix",
    bin_rows: int = 10_000,
) -> DataFrame:
    """(doc_id, source, size, weight, source_size, target, taken, epochs) of every row of df.

    Sources in code-point order, null last, weigh `weights`, repeating, and share the words of all rows by weight. No
    target exceeds max_epochs times its source's size; the excess is shared again by weight among the others.
    """
    quality = letter_share(df[text_col]) if quality is None else quality
    docs = df.select(
        df[id_col].alias("doc_id"),
        df[source_col].alias("source"),
        word_count(df[text_col]).alias("size"),
        F.greatest(F.lit(0.05), F.coalesce(quality.cast("double"), F.lit(0.05))).alias("weight"),
    )
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**13)
    keyed = docs.withColumn("key", -F.log(uniform) / F.col("weight"))
    keyed = keyed.withColumn("src", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t")))  # "t": null, after all others
    keyed = materialize(keyed, "mix-keys")
    bins = max(1, keyed.count() // bin_rows) * 4
    keyed = keyed.withColumn("bin", F.floor(F.col("key") / (F.col("key") + 1) * bins).cast("long"))

    by_bin = keyed.groupBy("src", "bin").agg(F.sum("size").alias("bin_size"))
    sources = targets(by_bin.groupBy("src").agg(F.sum("bin_size").alias("source_size")), weights, max_epochs)
    running = Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bounds = by_bin.select("src", "bin", F.coalesce(F.sum("bin_size").over(running), F.lit(0)).alias("before_bin")).join(sources, "src")
    within = Window.partitionBy("src", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("before_doc", F.coalesce(F.sum("size").over(within), F.lit(0))).join(bounds, ["src", "bin"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - epochs * F.col("source_size")).cast("long")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before_bin") - F.col("before_doc")))
    return placed.select(
        "doc_id", "source", "size", "weight", "source_size", "target", (epochs * F.col("size") + part).alias("taken"), epochs.alias("epochs")
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with place: the number of sources before each one by src. Dealt by ranges, counted by range, then in it."""
    dealt = materialize(sources.repartitionByRange("src").sortWithinPartitions("src").withColumn("part", F.spark_partition_id()), "mix-sources")
    sizes = sorted((r["part"], r["n"]) for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row for each partition
    before = list(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0), strict=False))
    offsets = dealt.sparkSession.createDataFrame(before, "part int, before long")
    within = F.row_number().over(Window.partitionBy("part").orderBy("src")) - 1
    return dealt.withColumn("place", within).join(F.broadcast(offsets), "part").withColumn("place", F.col("place") + F.col("before")).drop("part", "before")


def targets(sources: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Adds `target` to (src, source_size).

    A source whose share by weight is over its cap gets the cap, and the others share what is left; repeated until no
    share is over its cap. Each round is one sum over all sources.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = _numbered(sources).withColumn("w", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = materialize(ranked.select("src", "source_size", "w", (F.lit(max_epochs) * F.col("source_size")).alias("cap")), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, before = None, None
    while True:
        over = F.lit(False) if level is None else F.lit(level) * F.col("w") > F.col("cap")
        spent, left, n = ranked.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)), F.sum(F.when(~over, F.col("w"))), F.sum(over.cast("int"))).first()
        if not left or n == before:
            break
        level, before = float(total - spent) / left, n
    share = F.lit(level or 0.0) * F.col("w")
    return ranked.select("src", "source_size", F.when(share <= F.col("cap"), share).otherwise(F.col("cap").cast("double")).alias("target"))
