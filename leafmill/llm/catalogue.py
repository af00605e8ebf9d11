"""Queries of the language-model data operators, each over its whole table, and SQL oracles where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, html_text, jaccard_join, licenses, mixing, quality, secrets, spotsigs, substrings, tokens

#: Vocabulary of the token counts; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_likeness(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), VOCABULARY)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.near_passages(_table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    shown = lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(F.transform("licenses", shown), ",").alias("licenses"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out(labels["doc_id"])))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
with words as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    greatest(0.05::double, case when length(text) > 0
      then (length(text) - length(regexp_replace(text, '[\p{L} ]+', '', 'g')))::double / length(text) else 0 end) as weight
  from documents
), keyed as (
  select *, coalesce('s' || source, 't') as src,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0) / weight as key
  from words
), sources as (
  select src, sum(size)::bigint as source_size, 1 + (row_number() over (order by src) - 1) % 3 as w from keyed group by src
), capped as (
  select *, 3 * source_size as cap, sum(source_size) over ()::double as total from sources
), levels as (
  select *, (total - coalesce(sum(cap) over (order by cap::double / w, src rows between unbounded preceding and 1 preceding), 0)::double)
    / sum(w) over (order by cap::double / w, src rows between current row and unbounded following)::double as level
  from capped
), level as (
  select level from levels where level * w <= cap order by cap::double / w, src limit 1
), targets as (
  select src, source_size, case when level.level * w <= cap then level.level * w else cap::double end as target from levels, level
), placed as (
  select k.doc_id, k.source, k.size, k.weight, t.source_size, t.target,
    case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end::bigint as epochs,
    coalesce(sum(size) over (partition by k.src order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from keyed k join targets t using (src)
)
select doc_id, source, size, weight, source_size, target,
  epochs * size + least(size, greatest(0, floor(target - epochs * source_size)::bigint - before)) as taken, epochs
from placed
"""


OP8_SQL = r"""
with recursive words as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as ws from documents
), grams as (
  select doc_id, unnest(list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end)) as gram
  from words
), sizes as (
  select w.doc_id, count(gram) as n from (select distinct doc_id from words) w left join grams g on g.doc_id = w.doc_id group by w.doc_id
), sized as (
  select g.doc_id, g.gram, n from grams g join sizes using (doc_id) where doc_id is not null
), links as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from sized a join sized b on a.gram = b.gram and a.doc_id <> b.doc_id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach as (
  select doc_id, doc_id as other from sizes union select reach.doc_id, links.b from reach join links on reach.other = links.a
)
select s.doc_id, n as n_shingles, component_id,
  coalesce((select min(l.b) from links l join sizes o on o.doc_id = l.b where l.a = s.doc_id and l.b < s.doc_id and o.n = s.n and l.shared = s.n), s.doc_id) as class_id
from sizes s join (select doc_id, min(other) as component_id from reach group by doc_id) using (doc_id)
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_spotsigs, op2_mixing, op3_token_counts, op4_substrings, op5_licenses, op6_quality, op7_html_text, op8_jaccard_join, op9_secrets, op10_decontaminate)}


def oracle_sql() -> dict:
    return {"op2_mixing": OP2_SQL, "op8_jaccard_join": OP8_SQL}
