"""Registered queries of the package and the SQL of those that SQL can
express.  Each applies one operator, with its production parameters, to its
whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import (alignment, exact_dedup, language, mixing, near_join, packing, pii, quality, simhash, spelling,
                           token_counts, token_ids, topk)
from tidewater.session import prepare
from tidewater.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf, name)


@query
def op7_packing(spark, sf):
    return packing.pack_tokens(_t(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(_t(spark, sf, "documents"))


ORACLE["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id ASC NULLS LAST) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM r
"""


@query
def op10_mixing(spark, sf):
    return mixing.mix(_t(spark, sf, "documents"))


@query
def op3_token_counts(spark, sf):
    return token_counts.token_counts(_t(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_token_shards(spark, sf):
    files = token_ids.token_shards(_t(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_ids.read_shards(files)


@query
def op5_language(spark, sf):
    return language.identify(_t(spark, sf, "documents"))


@query
def op2_quality(spark, sf):
    return quality.score_quality(_t(spark, sf, "documents"), _t(spark, sf, "labels"))


@query
def op1_pii(spark, sf):
    return pii.find_pii(_t(spark, sf, "documents"))


@query
def op6_topk(spark, sf):
    return topk.top_k(_t(spark, sf, "embeddings"))


ORACLE["op6_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op4_near_join(spark, sf):
    return near_join.near_duplicates(_t(spark, sf, "documents"))


@query
def op11_spelling(spark, sf):
    return spelling.spelling_variants(_t(spark, sf, "documents"))


@query
def op12_alignment(spark, sf):
    return alignment.align_tokenizers(_t(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_simhash(spark, sf):
    return simhash.simhash_components(_t(spark, sf, "documents"))
