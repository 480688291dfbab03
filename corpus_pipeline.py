"""A training corpus from ``documents``: language identification, exact
deduplication, near-duplicate removal, mixing to target weights, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of documents.

* language: documents without a letter, or too far from every language's
  centroids, go;
* exact: of texts that are equal without white space one document stays;
* near: of each group linked by 5-word shingles at Jaccard 0.8 the document
  with the smallest id stays;
* mix: sources are taken by their target weights; a document that is taken
  more than once is repeated, one that is not taken goes;
* pack: length bucket (in tokens), batch and place of every document row that
  is left.

Cases.  A null text counts as empty: it has no letter and goes with the first
stage, as empty and blank texts do.  A null id, language or source is a value
like others: the row goes through every stage (source null has its own share).
Ties: of equal texts the longest original and then the smallest id stays, a
null id last, of near ones the smallest id; a row without an id has no near
copies.  Rows that repeat id and text stay
once after exact; rows that repeat an id with different texts are kept apart
there, and near keeps every row of the smallest id of a group.  An empty table,
or a stage that keeps nothing, gives empty tables from there on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import exact_dedup, language, mixing, near_join, packing
from tidewater.llm.common import written
from tidewater.session import prepare
from tidewater.sources.tables import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_join.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", identify_language), ("exact", drop_exact_copies), ("near", drop_near_copies),
          ("mix", mix_sources), ("pack", pack)]

# The language model and the hash thresholds are not SQL; tests/llm compares
# every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one returns."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
