"""The corpus pipeline: a table of documents in, a clean, mixed and sharded training corpus out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept. All but the last return the columns of ``docs``, whatever
they are besides doc_id, text, lang and source. Null and empty texts leave with
the first stage, as no language can be told; an empty table passes through all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from drydock.llm import decontaminate, language, mixing, sharding, shingles
from drydock.llm.common import staged, table
from drydock.session import ship_package

SHARDS = 24
#: The share of a text's words that its language must have: more than one language cannot hold half of them.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language, which the random field (4) finds in half of their words at least; the others go.
    From here on ``lang`` is the language found, whatever the document came with."""
    ship_package(spark)
    return language.relabelled(docs, language.learn(docs), least=LEAST_SHARE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (3), that with the least id."""
    ship_package(spark)
    return shingles.distinct_texts(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs (8)."""
    ship_package(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to meet their source's target (2); no document stays that its source does not need."""
    ship_package(spark)
    return mixing.emit(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot (9); shard sizes differ by one row at most."""
    ship_package(spark)
    return sharding.place(docs, [docs[f"`{c}`"] for c in docs.columns], shards=SHARDS)


STAGES = [("identify_language", identify_language), ("remove_near_duplicates", remove_near_duplicates),
          ("remove_benchmark", remove_benchmark), ("mix_sources", mix_sources), ("shard", shard)]

#: Languages come from a model that is trained, and groups from hashed signatures: no SQL gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
