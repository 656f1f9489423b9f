"""The registered queries of the corpus operators, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.llm import (
    decontaminate, infill, language, mixing, secrets, sharding, shingles, substrings, surrogates, tokens, variants,
    vectors, warc)
from drydock.llm.common import table
from drydock.session import ship_package


#: A fixed key makes the query's result repeatable; real runs keep theirs secret.
SURROGATE_KEY = b"drydock"


def op1_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op3_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.near_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_links", "component_id", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op5_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    fault = F.raise_error(F.concat(F.col("archive"), F.lit(": "), F.col("error")))
    return records.select(F.when(F.col("error").isNull(), F.col("page_id")).otherwise(fault).alias("page_id"),
                          "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.surrogate_texts(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.measured(table(spark, sf_dir, "documents"))
    placed = sharding.place(docs, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"), with_text=False)
    lengths = F.transform("removed", lambda r: r["stop"] - r["start"])
    return found.select("doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b)
                        .alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["learned"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["learned"])).cast("long").alias("n_learned"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.rearranged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_vector_forest, op2_mix_sources, op3_jaccard_forest, op4_language_id, op5_warc_records,
    op6_pii_surrogates, op7_token_counts, op8_decontaminate, op9_shard_documents, op10_suffix_dedup,
    op11_secret_scan, op12_fill_middle, op13_spelling_variants)}

ORACLES = {"op2_mix_sources": mixing.SQL, "op12_fill_middle": infill.SQL, "op13_spelling_variants": variants.SQL}
