"""What has landed against what is expected, and what the files weigh."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from drydock.config import Registry
from drydock.functions.text import file_name, megabytes, megabytes_text
from drydock.operators.lookups import exclude, lookup


def select_datasets(registry: Registry, keys: Iterable[str] | None = None) -> Registry:
    """The requested part of a registry (default all); unknown keys are refused."""
    if keys is None:
        return registry
    keys = list(keys)
    unknown = sorted(set(keys) - set(registry.names()))
    if unknown:
        raise ValueError(f"not registered: {', '.join(unknown)}")
    return Registry(tuple(registry.get(k) for k in dict.fromkeys(keys)))


def select_keys(expected: DataFrame, key: str, keys: Sequence[str]) -> DataFrame:
    return expected.filter(F.col(key).isin(list(keys)))


def unknown_keys(requested: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Requested keys which are not expected at all."""
    return exclude(requested, expected, [key])


def landed_archives(files: DataFrame) -> DataFrame:
    """Listed files by name, with their size."""
    return files.groupBy(file_name(F.col("path")).alias("file")).agg(F.sum("length").alias("length"))


def reconcile(expected: DataFrame, landed: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Expected rows with ``status``: what is there is kept, the rest is to
    fetch; ``force`` fetches everything. ``landed`` has one ``length`` per key."""
    sizes = landed.select(key, "length")
    joined = lookup(expected, sizes, [key])
    there = F.col("length").isNotNull() & F.lit(not force)
    note = F.concat(F.lit("Already exists ("),
                    megabytes_text(F.col("length"), 2), F.lit(" MB)"))
    return joined.withColumn("status", F.when(there, "present").otherwise("fetch")).withColumn(
        "message", F.when(there, note).otherwise(F.lit("")))


def skip_or_force(work: DataFrame, published: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Work still to do: all of it under ``force``, else what is not published."""
    return work if force else exclude(work, published, [key])


def inventory_totals(files: DataFrame) -> DataFrame:
    """Files and megabytes per class, and over all classes (class ``total``).

    The total is taken over the few class rows, and is there even if no file is.
    """
    by_class = files.groupBy("file_class").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    total = by_class.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
                         F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    both = by_class.unionByName(total.select(F.lit("total").alias("file_class"), "files", "bytes"))
    return both.withColumn("size_mb", megabytes(F.col("bytes")))


def deletion_preview(files: DataFrame) -> DataFrame:
    """The dry-run lines: which file would go, and how large it is."""
    return files.select(
        "file_class", file_name(F.col("path")).alias("file"),
        megabytes_text(F.col("length"), 1).alias("size_mb"))


def ingest_report(outcomes: DataFrame) -> DataFrame:
    """Archives per status and dataset.

    The groups are bounded by the registry; failed archives without a dataset
    form one group. ``failures`` lists them one per row.
    """
    return (outcomes.groupBy("status", F.coalesce("dataset", F.lit("")).alias("dataset"))
            .agg(F.count("*").alias("archives"))
            .orderBy("status", "dataset"))


def failures(outcomes: DataFrame) -> DataFrame:
    """Failed archives by name of dataset, or of file where there is none."""
    return (outcomes.filter(F.col("status") == "error")
            .select(F.coalesce("dataset", file_name(F.col("path"))).alias("name"), "path", "message"))


def all_succeeded(outcomes: DataFrame) -> DataFrame:
    """One row: counts per status, and whether nothing failed."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "error")]
    return outcomes.agg(*counts).withColumn("ok", F.col("error") == 0)
