"""File listings, published tables and their descriptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drydock.config import FILE_CLASSES, Registry
from drydock.functions.text import file_name, glob_to_regex
from drydock.sinks.versions import folder_of, read_manifest, scan_versioned

LISTING_SCHEMA = "path string, modified timestamp, length bigint"


def list_files(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Files of a folder as ``(path, modified, length)``; none if it is missing.

    Only the listing is read: the ``content`` column is pruned from the scan.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.load(root)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def file_class(path: Column, classes: Mapping[str, Sequence[str]] = FILE_CLASSES) -> Column:
    """The first class with a pattern matching the file's name, else null."""
    label = F.lit(None).cast("string")
    for name, patterns in reversed(list(classes.items())):
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | file_name(path).rlike(glob_to_regex(pattern))
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label


def match_files(files: DataFrame, classes: Mapping[str, Sequence[str]] = FILE_CLASSES) -> DataFrame:
    """Files of a known class, each once, however many patterns match it."""
    return (files.withColumn("file_class", file_class(F.col("path"), classes))
            .filter(F.col("file_class").isNotNull()))


def is_archive(path: Column) -> Column:
    return F.lower(file_name(path)).rlike(r"\.zip\z")


def list_archives(spark: SparkSession, root: str) -> DataFrame:
    """Archives lying directly in a folder, whatever the case of ``.zip``."""
    return list_files(spark, root).filter(is_archive(F.col("path")))


def union_distinct_paths(*listings: DataFrame) -> DataFrame:
    """Set union of listings by path (a file named by two patterns counts once)."""
    merged = listings[0]
    for other in listings[1:]:
        merged = merged.unionByName(other)
    return merged.dropDuplicates()


def dataset_catalog(spark: SparkSession, registry: Registry, base_url: str = "") -> DataFrame:
    """Registry rows: what can be fetched, under which name."""
    base = base_url.rstrip("/")
    rows = [(i, d.name, d.file_name, d.landing_note or d.description, d.description,
             d.dict_table, d.archive_pattern, f"{base}/{d.file_name}" if base else d.file_name)
            for i, d in enumerate(registry)]
    return spark.createDataFrame(
        rows, "priority int, dataset string, file string, landing_note string, "
              "description string, dict_table string, archive_pattern string, location string")


def scan_published(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """A published table; of one that is kept in versions, the current version and nothing else."""
    folder = folder_of(root, dataset)
    manifest = read_manifest(spark, folder)
    return spark.read.parquet(folder) if manifest is None else scan_versioned(spark, folder, manifest)


def published_files(spark: SparkSession, root: str, dataset: str) -> list[list[str]]:
    """The paths of a published table in groups whose files were written alike: those of each delivery, or all."""
    folder = folder_of(root, dataset)
    manifest = read_manifest(spark, folder)
    if manifest is None:
        return [[folder]]
    return [[f"{folder}/{name}" for name in d.files] for d in manifest.deliveries if d.files]


def published_name(path: Column) -> Column:
    """The dataset a Parquet file, or a file in a Parquet folder, belongs to."""
    name = F.regexp_extract(path, r"([^/]+)\.parquet(?:/.*)?\z", 1)
    return F.when(~path.contains("/_incoming"), F.nullif(name, F.lit("")))


def published_names(files: DataFrame) -> DataFrame:
    """Dataset names among listed Parquet files and folders."""
    names = files.select(published_name(F.col("path")).alias("dataset"))
    return names.filter(F.col("dataset").isNotNull()).distinct()


def column_catalog(df: DataFrame, dataset: str = "") -> DataFrame:
    """``(dataset, position, column, type, description)`` of a table's schema."""
    rows = [(dataset, i, f.name, f.dataType.simpleString(), f.metadata.get("description"))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "dataset string, position int, column string, type string, description string")


def described_columns(schema: T.StructType) -> int:
    return sum(1 for f in schema.fields if "description" in f.metadata)
