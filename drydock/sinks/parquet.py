"""Described Parquet, and the metadata tables beside it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from drydock.session import create_file, path_exists, remove_path
from drydock.sinks.versions import WHOLE, Delivery, Manifest, add_files, read_manifest, sweep, write_manifest
from drydock.sources.listing import column_catalog, described_columns


def is_published(spark: SparkSession, root: str, dataset: str) -> bool:
    """Whether a dataset is there as a whole. Its properties are written last,
    so they are the mark; a table that was left half written has none."""
    base = root.rstrip("/")
    return all(path_exists(spark, f"{base}/{place}/_SUCCESS") for place in (f"{dataset}.parquet", f"_datasets/{dataset}"))


def publish(df: DataFrame, root: str, dataset: str, properties: Mapping[str, str] | None = None,
            existing: Mapping[str, str] | None = None, mode: str = "overwrite") -> str:
    """Write ``{root}/{dataset}.parquet`` (snappy) and its metadata.

    The new files are written beside the old ones, and a manifest makes them the
    current version once they are whole; then the old ones are deleted. Wherever
    a writer stops, ``scan_published`` reads the old version or the new one.
    Column descriptions travel in the schema; they and the dataset's properties
    are also written to ``_columns`` and ``_datasets``, which any tool can read.
    Properties that are there already stay unless new ones replace them
    (``existing`` names others to start from). The properties come last, and
    mark the dataset as complete. ``mode="ignore"`` leaves a complete dataset
    and its metadata alone.
    """
    spark, base = df.sparkSession, root.rstrip("/")
    path, mark = f"{base}/{dataset}.parquet", f"{base}/_datasets/{dataset}"
    there = is_published(spark, base, dataset)
    if there and mode == "ignore":
        return path
    if there and mode in ("error", "errorifexists"):
        raise ValueError(f"{dataset} is published already")
    if existing is None:
        existing = read_properties(spark, base, dataset) if there else {}
    current = read_manifest(spark, path)
    if current:  # what a writer that stopped has left
        sweep(spark, path, current)
    rows = Observation()
    files = add_files(spark, df.observe(rows, F.count(F.lit(1)).alias("rows")), path)
    remove_path(spark, f"{path}/_SUCCESS")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    manifest = Manifest(current.version + 1 if current else 1, df.schema,
                        (Delivery(WHOLE, files, rows.get.get("rows", 0), types),))
    write_manifest(spark, path, manifest)
    remove_path(spark, f"{path}/_common_metadata")  # all files have the schema
    sweep(spark, path, manifest)
    create_file(spark, f"{path}/_SUCCESS", "")
    remove_path(spark, mark)
    describe_published(df, base, dataset, properties, existing)
    return path


def describe_published(df: DataFrame, root: str, dataset: str, properties: Mapping[str, str] | None = None,
                       existing: Mapping[str, str] | None = None) -> int:
    """Write the metadata beside a published table, the properties, which mark it as complete, last;
    returns the number of described columns."""
    spark, base = df.sparkSession, root.rstrip("/")
    if existing is None:
        existing = read_properties(spark, base, dataset) if is_published(spark, base, dataset) else {}
    column_catalog(df, dataset).coalesce(1).write.mode("overwrite").parquet(f"{base}/_columns/{dataset}")
    rows = [(dataset, k, v) for k, v in sorted({**existing, **(properties or {})}.items())]
    (spark.createDataFrame(rows, "dataset string, property string, value string")
     .coalesce(1).write.mode("overwrite").parquet(f"{base}/_datasets/{dataset}"))
    return described_columns(df.schema)


def publish_table(df: DataFrame, table: str, description: str, properties: Mapping[str, str],
                  mode: str = "overwrite") -> None:
    """Publish to the catalog: comment and table properties on the table,
    descriptions as column comments."""
    spark = df.sparkSession
    df.write.mode(mode).format("parquet").option("compression", "snappy").saveAsTable(table)

    def literal(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"COMMENT ON TABLE {table} IS {literal(description)}")
    pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
    if pairs:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def read_column_catalog(spark, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/_columns/{dataset}")


def read_properties(spark, root: str, dataset: str) -> dict[str, str]:
    rows = spark.read.parquet(f"{root.rstrip('/')}/_datasets/{dataset}").collect()
    return {r["property"]: r["value"] for r in rows}
