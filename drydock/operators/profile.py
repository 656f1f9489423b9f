"""Profiles of datasets: rows, variables, descriptions, size, date coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from drydock.config import DATE_COLUMNS, UNKNOWN_DATASET, DateRules, Registry
from drydock.functions.dates import date_text, to_date_time
from drydock.functions.text import megabytes
from drydock.operators.columns import column
from drydock.operators.footers import FooterFacts
from drydock.sources.listing import described_columns

PROFILE_COLUMNS = ("dataset", "description", "rows", "variables", "with_descriptions",
                   "size_mb", "date_min", "date_max", "file")


def description_of(dataset: str, registry: Registry) -> str:
    return next((d.description for d in registry if d.name == dataset), UNKNOWN_DATASET)


def valid_dates(df: DataFrame, name: str, rules: DateRules = DateRules()) -> DataFrame:
    """Rows whose value in a column is a date in the valid range."""
    return (df.withColumn("date", to_date_time(column(name), df.schema[name].dataType, rules))
            .filter(F.col("date").isNotNull()))


def profile(df: DataFrame, dataset: str, registry: Registry = Registry(()),
            date_columns: Sequence[str] = DATE_COLUMNS, rules: DateRules = DateRules()) -> DataFrame:
    """One row about a dataset."""
    return profile_all({dataset: df}, registry, date_columns, rules)


def _candidate_dates(df: DataFrame, dataset: str, width: int, date_columns, rules) -> DataFrame:
    """Every row as its dataset's name and its candidate dates, in order."""
    present = [n for n in date_columns if n in df.columns]
    dates = [to_date_time(column(n), df.schema[n].dataType, rules) for n in present]
    dates += [F.lit(None).cast("timestamp_ntz")] * (width - len(dates))
    return df.select(F.lit(dataset).alias("dataset"), *[d.alias(f"d{i}") for i, d in enumerate(dates)])


def _measured(tables: Mapping[str, DataFrame], date_columns, rules) -> DataFrame:
    """``dataset, rows, range`` of each dataset, of which every row is looked at."""
    width = max(sum(n in df.columns for n in date_columns) for df in tables.values())
    facts = reduce(DataFrame.unionByName, [
        _candidate_dates(df, name, width, date_columns, rules) for name, df in tables.items()])
    found = facts.groupBy("dataset").agg(
        F.count("*").alias("rows"),
        *[F.struct(F.min(f"d{i}").alias("low"), F.max(f"d{i}").alias("high")).alias(f"d{i}")
          for i in range(width)])
    ranges = [F.when(F.col(f"d{i}")["low"].isNotNull(), F.col(f"d{i}")) for i in range(width)]
    nothing = F.lit(None).cast("struct<low:timestamp_ntz,high:timestamp_ntz>")
    return found.select("dataset", "rows", F.coalesce(*ranges, nothing).alias("range"))


def profile_all(tables: Mapping[str, DataFrame], registry: Registry = Registry(()),
                date_columns: Sequence[str] = DATE_COLUMNS, rules: DateRules = DateRules(),
                files: DataFrame | None = None, known: Mapping[str, FooterFacts] | None = None) -> DataFrame:
    """Profiles of several datasets, sorted by name.

    The date range of a dataset is that of its first date column with any valid
    date. All datasets and all candidate columns are measured in one pass which
    reads nothing but the date columns; each task sends one small row per
    dataset it met. ``files`` (``dataset, length``) gives the sizes, and
    ``known`` the facts of datasets that need not be measured.
    """
    spark = next(iter(tables.values())).sparkSession
    told = {name: facts for name, facts in (known or {}).items() if name in tables}
    measured = spark.createDataFrame([(name, f.rows, (f.low, f.high)) for name, f in sorted(told.items())],
                                     "dataset string, rows bigint, range struct<low:timestamp_ntz,high:timestamp_ntz>")
    open_ = {name: df for name, df in tables.items() if name not in told}
    if open_:
        measured = _measured(open_, date_columns, rules).unionByName(measured)
    listed = spark.createDataFrame(
        [(name, description_of(name, registry), len(df.columns), described_columns(df.schema),
          f"{name}.parquet") for name, df in tables.items()],
        "dataset string, description string, variables int, with_descriptions int, file string")
    # An empty dataset has no measured row, so the list of datasets leads.
    profiles = (
        listed.join(measured, "dataset", "left")
        .select("dataset", "description", F.coalesce("rows", F.lit(0)).alias("rows"), "variables",
                "with_descriptions", F.lit(None).cast("double").alias("size_mb"),
                F.col("range")["low"].alias("date_min"), F.col("range")["high"].alias("date_max"), "file"))
    return (profiles if files is None else with_sizes(profiles, files)).orderBy("dataset")


def with_sizes(profiles: DataFrame, files: DataFrame) -> DataFrame:
    """Fill ``size_mb`` from listed files ``(dataset, length)``."""
    sizes = files.groupBy("dataset").agg(F.sum("length").alias("_bytes"))
    return (profiles.join(sizes, "dataset", "left")
            .withColumn("size_mb", megabytes(F.col("_bytes"))).select(*PROFILE_COLUMNS))


def profile_totals(profiles: DataFrame) -> DataFrame:
    return profiles.agg(
        F.count("*").alias("datasets"), F.sum("rows").cast("bigint").alias("rows"),
        F.sum("size_mb").alias("size_mb"))


def datasets_with_dates(profiles: DataFrame) -> DataFrame:
    return profiles.filter(F.col("date_min").isNotNull())


def date_coverage(profiles: DataFrame) -> DataFrame:
    """``(dataset, date_min, date_max)`` as text, for datasets with dates."""
    return datasets_with_dates(profiles).select(
        "dataset", date_text(F.col("date_min"), "N/A").alias("date_min"),
        date_text(F.col("date_max"), "N/A").alias("date_max"))


def export_profile(profiles: DataFrame) -> DataFrame:
    """Profiles with dates as text, empty where there is none."""
    return profiles.select(*[
        date_text(F.col(c)).alias(c) if c in ("date_min", "date_max") else F.col(c)
        for c in profiles.columns])


def profile_report(profiles: DataFrame) -> DataFrame:
    """One printable line per dataset, with thousands separators."""
    return profiles.select(
        "dataset", F.format_number("rows", 0).alias("rows"), "variables", "with_descriptions",
        F.format_string("%.1f", F.bround("size_mb", 1)).alias("size_mb"))
