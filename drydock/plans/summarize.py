"""Profiles of everything published in a folder."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.config import DATE_COLUMNS, DateRules, Registry
from drydock.operators.footers import FAULTS, footer_facts
from drydock.operators.profile import profile_all
from drydock.session import scratch
from drydock.sinks.parquet import is_published
from drydock.sources.listing import list_files, published_files, published_name, published_names, scan_published


def summarize(spark: SparkSession, root: str, registry: Registry,
              date_columns: Sequence[str] = DATE_COLUMNS, rules: DateRules = DateRules()) -> DataFrame:
    """One profile per ``*.parquet`` dataset of a folder, sorted by name.

    Dataset names come from the listing (a few per folder). What this package
    has published as a whole is measured by its file footers where they settle
    rows and dates; the others are aggregated, all in one pass. Should that pass
    fail, each dataset is measured by itself, and one which cannot be read is
    left out with a warning.
    """
    files = list_files(spark, root, recursive=True).withColumn("dataset", published_name(F.col("path")))
    names = sorted(r["dataset"] for r in published_names(files).collect())
    tables = {}
    for name in names:
        try:
            tables[name] = scan_published(spark, root, name)
        except PySparkException as fault:
            warnings.warn(f"skipped {name}: {fault}", stacklevel=2)
    if not tables:
        raise ValueError(f"no published dataset in {root}")

    groups = {name: published_files(spark, root, name) for name in tables if is_published(spark, root, name)}
    groups = {name: paths for name, paths in groups.items() if paths}
    try:
        known = footer_facts(spark, groups, {n: df.schema for n, df in tables.items()}, date_columns, rules)
    except FAULTS:  # a footer that cannot be read is met again by the scan of its dataset
        known = {}

    def measured(some: dict[str, DataFrame]) -> DataFrame:
        place = scratch(spark, "profile")  # a row per dataset
        profile_all(some, registry, date_columns, rules, files, known).write.parquet(place)
        return spark.read.parquet(place)

    try:
        return measured(tables).orderBy("dataset")
    except FAULTS:
        found = []
        for name, df in tables.items():
            try:
                found.append(measured({name: df}))
            except FAULTS as fault:
                warnings.warn(f"skipped {name}: {fault}", stacklevel=2)
        if not found:
            raise
        return reduce(DataFrame.unionByName, found).orderBy("dataset")
