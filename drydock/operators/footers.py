"""Row counts and date ranges from Parquet footers, where those settle them.

A scan that only counts, or asks for the least and greatest of integer or date
columns, is answered by Spark's Parquet source from the footers alone
(aggregate push-down): time grows with the number of files, not of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drydock.config import DateRules
from drydock.functions.dates import to_date_time
from drydock.operators.columns import column

#: The lowest and highest whole numbers that can be days, in whose order they are then.
DAYS = (1000_01_01, 9999_12_31)

#: A failed job is raised as the one or the other.
FAULTS = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class FooterFacts:
    rows: int
    low: dt.datetime | None
    high: dt.datetime | None


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's whose Parquet source answers from footers; the caller's settings stay."""
    beside = spark.newSession()
    sources = beside.conf.get("spark.sql.sources.useV1SourceList").split(",")
    beside.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s.strip() != "parquet"))
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def _asked(schema: T.StructType, date_columns: Sequence[str]) -> str | None:
    """The date column that comes first, if footers can tell its range; '' if there is none at all."""
    first = next((n for n in date_columns if n in schema.names), "")
    if not first or isinstance(schema[first].dataType, (T.IntegralType, T.DateType)):
        return first
    return None


def footer_scan(beside: SparkSession, paths: Sequence[str], dataset: str, name: str) -> DataFrame:
    """``dataset, rows, filled, low, high, low_day, high_day``: one row, aggregated by the source itself."""
    df = beside.read.parquet(*paths)
    asked = [F.count(F.lit(1)).alias("rows")]
    if name:
        asked += [F.min(column(name)).alias("low"), F.max(column(name)).alias("high")]
    found = df.agg(*asked)
    is_day = name and isinstance(df.schema[name].dataType, T.DateType)
    none = F.lit(None)
    return found.select(
        F.lit(dataset).alias("dataset"), "rows",
        *[(F.col(end).cast("bigint") if name and not is_day else none.cast("bigint")).alias(end) for end in ("low", "high")],
        *[(F.col(end).cast("date") if is_day else none.cast("date")).alias(f"{end}_day") for end in ("low", "high")])


def footer_facts(spark: SparkSession, files: Mapping[str, Sequence[Sequence[str]]], schemas: Mapping[str, T.StructType],
                 date_columns: Sequence[str], rules: DateRules = DateRules()) -> dict[str, FooterFacts]:
    """Facts of the datasets for which footers settle them; the others have to be scanned.

    ``files`` gives for each dataset groups of paths; the files of a group have
    one schema, as those of one write have. Settled is a dataset without a date
    column, or whose first one holds integers or dates with both ends valid: no
    valid date can then lie outside them, as whole numbers of eight digits order
    as their days do. Columns with any end that is no date, such as year 9999,
    timestamps and texts are left to a scan, and so is a dataset with a file
    whose footer names no ends, as that of a row group without any value. A row per group of files reaches
    the driver.
    """
    ordered = rules.rewrites[:1] == DateRules().rewrites[:1]  # eight digits are year, month and day
    asked = {n: _asked(schemas[n], date_columns) for n in files}
    beside = footer_session(spark)
    scans: dict[str, list[DataFrame]] = {}
    for dataset, groups in files.items():
        name = asked[dataset]
        if name is None or (name and not ordered and not isinstance(schemas[dataset][name].dataType, T.DateType)):
            continue
        for paths in groups:
            held = name if name in beside.read.parquet(*paths).columns else ""
            scans.setdefault(dataset, []).append(footer_scan(beside, paths, dataset, held))

    def ends(found: Iterable[DataFrame]) -> list:
        both = reduce(DataFrame.unionAll, found).groupBy("dataset").agg(
            F.sum("rows").alias("rows"), *[f(c).alias(c) for f, c in (
                (F.min, "low"), (F.max, "high"), (F.min, "low_day"), (F.max, "high_day"))])
        some = F.col("low").isNotNull() | F.col("low_day").isNotNull()
        return both.select("dataset", "rows", some.alias("some"), _date("low", rules).alias("from"),
                           _date("high", rules).alias("to")).collect()

    if not scans:
        return {}
    try:
        settled = ends(scan for own in scans.values() for scan in own)
    except FAULTS:  # some file has no value in a row group, for which its footer has no ends
        settled = []
        for own in scans.values():
            try:
                settled += ends(own)
            except FAULTS:
                continue
    return {r["dataset"]: FooterFacts(r["rows"], r["from"], r["to"]) for r in settled
            if (not asked[r["dataset"]] or (r["some"] and r["from"] is not None and r["to"] is not None))}


def _date(end: str, rules: DateRules) -> Column:
    whole = F.when(F.col(end).between(*DAYS), F.col(end))
    return F.coalesce(to_date_time(whole, T.LongType(), rules), to_date_time(F.col(f"{end}_day"), T.DateType(), rules))
