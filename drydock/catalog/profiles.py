"""Registered queries: profiles and date coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.catalog.common import DESCRIPTIONS, TABLE_REGISTRY, TABLES, table
from drydock.config import UNKNOWN_DATASET
from drydock.operators.profile import (
    PROFILE_COLUMNS, date_coverage, export_profile, profile, profile_all, profile_totals, valid_dates)
from drydock.operators.describe import attach_descriptions
from drydock.plans.summarize import summarize
from drydock.session import scratch
from drydock.sinks.parquet import publish
from drydock.sinks.text import export_profile_csv

DATES = ("o_orderdate", "l_shipdate", "ts")
_DATE_OF = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
_WIDTH = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
          "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
          "conversations": 4}


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    return profile_all(tables, TABLE_REGISTRY, DATES).drop("size_mb")


def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)


def _profile_sql(name: str) -> str:
    date = _DATE_OF.get(name)
    low, high = (f"min({date})", f"max({date})") if date else ("NULL::TIMESTAMP", "NULL::TIMESTAMP")
    text = DESCRIPTIONS.get(name, UNKNOWN_DATASET)
    return (f"SELECT '{name}' AS dataset, '{text}' AS description, count(*)::BIGINT AS rows, "
            f"{_WIDTH[name]}::INTEGER AS variables, 0::INTEGER AS with_descriptions, "
            f"{low} AS date_min, {high} AS date_max, '{name}.parquet' AS file FROM {name}")


PROFILES_SQL = " UNION ALL ".join(_profile_sql(name) for name in TABLES)


def _sized_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with sizes from a listing: each document counts as a file of some table."""
    names = F.array(*[F.lit(n) for n in TABLES])
    files = table(spark, sf_dir, "documents").select(
        F.element_at(names, (F.col("doc_id") % len(TABLES) + 1).cast("int")).alias("dataset"),
        F.col("n_chars").alias("length"))
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    return profile_all(tables, TABLE_REGISTRY, DATES, files=files)


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized_profiles(spark, sf_dir).select("dataset", "rows", "size_mb")


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_totals(_sized_profiles(spark, sf_dir))


def profile_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles written as CSV and read back as text."""
    path = scratch(spark, "profile")
    export_profile_csv(_sized_profiles(spark, sf_dir), path)
    found = spark.read.option("header", "true").option("escape", '"').csv(path)
    return found.select("dataset", "description", "rows", "variables", "file", *[
        F.coalesce(c, F.lit("")).alias(c) for c in ("date_min", "date_max")])


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of orders written in many ways, one of which is no date."""
    day = F.col("o_orderdate")
    forms = [F.date_format(day, "MM/dd/yyyy hh:mm:ss a"), F.date_format(day, "yyyy/MM/dd"),
             F.date_format(day, "dd-MMM-yyyy"), F.upper(F.date_format(day, "d MMMM yyyy")),
             F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
             F.concat(F.date_format(day, "yyyy-MM-dd HH:mm"), F.lit("+02:00")), F.date_format(day, "dd-'Foo'-yyyy")]
    text = F.element_at(F.array(*forms), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    return valid_dates(orders, "day").select("o_orderkey", "date")


def first_valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first date column holds no date, the second has sentinels, the third is later."""
    orders = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")
    df = orders.select(
        F.col("o_orderpriority").alias("D_DT_START"),
        F.when(F.col("o_orderstatus") == "F", "12/31/9999 00:00:00").otherwise(text).alias("D_DT_END"),
        F.col("o_orderdate").alias("D_DT_OPEN"))
    return profile(df, "orders", TABLE_REGISTRY).select("dataset", "rows", "date_min", "date_max")


def integer_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates kept as YYYYMMDD integers, with an open-ended sentinel."""
    day = F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    df = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 99991231).otherwise(day).alias("DT_START"))
    return profile(df, "lineitem", TABLE_REGISTRY).select("dataset", "rows", "date_min", "date_max")


def dates_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text is a date, in one of several formats."""
    orders = table(spark, sf_dir, "orders")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyyMMdd"))
            .otherwise(F.col("o_orderpriority")))
    return valid_dates(orders.select("o_orderkey", text.alias("day")), "day").select("o_orderkey", "date")


def export_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_profile(_profiles(spark, sf_dir)).select("dataset", "rows", "date_min", "date_max")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_coverage(_profiles(spark, sf_dir))


def published_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Described tables are published, then everything published is profiled."""
    out = scratch(spark, "published")
    for name, texts in {"orders": {"o_orderkey": "Key of the order", "o_orderdate": "Day of the order"},
                        "events": {"ts": "Time of the event"}, "part": {}}.items():
        publish(attach_descriptions(table(spark, sf_dir, name), texts), out, name)
    return summarize(spark, out, TABLE_REGISTRY, DATES).select(
        *[c for c in PROFILE_COLUMNS if c != "size_mb"], (F.col("size_mb") > 0).alias("has_size"))


def footer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers as days, days as dates and no dates at all, told by file footers; a sentinel and
    timestamps beside them, which are scanned."""
    out = scratch(spark, "published")
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    day = F.date_format("l_shipdate", "yyyyMMdd").cast("bigint")
    for name, df in {
            "lineitem": lines.select("l_orderkey", F.when(F.col("l_returnflag") != "R", day).alias("DT_START")),
            "orders": orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("DT_START")),
            "part": table(spark, sf_dir, "part"),
            "supplier": lines.select(F.when(F.col("l_returnflag") == "R", 99991231).otherwise(day).alias("DT_START")),
            "events": table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("DT_START"))}.items():
        publish(df, out, name)
    return summarize(spark, out, TABLE_REGISTRY).select("dataset", "rows", "date_min", "date_max")


def _published_sql() -> str:
    described = {"events": 1, "orders": 2, "part": 0}
    return " UNION ALL ".join(
        f"SELECT * REPLACE ({n}::INTEGER AS with_descriptions), true AS has_size FROM ({_profile_sql(name)})"
        for name, n in described.items())


QUERIES = {
    "profile_tables": profile_tables,
    "profile_totals": totals,
    "profile_sizes": sizes,
    "profile_csv": profile_csv,
    "date_texts": date_texts,
    "profile_first_valid_date": first_valid_date,
    "profile_integer_dates": integer_dates,
    "valid_dates_only": dates_kept,
    "profile_export_dates": export_dates,
    "date_coverage": coverage,
    "published_profile": published_profile,
    "profile_footers": footer_profile,
}

ORACLES = {
    "profile_tables": PROFILES_SQL,
    "profile_totals": (
        "SELECT count(*)::BIGINT AS datasets, sum(rows)::BIGINT AS rows, "
        f"(SELECT sum(n_chars)::DOUBLE / 1048576.0 FROM documents) AS size_mb FROM ({PROFILES_SQL})"),
    "profile_sizes": (
        "SELECT dataset, rows, (SELECT sum(n_chars)::DOUBLE / 1048576.0 FROM documents "
        f"WHERE [{', '.join(repr(n) for n in TABLES)}][doc_id % {len(TABLES)} + 1] = p.dataset) AS size_mb "
        f"FROM ({PROFILES_SQL}) p"),
    "profile_csv": (
        "SELECT dataset, description, rows::VARCHAR AS rows, variables::VARCHAR AS variables, file, "
        "coalesce(strftime(date_min, '%Y-%m-%d'), '') AS date_min, "
        f"coalesce(strftime(date_max, '%Y-%m-%d'), '') AS date_max FROM ({PROFILES_SQL})"),
    "date_texts": "SELECT o_orderkey, o_orderdate AS date FROM orders WHERE o_orderkey % 7 <> 6",
    "profile_first_valid_date": (
        "SELECT 'orders' AS dataset, count(*)::BIGINT AS rows, "
        "min(o_orderdate) FILTER (WHERE o_orderstatus <> 'F') AS date_min, "
        "max(o_orderdate) FILTER (WHERE o_orderstatus <> 'F') AS date_max FROM orders"),
    "profile_integer_dates": (
        "SELECT 'lineitem' AS dataset, count(*)::BIGINT AS rows, "
        "min(l_shipdate) FILTER (WHERE l_returnflag <> 'R') AS date_min, "
        "max(l_shipdate) FILTER (WHERE l_returnflag <> 'R') AS date_max FROM lineitem"),
    "valid_dates_only": (
        "SELECT o_orderkey, o_orderdate AS date FROM orders "
        "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    "profile_export_dates": (
        "SELECT dataset, rows, coalesce(strftime(date_min, '%Y-%m-%d'), '') AS date_min, "
        f"coalesce(strftime(date_max, '%Y-%m-%d'), '') AS date_max FROM ({PROFILES_SQL})"),
    "date_coverage": (
        "SELECT dataset, strftime(date_min, '%Y-%m-%d') AS date_min, "
        f"strftime(date_max, '%Y-%m-%d') AS date_max FROM ({PROFILES_SQL}) WHERE date_min IS NOT NULL"),
    "published_profile": _published_sql(),
    "profile_footers": (
        "SELECT 'lineitem' AS dataset, count(*)::BIGINT AS rows, min(l_shipdate) FILTER (WHERE l_returnflag <> 'R') "
        "AS date_min, max(l_shipdate) FILTER (WHERE l_returnflag <> 'R') AS date_max FROM lineitem UNION ALL "
        "SELECT 'orders', count(*), min(o_orderdate::DATE)::TIMESTAMP, max(o_orderdate::DATE)::TIMESTAMP FROM orders "
        "UNION ALL SELECT 'part', count(*), NULL, NULL FROM part UNION ALL "
        "SELECT 'supplier', count(*), min(l_shipdate) FILTER (WHERE l_returnflag <> 'R'), "
        "max(l_shipdate) FILTER (WHERE l_returnflag <> 'R') FROM lineitem UNION ALL "
        "SELECT 'events', count(*), min(ts), max(ts) FROM events"),
}
