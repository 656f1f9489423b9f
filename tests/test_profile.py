"""Date coverage, sizes and exports of profiles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from drydock.config import Dataset, DateRules, Registry
from drydock.operators.footers import footer_facts, footer_scan, footer_session
from drydock.operators.profile import (
    PROFILE_COLUMNS, date_coverage, datasets_with_dates, export_profile, profile, profile_all, profile_report,
    profile_totals)
from drydock.plans.summarize import summarize
from drydock.sinks.parquet import publish
from drydock.sinks.text import export_profile_csv
from drydock.sources.listing import published_files, scan_published

REGISTRY = Registry((Dataset("one", "ONE", "T", "The first"),))


def span(row):
    return tuple(None if d is None else d.strftime("%Y-%m-%d") for d in (row.date_min, row.date_max))


@pytest.mark.parametrize("kind, values, want", [
    ("string", ["01/31/2024 00:00:00", "12/31/9999 00:00:00", "2024-02-01", "x", None], ("2024-01-31", "2024-02-01")),
    ("string", ["20240131", "2/3/2024", "2024-01-05 10:00", "2024-13-01", "20249999"], ("2024-01-05", "2024-02-03")),
    ("int", [20240131, 99991231, 5, None], ("2024-01-31", "2024-01-31")),
    ("double", [20240131.0, None], ("2024-01-31", "2024-01-31")),
    ("date", [dt.date(2020, 5, 1), dt.date(9999, 1, 1)], ("2020-05-01", "2020-05-01")),
    ("boolean", [True], (None, None)),
    ("string", ["1600-01-01"], (None, None))])
def test_range_of_dates(spark, kind, values, want):
    df = spark.createDataFrame([(v,) for v in values], f"DT_END {kind}")
    assert span(profile(df, "one").first()) == want


def test_first_column_with_dates_counts(spark):
    df = spark.createDataFrame([("2020-01-01", "x", "2021-01-01")], "DT_OPEN string, D_DT_START string, D_DT_END string")
    assert span(profile(df, "one").first()) == ("2021-01-01", "2021-01-01")
    late = DateRules(latest="2020-12-31 00:00:00")
    assert span(profile(df, "one", rules=late).first()) == ("2020-01-01", "2020-01-01")


def test_datasets_side_by_side(spark):
    dated = spark.createDataFrame([("2020-01-01",), ("2020-01-02",)], "DT_END string")
    tagged = dated.select(F.col("DT_END").alias("DT_END", metadata={"description": "end"}))
    empty = spark.createDataFrame([], "a int, b int")
    rows = profile_all({"two": empty, "one": tagged}, REGISTRY)
    assert rows.columns == list(PROFILE_COLUMNS)
    one, two = rows.collect()
    assert (one.dataset, one.description, one.rows, one.variables, one.with_descriptions) == ("one", "The first", 2, 1, 1)
    assert (two.dataset, two.description, two.rows, two.variables) == ("two", "Unknown dataset", 0, 2)
    assert (two.file, two.date_min) == ("two.parquet", None)
    assert [r.dataset for r in datasets_with_dates(rows).collect()] == ["one"]
    assert date_coverage(rows).first()[:] == ("one", "2020-01-01", "2020-01-02")
    assert [(r.date_min, r.date_max) for r in export_profile(rows).collect()] == [("2020-01-01", "2020-01-02"), ("", "")]
    total = profile_totals(rows).first()
    assert (total.datasets, total.rows) == (2, 2)


def test_summary_of_a_folder(spark, tmp_path):
    root = str(tmp_path / "out")
    publish(spark.range(1500).select(F.col("id").alias("A")), root, "one")
    publish(spark.createDataFrame([("2020-01-01",)], "DT_END string"), root, "two")
    rows = summarize(spark, root, REGISTRY)
    one, two = rows.collect()
    on_disk = sum(p.stat().st_size for p in (tmp_path / "out" / "one.parquet").glob("part-*.parquet"))
    assert one.size_mb == on_disk / 1048576 and one.rows == 1500
    assert profile_report(rows).first().rows == "1,500"
    export_profile_csv(rows, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True).orderBy("dataset").collect()
    assert [(r.dataset, r.date_min) for r in back] == [("one", None), ("two", "2020-01-01")]
    with pytest.raises(ValueError, match="no published dataset"):
        summarize(spark, str(tmp_path / "nothing"), REGISTRY)


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: [COUNT" in plan or "PushedAggregation: [MIN" in plan or "PushedAggregation: [MAX" in plan


@pytest.mark.parametrize("kind, values, want", [
    ("bigint", [20240131, 20230101, None], ("2023-01-01", "2024-01-31")),
    ("int", [20240131, 20239999, 20230101], ("2023-01-01", "2024-01-31")),  # what is no day lies between
    ("date", [dt.date(2020, 5, 1), dt.date(2021, 1, 1), None], ("2020-05-01", "2021-01-01"))])
def test_footers_settle_a_range(spark, tmp_path, kind, values, want):
    root = str(tmp_path)
    publish(spark.createDataFrame([(v, "x") for v in values], f"DT_END {kind}, other string").coalesce(1), root, "one")
    groups = published_files(spark, root, "one")
    schema = scan_published(spark, root, "one").schema
    facts = footer_facts(spark, {"one": groups}, {"one": schema}, ("DT_START", "DT_END"))["one"]
    assert facts.rows == len(values)
    row = summarize(spark, root, REGISTRY).first()
    assert span(row) == want and row.rows == len(values)
    scan = footer_scan(footer_session(spark), groups[0], "one", "DT_END")
    assert pushed(scan)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's settings stay


@pytest.mark.parametrize("kind, values", [
    ("bigint", [20240131, 99991231]), ("bigint", [5, 20240131]), ("bigint", [None]), ("bigint", [123, 456]),
    ("string", ["2024-01-31"]), ("timestamp_ntz", [dt.datetime(2024, 1, 31)]), ("date", [dt.date(9999, 1, 1)])])
def test_what_footers_leave_open_is_scanned(spark, tmp_path, kind, values):
    root = str(tmp_path)
    df = spark.createDataFrame([(v, "2020-01-01") for v in values], f"DT_START {kind}, DT_END string")
    publish(df, root, "one")
    schemas = {"one": scan_published(spark, root, "one").schema}
    assert footer_facts(spark, {"one": published_files(spark, root, "one")}, schemas, ("DT_START", "DT_END")) == {}
    want = profile_all({"one": df}, REGISTRY, ("DT_START", "DT_END")).first()
    assert span(summarize(spark, root, REGISTRY, ("DT_START", "DT_END")).first()) == span(want)


def test_a_file_without_values_is_scanned_and_others_are_not(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.createDataFrame([(20240131,), (None,)], "DT_START int").repartition(2), root, "gap")
    publish(spark.createDataFrame([(20240131,)], "DT_START int").coalesce(1), root, "full")
    names = ("gap", "full")
    facts = footer_facts(spark, {n: published_files(spark, root, n) for n in names},
                         {n: scan_published(spark, root, n).schema for n in names}, ("DT_START",))
    assert "full" in facts
    assert {r.dataset: (r.rows, *span(r)) for r in summarize(spark, root, REGISTRY).collect()} == {
        "gap": (2, "2024-01-31", "2024-01-31"), "full": (1, "2024-01-31", "2024-01-31")}


def test_rows_of_tables_without_dates_come_from_footers(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(1000).repartition(3), root, "one")
    facts = footer_facts(spark, {"one": published_files(spark, root, "one")},
                         {"one": scan_published(spark, root, "one").schema}, ("DT_START",))
    assert facts["one"].rows == 1000 and facts["one"].low is None
    assert pushed(footer_scan(footer_session(spark), published_files(spark, root, "one")[0], "one", ""))
    own = DateRules(rewrites=((r"^(\d{2})(\d{2})(\d{4})$", "$3-$2-$1"),))  # day first: whole numbers do not order as days
    publish(spark.createDataFrame([(31012024,), (1022023,)], "DT_START int"), root, "two")
    assert footer_facts(spark, {"two": published_files(spark, root, "two")},
                        {"two": scan_published(spark, root, "two").schema}, ("DT_START",), own) == {}
