"""The whole way from a folder of archives to described tables; landing reports."""

import pytest
from pyspark.sql import functions as F

from conftest import zip_bytes
from drydock.config import DEFAULT_REGISTRY, Dataset, Provenance, Registry
from drydock.operators.landing import (
    all_succeeded, deletion_preview, failures, ingest_report, inventory_totals, reconcile, select_datasets,
    skip_or_force)
from drydock.operators.lookups import classify
from drydock.plans import ingest as plan
from drydock.plans.ingest import ingest
from drydock.plans.summarize import summarize
from drydock.sinks import parquet
from drydock.sinks.parquet import is_published, publish, read_column_catalog, read_properties
from drydock.sources.listing import column_catalog, dataset_catalog, list_files, match_files, scan_published
from drydock.streaming.incremental import incremental_ingest, landed


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    (root / "CSV_ATTRIBUTES_ACTIVE.ZIP").write_bytes(zip_bytes({
        "a.csv": " id_rssd ,name,d_dt_start,extra\n1,Bank \u00e9,01/31/2024 00:00:00,\n2,NA,12/31/9999 00:00:00,\n",
        "b.CSV": "name, id_rssd ,flag\nText,x,True\n"}))
    (root / "old_csv_relationships.zip").write_bytes(zip_bytes({"r.csv": "ID_RSSD_PARENT,ID_RSSD_OFFSPRING\n1,2\n"}))
    (root / "zz_csv_relationships.zip").write_bytes(zip_bytes({"r.csv": "ID_RSSD_PARENT,ID_RSSD_OFFSPRING\n3,4\n"}))
    (root / "CSV_TRANSFORMATIONS.ZIP").write_bytes(b"broken")
    (root / "CSV_ATTRIBUTES_CLOSED.ZIP").write_bytes(zip_bytes({"a.csv": "a,A\n1,2\n"}))
    (root / "CSV_ATTRIBUTES_BRANCHES.ZIP").write_bytes(zip_bytes({"a.csv": "a,b\n1,2\n", "b.csv": "a,b\n1,2,3\n"}))
    (root / "something.zip").write_bytes(zip_bytes({"a.csv": "a\n1\n"}))
    (root / "notes.txt").write_text("x")
    return root


def status(outcomes):
    return {r.path.rsplit("/", 1)[-1]: (r.status, r.dataset, r.message) for r in outcomes.collect()}


def test_ingest(spark, tmp_path, landing):
    out = str(tmp_path / "out")
    texts = spark.createDataFrame([("ATTRIBUTES", "NAME", "The name"), ("ATTRIBUTES", "ID_RSSD", "The key"),
                                   ("RELATIONSHIPS", "NAME", "no")], "table string, variable string, description string")
    outcomes = ingest(spark, str(landing), out, DEFAULT_REGISTRY, texts, provenance=Provenance("who", "where"))
    found = status(outcomes)
    assert found["CSV_ATTRIBUTES_ACTIVE.ZIP"] == ("success", "attributes_active", "3 rows, 5 columns, 2 descriptions")
    assert found["old_csv_relationships.zip"][0] == "success"
    assert found["zz_csv_relationships.zip"][0] == "skipped"
    assert found["CSV_TRANSFORMATIONS.ZIP"][0] == "error"
    assert found["CSV_ATTRIBUTES_BRANCHES.ZIP"][0] == "error" and "3 fields" in found["CSV_ATTRIBUTES_BRANCHES.ZIP"][2]
    assert found["CSV_ATTRIBUTES_CLOSED.ZIP"][0] == "error" and "once upper-cased" in found["CSV_ATTRIBUTES_CLOSED.ZIP"][2]
    assert found["something.zip"] == ("error", None, "Unknown dataset type: something.zip")
    assert len(found) == 7

    active = spark.read.parquet(f"{out}/attributes_active.parquet")
    assert active.columns == ["ID_RSSD", "D_DT_START", "EXTRA", "FLAG", "NAME"]
    assert [t for _, t in active.dtypes] == ["bigint", "string", "double", "boolean", "string"]
    assert sorted(map(tuple, active.collect()), key=str) == sorted([
        (1, "01/31/2024 00:00:00", None, None, "Bank \u00e9"), (2, "12/31/9999 00:00:00", None, None, None),
        (None, None, None, True, "Text")], key=str)
    assert {r["column"]: r["description"] for r in column_catalog(active).collect()}["NAME"] == "The name"
    assert read_properties(spark, out, "attributes_active") == {
        "dataset_description": "Active financial institutions", "source": "who", "source_url": "where"}

    report = {(r.status, r.dataset): r.archives for r in ingest_report(outcomes).collect()}
    assert report[("error", "")] == 1 and report[("skipped", "relationships")] == 1
    assert all_succeeded(outcomes).first().ok is False
    assert {r.name for r in failures(outcomes).collect()} == {
        "transformations", "attributes_branches", "attributes_closed", "something.zip"}

    again = status(ingest(spark, str(landing), out, DEFAULT_REGISTRY))
    assert again["CSV_ATTRIBUTES_ACTIVE.ZIP"] == ("skipped", "attributes_active", "Already exists")
    forced = status(ingest(spark, str(landing), out, DEFAULT_REGISTRY, force=True, collisions="union"))
    assert forced["CSV_ATTRIBUTES_ACTIVE.ZIP"][2] == "3 rows, 5 columns, 0 descriptions"
    assert forced["zz_csv_relationships.zip"][0] == "success"
    assert sorted(map(tuple, spark.read.parquet(f"{out}/relationships.parquet").collect())) == [(1, 2), (3, 4)]


def test_faults_of_one_dataset_leave_the_others(spark, tmp_path, landing, monkeypatch):
    out, real = str(tmp_path / "out"), plan.publish

    def publish(df, root, dataset, *rest):
        if dataset == "attributes_active":
            raise RuntimeError("disk on fire")
        return real(df, root, dataset, *rest)

    monkeypatch.setattr(plan, "publish", publish)
    found = status(ingest(spark, str(landing), out, DEFAULT_REGISTRY))
    assert found["CSV_ATTRIBUTES_ACTIVE.ZIP"][0] == "error" and "disk on fire" in found["CSV_ATTRIBUTES_ACTIVE.ZIP"][2]
    assert found["old_csv_relationships.zip"][0] == "success"


def test_staged_records_are_removed(spark, tmp_path, landing):
    staging = tmp_path / "staging"
    found = ingest(spark, str(landing), str(tmp_path / "out"), DEFAULT_REGISTRY, staging=str(staging))
    assert found.count() == 7 and not (staging / "records").exists()


def test_half_written_tables_are_not_published(spark, tmp_path):
    root, df = str(tmp_path), spark.range(3)
    publish(df, root, "t", {"a": "1", "b": "2"})
    assert is_published(spark, root, "t") and read_properties(spark, root, "t") == {"a": "1", "b": "2"}
    publish(df.withColumn("x", F.lit(1)), root, "t", {"a": "3"}, mode="ignore")
    assert spark.read.parquet(f"{root}/t.parquet").columns == ["id"]
    assert read_properties(spark, root, "t") == {"a": "1", "b": "2"} and read_column_catalog(spark, root, "t").count() == 1
    publish(df.withColumn("x", F.lit(1)), root, "t", {"a": "3"})
    assert read_properties(spark, root, "t") == {"a": "3", "b": "2"} and read_column_catalog(spark, root, "t").count() == 2
    with pytest.raises(Exception, match="broken"):
        publish(spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("z")), root, "t")
    assert is_published(spark, root, "t") and spark.read.parquet(f"{root}/t.parquet").count() == 3  # the old one is whole
    (tmp_path / "t.parquet" / "_SUCCESS").unlink()
    assert not is_published(spark, root, "t")


@pytest.mark.parametrize("step", ["add_files", "write_manifest", "sweep", "describe_published"])
def test_a_publication_that_stops_leaves_a_version_to_read(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    publish(spark.range(3), root, "t", {"a": "1"})

    def stop(*_):
        raise OSError("the power went")

    real, calls = getattr(parquet, step), []
    monkeypatch.setattr(parquet, step, stop if step != "sweep" else lambda *a: calls.append(1) or (real(*a) if len(calls) < 2 else stop()))
    with pytest.raises(OSError, match="power"):
        publish(spark.range(5).selectExpr("CAST(id AS string) AS id"), root, "t")
    monkeypatch.undo()
    new = step in ("sweep", "describe_published")
    assert scan_published(spark, root, "t").count() == (5 if new else 3)
    assert is_published(spark, root, "t") == (step == "add_files")  # else the next run makes it anew
    publish(spark.range(7), root, "t")
    assert scan_published(spark, root, "t").count() == 7 == spark.read.parquet(f"{root}/t.parquet").count()
    assert is_published(spark, root, "t")


def test_profiles_of_what_can_be_read(spark, tmp_path):
    root = str(tmp_path)
    for name in ("good", "other", "torn"):
        publish(spark.range(100), root, name)
    part = next((tmp_path / "torn.parquet").glob("part-*.parquet"))
    body = part.read_bytes()
    part.write_bytes(body[:4] + b"\0" * 60 + body[64:])
    (part.parent / f".{part.name}.crc").unlink()
    with pytest.warns(UserWarning, match="torn"):
        found = summarize(spark, root, DEFAULT_REGISTRY, ("id",)).collect()
    assert [(r.dataset, r.rows) for r in found] == [("good", 100), ("other", 100)]


def test_archives_beyond_the_file_sources_limit(spark, tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    (root / "small_csv_relationships.zip").write_bytes(zip_bytes({"r.csv": "a\n1\n"}))
    (root / "large_csv_relationships.zip").write_bytes(zip_bytes({"r.csv": "a\n" + "".join(f"{k * k}\n" for k in range(5000))}))
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        incremental_ingest(spark, str(root), str(tmp_path / "out"), str(tmp_path / "seen"), DEFAULT_REGISTRY,
                           publish_to=str(tmp_path / "published")).awaitTermination()
        found = {r.path.rsplit("/", 1)[-1]: (r.status, r.rows) for r in landed(spark, str(tmp_path / "out")).collect()}
    finally:
        spark.conf.unset(limit)
    assert found == {"small_csv_relationships.zip": ("success", 1), "large_csv_relationships.zip": ("success", 5000)}
    assert spark.read.parquet(str(tmp_path / "published" / "relationships.parquet")).count() == 5001


def test_nothing_to_ingest(spark, tmp_path):
    assert ingest(spark, str(tmp_path / "none"), str(tmp_path / "out"), DEFAULT_REGISTRY).count() == 0


def test_incremental_runs_take_only_new_archives(spark, tmp_path, landing):
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")

    def run():
        incremental_ingest(spark, str(landing), out, seen, DEFAULT_REGISTRY).awaitTermination()
        return {r.path.rsplit("/", 1)[-1]: (r.status, r.rows) for r in landed(spark, out).collect()}, landed(spark, out).count()

    first, n = run()
    assert n == 7 and first["CSV_ATTRIBUTES_ACTIVE.ZIP"] == ("success", 3) and first["CSV_TRANSFORMATIONS.ZIP"][0] == "error"
    assert run()[1] == 7
    (landing / "late_csv_relationships.zip").write_bytes(zip_bytes({"r.csv": "a\n1\n2\n"}))
    last, n = run()
    assert n == 8 and last["late_csv_relationships.zip"] == ("success", 2)
    assert landed(spark, out, "records").filter("row_no > 0 AND error IS NULL").count() == 3 + 1 + 1 + 1 + 1 + 1 + 2


def test_classification_takes_the_first_pattern(spark):
    registry = Registry((Dataset("b", "AB", "TB", "x"), Dataset("a", "A", "TA", "y")))
    files = spark.createDataFrame([("/x/my_ab.zip",), ("/ab/a.tar.gz",), ("/x/b.ab",), ("/x/none.zip",)], "path string")
    found = {r.path: (r.dataset, r.dict_table, r.description) for r in classify(files, registry).collect()}
    assert found["/x/my_ab.zip"] == ("b", "TB", "x") and found["/ab/a.tar.gz"] == ("a", "TA", "y")
    assert found["/x/b.ab"] == (None, "UNKNOWN", "Unknown dataset") == found["/x/none.zip"][:1] + ("UNKNOWN", "Unknown dataset")


def test_expected_against_landed(spark):
    expected = dataset_catalog(spark, select_datasets(DEFAULT_REGISTRY, ["relationships", "transformations"]), "u://x/")
    assert [r.location for r in expected.orderBy("priority").collect()] == [
        "u://x/CSV_RELATIONSHIPS.ZIP", "u://x/CSV_TRANSFORMATIONS.ZIP"]
    there = spark.createDataFrame([("CSV_RELATIONSHIPS.ZIP", 1179648)], "file string, length bigint")
    found = {r.dataset: (r.status, r.message) for r in reconcile(expected, there, "file").collect()}
    assert found == {"relationships": ("present", "Already exists (1.12 MB)"), "transformations": ("fetch", "")}
    assert reconcile(expected, there, "file", force=True).filter("status = 'fetch'").count() == 2
    assert [r.dataset for r in skip_or_force(expected, there, "file").collect()] == ["transformations"]
    assert skip_or_force(expected, there, "file", force=True).count() == 2
    with pytest.raises(ValueError, match="nobody"):
        select_datasets(DEFAULT_REGISTRY, ["nobody"])
    assert select_datasets(DEFAULT_REGISTRY) is DEFAULT_REGISTRY


def test_inventory(spark, tmp_path):
    for name, size in (("a.zip", 10), ("b.ZIP", 20), ("c.pdf", 5), ("t.parquet", 7), ("variable_dictionary.csv", 3), ("other.csv", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = match_files(list_files(spark, str(tmp_path)))
    found = {r.file_class: (r.files, r.bytes) for r in inventory_totals(files).collect()}
    assert found == {"raw": (3, 35), "processed": (1, 7), "dictionary": (1, 3), "total": (5, 45)}
    assert {r.file for r in deletion_preview(files).collect()} == {"a.zip", "b.ZIP", "c.pdf", "t.parquet", "variable_dictionary.csv"}
    assert inventory_totals(match_files(list_files(spark, str(tmp_path / "none")))).first()["files"] == 0
