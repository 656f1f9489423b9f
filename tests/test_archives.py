"""Expanding archives: members, encodings, ragged records, faults."""

import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import zip_bytes
from drydock.sources import archives as source
from drydock.catalog.common import zip_members
from drydock.operators.states import column_states
from drydock.sources.archives import (
    archive_digests, column_names, errors_by_archive, expand_archives, layouts, list_members)
from drydock.sources.listing import list_archives, list_files
from drydock.operators import union
from drydock.operators.union import assemble_table


def rows_of(df):
    return sorted((r.path, r.member, r.row_no, tuple(r.fields)) for r in df.filter("error is null").collect())


def test_members_by_suffix_in_any_case(archives):
    found = archives({"two.zip": {"a.csv": "a,b\n1,x\n", "B.CSV": "b,c\nsome text,3\n", "readme.txt": "no"}})
    assert rows_of(expand_archives(found)) == [
        ("two.zip", "B.CSV", 0, ("b", "c")), ("two.zip", "B.CSV", 1, ("some text", "3")),
        ("two.zip", "a.csv", 0, ("a", "b")), ("two.zip", "a.csv", 1, ("1", "x"))]
    assert {r.member for r in list_members(found).collect()} == {"a.csv", "B.CSV"}


def test_encoding_of_whole_member(archives):
    found = archives({"e.zip": {
        "latin.csv": b"a,b\n\xe9,\xc3\xa9\n", "utf.csv": "a,b\né,x\n".encode(), "bom.csv": "﻿a,b\né,x\n".encode()}})
    values = {(r.member, r.row_no): tuple(r.fields) for r in expand_archives(found).collect()}
    assert values[("latin.csv", 1)] == ("é", "Ã©")
    assert values[("utf.csv", 1)] == ("é", "x")
    assert values[("bom.csv", 0)] == ("a", "b")


def test_quotes_and_line_breaks(archives):
    found = archives({"q.zip": {"a.csv": 'a,b\r\n"x ""y""\nz",2\r\n3,"4, 5"'}})
    assert [r[3] for r in rows_of(expand_archives(found))] == [("a", "b"), ('x "y"\nz', "2"), ("3", "4, 5")]


def test_ragged_records(archives):
    found = archives({
        "short.zip": {"a.csv": "a,b\n1\n\n   \n2,3\n"},
        "long.zip": {"a.csv": "a,b\n1,2\n1,2,3\n4,5\n"},
        "open.zip": {"a.csv": 'a,b\n"x,2\n'}})
    rows = expand_archives(found).cache()
    short = {r[3] for r in rows_of(rows.filter("path = 'short.zip'"))}
    assert short == {("a", "b"), ("1", None), ("2", "3")}
    faults = {r.path: (r.faults, r.error) for r in errors_by_archive(rows).collect()}
    assert faults["long.zip"] == (1, "record 2: 3 fields, expected 2")
    assert "never closed" in faults["open.zip"][1]


def test_broken_archives_are_reported(archives):
    found = archives({"bad.zip": b"not a zip", "empty.zip": {"a.csv": ""}, "none.zip": {"a.txt": "x"},
                      "head.zip": {"a.csv": "a,b\n"}})
    rows = expand_archives(found)
    faults = {r.path: r.error for r in errors_by_archive(rows).collect()}
    assert set(faults) == {"bad.zip", "empty.zip", "none.zip"}
    assert "no CSV members" in faults["none.zip"] and "empty" in faults["empty.zip"]
    assert rows_of(rows) == [("head.zip", "a.csv", 0, ("a", "b"))]


@pytest.mark.parametrize("header, names", [
    (["a", "a"], ["a", "a.1"]), (["a", "a", "A", "a.1"], ["a", "a.2", "A", "a.1"]),
    (["a", "a", "a.1", "a"], ["a", "a.2", "a.1", "a.3"]), (["a", "", ""], ["a", "Unnamed: 1", "Unnamed: 2"]),
    ([" id "], [" id "])])
def test_column_names(header, names):
    assert column_names(header) == names


def test_blocks_smaller_than_records(monkeypatch, archives):
    """Record numbers stay right across blocks, ragged records and restarts."""
    monkeypatch.setattr(source, "_BLOCK", 64)
    lines, want = ["a,b"], []
    for i in range(1, 400):
        if i % 37 == 5:
            lines.append(str(i))
            want.append((i, [str(i), None]))
        else:
            text = "y\n" * 500 if i == 300 else "x" * 90 if i % 91 == 7 else f"v{i}"
            lines.append(f'{i},"{text}"')
            want.append((i, [str(i), text]))
    body = zip_bytes({"a.csv": "\n".join(lines) + "\n"})
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict(
        {"path": ["p"], "member": pa.array([None], pa.string()), "content": pa.array([body], pa.binary())})
    out = [r for b in source._expander(source.open_path, False, source.MAX_RECORD_BYTES)(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["row_no"], r["fields"]) for r in out if r["row_no"]) == want


def test_files_of_a_folder(spark, tmp_path):
    for name in ("a.zip", "B.ZIP", "c.Zip"):
        (tmp_path / name).write_bytes(zip_bytes({"x.csv": f"n\n{name}\n", "y.csv": "n\n2\n"}))
    (tmp_path / "d.txt").write_text("x")
    root = str(tmp_path)
    assert list_archives(spark, root).count() == 3
    assert list_files(spark, root).count() == 4
    assert list_files(spark, root + "/missing").count() == 0
    carried = spark.read.format("binaryFile").load(root).filter("path NOT LIKE '%txt'").select("path", "length", "content")
    assert rows_of(expand_archives(list_archives(spark, root))) == rows_of(expand_archives(carried))
    assert list_members(list_archives(spark, root)).count() == 6


def test_many_archives_by_the_same_code(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"{k}.zip").write_bytes(zip_bytes({"x.csv": f"n\n{k}\n"}))
    for few in (3, 300):
        named = list_archives(spark, str(tmp_path)).orderBy("path").limit(few)
        found = expand_archives(named).filter("row_no > 0 AND error IS NULL")
        assert found.count() == few


def test_store_faults_are_no_bad_data(spark):
    strange = spark.createDataFrame([("nowhere://bucket/a.zip",)], "path string")
    missing = spark.createDataFrame([("/no/such/a.zip",)], "path string")
    for archives in (strange, missing):
        for stage in (expand_archives, list_members):
            with pytest.raises(Exception, match="nowhere|No such file|Unrecognized"):
                stage(archives).collect()


def test_own_opener(spark):
    body = zip_bytes({"a.csv": "n\nmine\n"})

    def opener(path):
        import io
        return io.BytesIO(body if path.startswith("mine://") else b"")
    found = expand_archives(spark.createDataFrame([("mine://x",)], "path string"), opener=opener)
    assert [r.fields for r in found.filter("row_no > 0").collect()] == [["mine"]]


def test_ragged_rows_come_in_few_batches():
    text = "a,b,c\n" + "".join(f"{k},x\n" for k in range(50_000))
    body = zip_bytes({"a.csv": text})
    batch = pa.RecordBatch.from_pydict(
        {"path": ["p"], "member": pa.array([None], pa.string()), "content": pa.array([body], pa.binary())})
    out = list(source._expander(source.open_path, False, source.MAX_RECORD_BYTES)(iter([batch])))
    assert len(out) < 10
    rows = [r for b in out for r in b.to_pylist() if r["row_no"]]
    assert len(rows) == 50_000 and rows[7]["fields"] == ["7", "x", None]


def test_header_pass_reads_the_header_alone(monkeypatch):
    body = zip_bytes({"a.csv": "a,b\n" + "1,2\n" * 1_000_000, "b.csv": "\u00e9,b\n1,2\n"})
    monkeypatch.setattr(source._Member, "encoding", lambda self: pytest.fail("read whole") if self.name == "a.csv" else "utf-8")
    batch = pa.RecordBatch.from_pydict(
        {"path": ["p"], "member": pa.array([None], pa.string()), "content": pa.array([body], pa.binary())})
    out = [r for b in source._expander(source.open_path, True, 1 << 30)(iter([batch])) for r in b.to_pylist()]
    assert [r["fields"] for r in out] == [["a", "b"], ["\u00e9", "b"]]


def test_record_limit_is_named(archives):
    found = archives({"a.zip": {"x.csv": "a\n" + "y" * (9 << 20) + "\n"}})
    assert rows_of(expand_archives(found).filter("row_no > 0"))[0][3] == ("y" * (9 << 20),)
    found = archives({"a.zip": {"x.csv": "a\n" + "y" * (20 << 20) + "\n"}})
    short = expand_archives(found, max_record_bytes=5 << 20)
    assert "max_record_bytes" in errors_by_archive(short).first()["error"]


def test_union_by_name(archives):
    found = archives({"one.zip": {"a.csv": "a,b\n1,2\n", "b.csv": "c,a\n3,x\n"}, "two.zip": {"a.csv": "b\n4\n"}})
    rows = expand_archives(found)

    def table():
        df = assemble_table(rows)
        return sorted([tuple(r[c] for c in "abc") for r in df.collect()], key=str)

    want = sorted([("1", "2", None), ("x", None, "3"), (None, "4", None)], key=str)
    assert table() == want
    headers = sorted((r["layout"], r["names"]) for r in layouts(rows).collect())
    assert assemble_table(rows).columns == list(dict.fromkeys(n for _, names in headers for n in names))


def test_single_column_keeps_quoted_empty(archives):
    found = archives({"s.zip": {"a.csv": 'a\n\n  \n1\n""\n'}})
    assert [r[3] for r in rows_of(expand_archives(found).filter(F.col("row_no") > 0))] == [("1",), ("",)]


def _folder(tmp_path, count=60):
    for k in range(count):
        (tmp_path / f"{k:03d}.zip").write_bytes(zip_bytes({"a.csv": f"a,b\n{k},x\n", "b.csv": f"b\n{k}\n"}))
    return [(f"file://{tmp_path}/{k:03d}.zip",) for k in range(count)]


def test_paths_are_dealt_to_all_cores(spark, tmp_path):
    """Many archives whose paths are a few bytes do not end up in one task."""
    paths = spark.createDataFrame(_folder(tmp_path), "path string").coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    for found in (expand_archives(paths), list_members(paths), archive_digests(paths)):
        tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
        assert tasks >= min(cores, 8)
    assert expand_archives(paths).filter("row_no > 0 AND error IS NULL").count() == 120


def test_records_are_not_dealt_by_layout(spark, tmp_path):
    """Two headers over many records: records stay where they are, for the union and for the states."""
    rows = spark.range(60_000).selectExpr(
        "'p' AS path", "if(id % 2 = 0, 'a', 'b') AS member", "id div 2 AS row_no", "id % 2 AS layout",
        "if(id < 2, if(id = 0, array('x', 'y'), array('y')), "
        "if(id % 2 = 0, array(md5(string(id)), string(id)), array(sha2(string(id), 256)))) AS fields",
        "CAST(null AS string) AS error", "'d' AS dataset")
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        table = assemble_table(stored)
        states = column_states(stored)
        for found in (table, states):
            plan = found._jdf.queryExecution().sparkPlan().toString()
            assert "BroadcastHashJoin" in plan and not any(
                "SortMergeJoin [layout" in line for line in plan.splitlines())
        assert table.count() == 60_000 - 2 and table.columns == ["x", "y"]
        got = {(r["column"], r["layout"], r["place"]): r["rows"] for r in states.collect()}
        assert got == {("x", 0, 0): 29_999, ("y", 0, 1): 29_999, ("y", 1, 0): 29_999}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_archives_are_packed_one_at_a_time(spark):
    """A worker is given the members of one archive, not those of all archives of its task."""
    rows = [(f"/l/{k}.zip", name, f"a\n{k}{name}é\n") for k in range(30) for name in ("b.csv", "A.csv", "é.csv")]
    made = zip_members(spark.createDataFrame(rows, "path string, member string, text string").coalesce(1), "ISO-8859-1")
    assert "FlatMapGroupsInArrow" in made._jdf.queryExecution().sparkPlan().toString()
    found = made.collect()
    assert len(found) == 30 and all(r["length"] == len(r["content"]) for r in found)
    for r in found:
        with zipfile.ZipFile(io.BytesIO(r["content"])) as archive:
            assert archive.namelist() == ["A.csv", "b.csv", "é.csv"]
            k = r["path"].split("/")[-1][:-4]
            assert archive.read("é.csv") == f"a\n{k}é.csvé\n".encode("latin-1")
