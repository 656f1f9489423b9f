"""Loading a dictionary and hanging it on columns."""

from pyspark.sql import functions as F

from drydock.operators.describe import attach_descriptions, descriptions_for
from drydock.operators.dictionary import load_dictionary, read_dictionary
from drydock.operators.lookups import described, dictionary_coverage, exclude, include, join_descriptions
from drydock.sinks.parquet import publish, publish_table, read_properties
from drydock.sinks.text import write_dictionary_csv
from drydock.sources.listing import column_catalog, described_columns, published_names, list_files


def write(tmp_path, text):
    path = tmp_path / "dictionary.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def entries(df):
    return {(r["table"], r["variable"]): r["description"] for r in df.collect()}


def test_later_rows_win_and_blanks_fall_back(spark, tmp_path):
    path = write(tmp_path, "variable,table,data_type,description,full_description\n"
                           "A,T,INT,short,full\n a ,t,INT,short again,\nB,T,INT,,\n,T,INT,x,y\nC,T,,NA,\"two\nlines \"\"q\"\"\"\n"
                           "D,,INT,no table,\nNA,T,INT,x,y\n")
    assert entries(read_dictionary(spark, path)) == {
        ("T", "A"): "short again", ("T", "C"): 'two\nlines "q"', ("", "D"): "no table"}


def test_short_text_where_there_is_no_full_column(spark):
    raw = spark.createDataFrame([("a", "t", "x", 1), ("a", "t", "y", 2)], "variable string, table string, description string, n int")
    assert entries(load_dictionary(raw, F.col("n"))) == {("T", "A"): "y"}
    assert entries(load_dictionary(raw, -F.col("n"), {"t": "Real"})) == {("REAL", "A"): "x"}


def test_missing_or_unfit_file_is_empty(spark, tmp_path, recwarn):
    assert read_dictionary(spark, str(tmp_path / "none.csv")).count() == 0
    assert not [w for w in recwarn if "dictionary" in str(w.message)]
    assert read_dictionary(spark, write(tmp_path, "x,y\n1,2\n")).count() == 0
    assert [w for w in recwarn if "variable" in str(w.message)]


def test_written_dictionary_reads_back(spark, tmp_path):
    rows = [("A", "T", "INT", 'say "hi", twice', "line\nbreak"), ("B", "T", "", "s", "")]
    df = spark.createDataFrame(rows, "variable string, table string, data_type string, description string, full_description string")
    path = str(tmp_path / "out")
    write_dictionary_csv(df.select(*reversed(df.columns)), path)
    assert spark.read.csv(path, header=True, multiLine=True, escape='"').columns == df.columns
    assert entries(read_dictionary(spark, path)) == {("T", "A"): "line\nbreak", ("T", "B"): "s"}


def test_joins_on_table_and_upper_name(spark):
    columns = spark.createDataFrame([("T", "a"), ("T", "b"), ("U", "a")], "table string, column string")
    texts = spark.createDataFrame([("T", "A", "text")], "table string, variable string, description string")
    for salts in (1, 5):
        found = {(r["table"], r["column"]): r["description"] for r in join_descriptions(columns, texts, salts).collect()}
        assert found == {("T", "a"): "text", ("T", "b"): "", ("U", "a"): ""}
        assert described(columns, texts, salts).count() == 1
        assert exclude(columns, texts, ["table"], salts).count() == 1
        assert include(columns, texts, ["table"], salts).count() == 2


def test_descriptions_through_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2.5)], "A int, B string, `c d` double")
    texts = spark.createDataFrame([("T", "A", "It's a"), ("U", "B", "other"), ("T", "C D", "spaced")],
                                  "table string, variable string, description string")
    found = descriptions_for(df, texts, "T")
    assert found == {"A": "It's a", "c d": "spaced"}
    out = str(tmp_path)
    path = publish(attach_descriptions(df, found), out, "one", {"source": "new", "k": "v"}, {"source": "old", "kept": "yes"})
    back = spark.read.parquet(path)
    assert described_columns(back.schema) == 2
    assert {r["column"]: r["description"] for r in column_catalog(back).collect()} == {"A": "It's a", "B": None, "c d": "spaced"}
    assert read_properties(spark, out, "one") == {"source": "new", "k": "v", "kept": "yes"}
    assert [r.dataset for r in published_names(list_files(spark, out, recursive=True)).collect()] == ["one"]
    first = sorted(p.name for p in (tmp_path / "one.parquet").glob("*.parquet"))
    publish(df, out, "one", mode="ignore")
    assert sorted(p.name for p in (tmp_path / "one.parquet").glob("*.parquet")) == first


def test_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS drydock_test LOCATION '{tmp_path}'")
    df = attach_descriptions(spark.createDataFrame([(1,)], "A int"), {"A": "text of a"})
    publish_table(df, "drydock_test.t", "It's a table", {"source": "s", "source_url": "u"})
    assert spark.sql("DESCRIBE TABLE drydock_test.t").first()["comment"] == "text of a"
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES drydock_test.t").collect()}
    assert shown["source"] == "s" and "source_url" in shown  # its value is shown redacted
    assert spark.catalog.getTable("drydock_test.t").description == "It's a table"
    spark.sql("DROP TABLE drydock_test.t")


def test_labels_that_describe_nothing_are_told(spark):
    raw = spark.createDataFrame(
        [("t", "a", "x"), ("t", "b", "x"), ("table_1", "a", "x"), (None, "a", "x"), ("u", "zz", "x")],
        "table string, variable string, description string")
    columns = spark.createDataFrame([("T", " a "), ("T", "A"), ("U", "c"), ("T", None)], "table string, column string")
    told = dictionary_coverage(columns, load_dictionary(raw, F.lit(0)))
    assert [tuple(r) for r in told.collect()] == [("", 1, 0, False), ("T", 2, 1, True), ("TABLE_1", 1, 0, False), ("U", 1, 0, True)]
    mapped = dictionary_coverage(columns, load_dictionary(raw.filter("table = 'table_1'"), F.lit(0), {"table_1": "t"}))
    assert [tuple(r) for r in mapped.collect()] == [("T", 1, 1, True)]
    assert dictionary_coverage(columns, load_dictionary(raw.limit(0), F.lit(0))).collect() == []
