"""Coercion, inference and column order, against pandas where it can tell."""

import io

import pandas as pd
import pytest

from drydock.config import ColumnRoles
from drydock.operators.columns import (
    coerce_ids, coercion_report, normalize_columns, order_columns, ordered_names, standardize)
from drydock.operators.infer import apply_types, infer_types, inferred
from drydock.operators.union import union_members

VALUES = ["1", " 2 ", "x", "1e3", "12.5", "inf", "-Infinity", "0x1A", "1d", "1_000", "", "1,000", "True", "-0",
          "+5", ".5", "5.", ".", "1e", "007", "NA", "nan", "9223372036854775807", "9223372036854775808",
          "1e400", "\t3\n", "1 2", "--1", "1e+5", "1E-2", "infinit", "٣"]


def one_column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


def test_coerce_to_double_like_pandas(spark):
    df = coerce_ids(one_column(spark, VALUES), ["v"], mode="double")
    found = [r.v for r in df.collect()]
    want = [None if pd.isna(x) else float(x) for x in (pd.to_numeric(pd.Series([v]), errors="coerce")[0] for v in VALUES)]
    want[VALUES.index("True")] = None  # a text here, a boolean only where a whole column is one
    assert found == want


def test_coerce_to_bigint(spark):
    found = {v: r.v for v, r in zip(VALUES, coerce_ids(one_column(spark, VALUES), ["v"]).collect())}
    assert found["1e3"] == 1000 and found["5."] == 5 and found["007"] == 7 and found["\t3\n"] == 3
    assert found["9223372036854775807"] == 2**63 - 1
    assert all(found[v] is None for v in ("x", "12.5", "inf", "1d", "1_000", "0x1A", "9223372036854775808", "1e400"))


def test_coercion_is_reported(spark):
    row = coercion_report(one_column(spark, ["1", "x", None, "2.5"]), ["v"]).first()
    assert (row.present, row.lost) == (3, 2)


CASES = [
    (["1", "2"], "bigint"), (["1", ""], "bigint"), (["", "NA"], "double"), (["True", "FALSE"], "boolean"),
    (["true", ""], "boolean"), (["True", "1"], "string"), (["007", "8"], "bigint"), (["1.5", "2"], "double"),
    (["9223372036854775808", "1"], "decimal(20,0)"), (["9223372036854775808", "-1"], "string"),
    (["99999999999999999999999", "1"], "string"), (["9223372036854775808", "1.5"], "double"),
    (["1e400", "1"], "string"), (["inf", "1"], "double"), (["yes", "no"], "string"), (["T", "F"], "string"),
    (["-9223372036854775809", "3"], "string"), ([" 1 ", "+2"], "bigint"), (["1d", "2"], "string"),
    (["0x1A", "1"], "string"), ([".5", "1."], "double"), (["-5", "-0"], "bigint")]


@pytest.mark.parametrize("values, want", CASES)
def test_inferred_type(spark, values, want):
    assert inferred(one_column(spark, values)) == {"v": want}


@pytest.mark.parametrize("values, want", [c for c in CASES if "" not in c[0] and "NA" not in c[0]])
def test_inferred_type_like_pandas(values, want):
    dtype = pd.read_csv(io.StringIO("v\n" + "\n".join(values)), low_memory=False)["v"].dtype
    names = {"bigint": "int64", "double": "float64", "boolean": "bool", "decimal(20,0)": "uint64", "string": "object"}
    assert str(dtype) == names[want]


def test_no_rows_are_text(spark):
    assert inferred(one_column(spark, [])) == {"v": "string"}


def test_protected_columns_stay_text(spark):
    df = one_column(spark, ["007", "NA"])
    types = {r["column"]: r["type"] for r in infer_types(df, string_columns=["v"]).collect()}
    assert types == {"v": "string"}
    assert [r.v for r in apply_types(df, types).collect()] == ["007", None]


def test_applied_types_keep_values(spark):
    df = spark.createDataFrame([(" 1", "True", "NaN", "x "), ("", "", "2.5", "None")], "a string, b string, c string, d string")
    for proven in (False, True):
        rows = apply_types(df, inferred(df), proven=proven).collect()
        assert [tuple(r) for r in rows] == [(1, True, None, "x "), (None, None, 2.5, None)]


def test_members_which_disagree_become_text(spark):
    joined = union_members(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "a string"))
    assert inferred(joined) == {"a": "string"}


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "` id ` int, `#x.y` int")
    assert normalize_columns(df).columns == ["ID", "#X.Y"]
    assert normalize_columns(df, strip_prefix="#").columns == ["ID", "X.Y"]
    with pytest.raises(ValueError, match="X"):
        normalize_columns(spark.createDataFrame([(1, 2)], "x int, ` X ` int").toDF("x", "X "))


def test_column_order(spark):
    names = ["zeta", "D_DT_END", "_a", "ID_RSSD", "Alpha", "D_DT_START", "ID_RSSD_PARENT", "#b"]
    df = spark.createDataFrame([tuple(str(i) for i in range(8))], ", ".join(f"`{n}` string" for n in names))
    out = standardize(df)
    assert out.columns == ["ID_RSSD", "ID_RSSD_PARENT", "D_DT_START", "D_DT_END", "#B", "ALPHA", "ZETA", "_A"]
    assert dict(out.dtypes)["ID_RSSD"] == "bigint"
    again = standardize(out)
    assert again.columns == out.columns and again.collect() == out.collect()
    assert sorted(ordered_names(names)) == sorted(names)


def test_boolean_ids_stay(spark):
    df = spark.createDataFrame([(True, 2.0, 7)], "ID_RSSD boolean, ID_RSSD_PARENT double, ID_RSSD_OFFSPRING int")
    assert [t for _, t in standardize(df).dtypes] == ["boolean", "bigint", "bigint"]


def test_metadata_survives_order(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    tagged = df.select(df.b.alias("b", metadata={"description": "B"}), "a")
    assert order_columns(tagged, ColumnRoles((), ())).schema["b"].metadata == {"description": "B"}


@pytest.mark.parametrize("text", ["5\u2028", "1.5\u0085", "7\u2029", "1e3\n\u2028"])
def test_line_separators_are_no_blanks(spark, text):
    """Such a text is no number, so its column stays text and keeps it."""
    df = spark.createDataFrame([(text,), ("6",)], "a string")
    assert inferred(df) == {"a": "string"}
    assert sorted(r.a for r in apply_types(df, inferred(df), proven=True).collect()) == sorted([text, "6"])


def test_a_broken_proof_fails(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="not bigint after all"):
        apply_types(df, {"a": "bigint"}, proven=True).collect()
    assert apply_types(spark.createDataFrame([(None,), ("NA",), (" 3 ",)], "a string"), {"a": "bigint"}, proven=True).collect() == [
        (None,), (None,), (3,)]
