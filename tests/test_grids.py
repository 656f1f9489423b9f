"""Definitions out of table grids."""

from drydock.operators.grids import clean_tables, detect_column_roles, non_trivial_grids, promote_header

SCHEMA = "doc string, table_id int, row_no int, col_no int, text string"


def cells(spark, *grids, doc="d"):
    return spark.createDataFrame(
        [(doc, t, r, c, text) for t, grid in enumerate(grids) for r, row in enumerate(grid) for c, text in enumerate(row)],
        SCHEMA)


def cleaned(spark, *grids, **kw):
    rows = clean_tables(cells(spark, *grids), "doc", by=["variable"], **kw).collect()
    return [(r.variable, r.description, r.table) for r in rows]


def test_headers_are_named(spark):
    head = promote_header(cells(spark, [[" A ", None, "", " "], ["1", "2", "3", "4"]]), "doc").orderBy("col_no")
    assert [r.header for r in head.collect()] == ["A", "col_1", "col_2", ""]


def test_last_fitting_header_wins(spark):
    roles = detect_column_roles(promote_header(cells(
        spark, [["Field", "Definition", "Column Name", "Desc"], ["x"] * 4],
        [["Alpha", "Beta"], ["x", "y"]], [["Description", "Beta"], ["x", "y"]], [["Only"], ["x"]]), "doc"), "doc")
    found = {r.table_id: (r.name_col, r.text_col, r.name_header) for r in roles.collect()}
    assert found == {0: (2, 3, "COLUMN NAME"), 1: (0, 1, "ALPHA"), 2: (0, 0, "DESCRIPTION")}


def test_rows_which_look_like_variables(spark):
    assert cleaned(spark, [["Name", "Description"], ["good_one", " text "], ["NAME", "header again"], ["two words", "x"],
                           ["1st", "x"], [None, "x"], ["blank", " "], ["", "x"], ["none", None]]) == [
        ("GOOD_ONE", "text", "table_1")]


def test_first_kept_and_grids_numbered(spark):
    grids = [[["Name", "Description"]],
             [["Name", "Description"], ["b", "first"], ["a", "x"], ["b", "again"]],
             [["Name", "Description"], ["B", "later"], ["c", "y"]]]
    assert [r.grid_no for r in non_trivial_grids(cells(spark, *grids), "doc").orderBy("table_id").collect()] == [1, 2]
    want = [("A", "x", "table_1"), ("B", "first", "table_1"), ("C", "y", "table_2")]
    assert cleaned(spark, *grids) == want
    assert cleaned(spark, *grids, table_map={"table_1": "ATTRIBUTES"})[0] == ("A", "x", "ATTRIBUTES")
