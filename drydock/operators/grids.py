"""Variable definitions out of extracted table grids.

A grid is a set of cells ``(table_id, row_no, col_no, text)`` whose row 0 is
the header; several documents may share a table of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from drydock.config import GridRoles
from drydock.functions.text import contains_any, strip
from drydock.operators.distinct import keep_first
from drydock.operators.lookups import lookup
from drydock.operators.sequences import BLOCK_ROWS, segment


def _numbered(grids: DataFrame, doc: str) -> DataFrame:
    """Number the grids of each document from 1. A grid is one row here, and
    ``table_id`` counts a document's tables, so blocks are cut by it."""
    cut = grids.withColumn("_block", F.floor(F.col("table_id") / F.lit(BLOCK_ROWS)).cast("bigint"))
    return segment(cut, [doc], "table_id", F.lit(True), "grid_no", "_block").drop("_block")


def non_trivial_grids(cells: DataFrame, doc: str) -> DataFrame:
    """Grids with a header and at least one row, numbered per document from 1."""
    grids = (cells.groupBy(doc, "table_id")
             .agg(F.max("row_no").alias("_last"), F.min("row_no").alias("_first"))
             .filter(F.col("_last") > F.col("_first")))
    return _numbered(grids, doc).select(doc, "table_id", "grid_no")


def _header(text, col_no):
    """A header cell: stripped, a blank one named by its column."""
    filled = F.coalesce(text, F.lit("")) != ""
    return F.when(filled, strip(text)).otherwise(F.concat(F.lit("col_"), col_no.cast("string")))


def promote_header(cells: DataFrame, doc: str) -> DataFrame:
    """Headers ``(doc, table_id, col_no, header)``: stripped, blank ones named."""
    return cells.filter(F.col("row_no") == 0).select(
        doc, "table_id", "col_no", _header(F.col("text"), F.col("col_no")).alias("header"))


def _roles(header, col_no, roles: GridRoles) -> list:
    """Aggregates over header cells; ``header`` and ``col_no`` are null for others."""
    lowered = F.lower(header)
    is_name = contains_any(lowered, roles.name_words)
    is_text = ~is_name & contains_any(lowered, roles.text_words)
    tagged = strip(F.upper(header))
    return [
        F.coalesce(F.max(F.when(is_name, col_no)), F.min(col_no)).alias("name_col"),
        F.coalesce(F.max(F.when(is_text, col_no)), F.min(F.when(col_no > 0, col_no))).alias("text_col"),
        F.coalesce(F.max_by(tagged, F.when(is_name, col_no)), F.min_by(tagged, col_no)).alias("name_header")]


def detect_column_roles(headers: DataFrame, doc: str, roles: GridRoles = GridRoles()) -> DataFrame:
    """Per grid, the columns holding names and texts: the last header with a
    fitting word, else the first and the second column."""
    return headers.groupBy(doc, "table_id").agg(*_roles(F.col("header"), F.col("col_no"), roles)).filter(
        F.col("text_col").isNotNull())


def looks_like_variable(df: DataFrame, name: str, text: str, header: str | None = None,
                        roles: GridRoles = GridRoles()) -> DataFrame:
    """Rows with a name of variable form and a text; repeated headers dropped."""
    upper = F.upper(F.col(name))
    fits = (F.col(name) != "") & (F.col(text) != "") & upper.rlike(roles.name_pattern)
    return df.filter(fits if header is None else fits & (upper != F.col(header)))


def grid_kinds(cells: DataFrame, doc: str, roles: GridRoles = GridRoles()) -> DataFrame:
    """Grids with a header and at least one row: their roles, and their number per
    document from 1. One aggregation over the cells tells all of it."""
    is_head = F.col("row_no") == 0
    header = F.when(is_head, _header(F.col("text"), F.col("col_no")))
    marked = cells.select(doc, "table_id", "row_no", header.alias("_head"),
                          F.when(is_head, F.col("col_no")).alias("_col"))
    grids = (marked.groupBy(doc, "table_id")
             .agg(F.max("row_no").alias("_last"), F.min("row_no").alias("_first"),
                  *_roles(F.col("_head"), F.col("_col"), roles))
             .filter(F.col("_last") > F.col("_first")).drop("_last", "_first"))
    return _numbered(grids, doc).filter(F.col("text_col").isNotNull())


def grid_rows(cells: DataFrame, doc: str, roles: GridRoles = GridRoles()) -> DataFrame:
    """Rows of all grids as ``(doc, grid_no, row_no, variable, description)``."""
    placed = lookup(cells.filter(F.col("row_no") > 0), grid_kinds(cells, doc, roles), [doc, "table_id"], "inner")
    value, col_no = strip(F.coalesce("text", F.lit(""))), F.col("col_no")
    rows = (
        placed.filter((col_no == F.col("name_col")) | (col_no == F.col("text_col")))
        .groupBy(doc, "table_id", "grid_no", "row_no").agg(
            F.max("name_header").alias("name_header"),
            F.coalesce(F.max(F.when(col_no == F.col("name_col"), value)), F.lit("")).alias("name"),
            F.coalesce(F.max(F.when(col_no == F.col("text_col"), value)), F.lit("")).alias("description")))
    fitting = looks_like_variable(rows, "name", "description", "name_header", roles)
    return fitting.select(doc, "grid_no", "row_no", F.upper("name").alias("variable"), "description")


def clean_tables(cells: DataFrame, doc: str, roles: GridRoles = GridRoles(),
                 table_map: dict[str, str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One definition per variable, the first met, as ``(doc, variable,
    description, table, data_type)``.

    Grids are labelled ``table_1``, ``table_2`` ...; ``table_map`` renames them
    to the dictionary tables they really describe.
    """
    rows = grid_rows(cells, doc, roles)
    first = keep_first(rows, [doc, "variable"], F.struct("grid_no", "row_no"))
    label = F.concat(F.lit("table_"), F.col("grid_no").cast("string"))
    table = label
    for grid, name in (table_map or {}).items():
        table = F.when(label == grid, F.lit(name)).otherwise(table)
    cleaned = first.select(doc, "variable", "description", table.alias("table"), F.lit("").alias("data_type"))
    return cleaned.orderBy(*by) if by else cleaned
