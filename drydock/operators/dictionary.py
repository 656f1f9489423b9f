"""The variable dictionary: loading it, building it, looking at it."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drydock.config import DictionaryGrammar, GridRoles
from drydock.functions.text import blank_to_null, upper_strip
from drydock.operators.distinct import keep_last
from drydock.operators.grids import clean_tables
from drydock.operators.infer import blank_null_tokens
from drydock.operators.lookups import exclude
from drydock.operators.stanzas import parse_stanzas
from drydock.session import scratch

# Column order of the dictionary file, and of its preview.
DICTIONARY_COLUMNS = ("variable", "table", "data_type", "description", "full_description")
PREVIEW_COLUMNS = ("variable", "table", "data_type", "description")

_EMPTY = "table string, variable string, data_type string, description string"


def load_dictionary(raw: DataFrame, order: Column, table_map: dict[str, str] | None = None) -> DataFrame:
    """One description per ``(table, variable)``; later rows overwrite earlier.

    The full text is preferred to the short one, blanks counting as absent;
    rows without a variable or any text are no entries.
    """
    def text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    table = F.coalesce(upper_strip(text("table")), F.lit(""))
    for old, new in (table_map or {}).items():
        table = F.when(table == old.upper(), F.lit(new.upper())).otherwise(table)
    entries = raw.select(
        table.alias("table"), upper_strip(text("variable")).alias("variable"),
        F.coalesce(text("data_type"), F.lit("")).alias("data_type"),
        F.coalesce(blank_to_null(text("full_description")), blank_to_null(text("description"))).alias("description"),
        order.alias("_order"))
    entries = entries.filter((F.col("variable") != "") & F.col("description").isNotNull())
    return keep_last(entries, ["table", "variable"], F.col("_order")).drop("_order")


def read_dictionary(spark: SparkSession, path: str, table_map: dict[str, str] | None = None) -> DataFrame:
    """A dictionary file; an absent or unreadable one is empty, with a warning."""
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    except AnalysisException as fault:
        if "PATH_NOT_FOUND" not in str(fault):
            warnings.warn(f"could not load the dictionary: {fault}", stacklevel=2)
        return spark.createDataFrame([], _EMPTY)
    if "variable" not in raw.columns:
        warnings.warn(f"{path} has no column 'variable'", stacklevel=2)
        return spark.createDataFrame([], _EMPTY)
    # A multi-line file is read by one task in order, so its row ids ascend.
    numbered = blank_null_tokens(raw).withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_file", F.input_file_name())
    return load_dictionary(numbered, F.struct("_file", "_row"), table_map)


def select_dictionary_columns(definitions: DataFrame, preview: bool = False) -> DataFrame:
    return definitions.select(*(PREVIEW_COLUMNS if preview else DICTIONARY_COLUMNS))


def preview(definitions: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows of a dictionary (a top-k, not a full sort)."""
    return definitions.orderBy(*order).limit(rows).select(*PREVIEW_COLUMNS)


def section_counts(definitions: DataFrame, by: str, seq: str) -> DataFrame:
    """Definitions per section, sections in order of first appearance."""
    return (definitions.groupBy(by)
            .agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"))
            .orderBy("first_seq"))


def build_dictionary(cells: DataFrame, pages: DataFrame, doc: str, page: str, text: str,
                     grammar: DictionaryGrammar = DictionaryGrammar(), roles: GridRoles = GridRoles(),
                     table_map: dict[str, str] | None = None) -> DataFrame:
    """Definitions per document: from its grids if they give any, else its text.

    What the grids give is needed twice, so it is staged in the shared folder
    and the cells are gone through once. Spark splits the pages of a long document itself.
    """
    found = clean_tables(cells, doc, roles, table_map).select(
        doc, "variable", "table", "data_type", "description",
        F.lit(None).cast("string").alias("full_description"), F.lit("grid").alias("route"))
    staged_at = scratch(cells.sparkSession, "grids")
    found.write.parquet(staged_at)
    from_grids = cells.sparkSession.read.schema(found.schema).parquet(staged_at)
    others = exclude(pages, from_grids, [doc])
    from_text = parse_stanzas(others, doc, page, text, grammar).select(
        doc, "variable", "table", "data_type", "description", "full_description",
        F.lit("text").alias("route"))
    return from_grids.unionByName(from_text)


def without_definitions(pages: DataFrame, definitions: DataFrame, doc: str, page: str) -> DataFrame:
    """Pages of documents neither route could read, kept for a human reader."""
    return exclude(pages, definitions, [doc])
