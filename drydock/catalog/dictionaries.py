"""Registered queries: dictionaries, sequences, pages, descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drydock.catalog.common import SQL_BLANKS, SQL_WHITESPACE, table
from drydock.config import Dataset, Registry
from drydock.functions.text import is_page_number
from drydock.operators.describe import attach_descriptions, descriptions_for
from drydock.operators.dictionary import (
    build_dictionary, load_dictionary, preview, read_dictionary, section_counts,
    select_dictionary_columns, without_definitions)
from drydock.operators.distinct import keep_first
from drydock.operators.grids import (
    clean_tables, detect_column_roles, grid_kinds, looks_like_variable, promote_header)
from drydock.operators.lookups import (
    described, dictionary_coverage, join_descriptions, with_dataset_description, with_dictionary_table)
from drydock.operators.pages import assemble_pages
from drydock.operators.sequences import explode_lines, forward_fill, segment
from drydock.operators.stanzas import compose_description, definition_name, parse_stanzas
from drydock.session import scratch
from drydock.sinks.parquet import publish, read_column_catalog
from drydock.sinks.text import write_dictionary_csv, write_text
from drydock.sources.listing import column_catalog


# -- loading and choosing ----------------------------------------------------------


def _turns_as_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as dictionary rows: a variable per conversation, a table per role;
    opening turns have a blank full text."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        "turn", F.concat(F.lit(" v"), F.col("conv_id").cast("string")).alias("variable"),
        F.concat(F.col("role"), F.lit(" ")).alias("table"), F.lit("TEXT").alias("data_type"),
        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("description"),
        F.when(F.col("turn") == 0, "  ").otherwise(F.col("text")).alias("full_description"))


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_dictionary(_turns_as_dictionary(spark, sf_dir), F.col("turn"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary written as CSV, texts of several lines included, and read back."""
    path = scratch(spark, "dictionary")
    definitions = last_wins(spark, sf_dir).withColumn("full_description", F.col("description"))
    write_dictionary_csv(definitions, path)
    return read_dictionary(spark, path)


def first_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First word of each document as a name, its source as the text."""
    documents = table(spark, sf_dir, "documents")
    names = documents.select(
        "doc_id", F.split(F.col("text"), r"[ \n]")[0].alias("name"), F.col("source").alias("description"))
    fitting = looks_like_variable(names, "name", "description").select(
        F.upper("name").alias("variable"), "doc_id", "description")
    return keep_first(fitting, ["variable"], F.col("doc_id")).orderBy("variable")


def _part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_brand").alias("table"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("column"))


def _part_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts describe their name; later parts overwrite earlier ones."""
    raw = table(spark, sf_dir, "part").filter("p_size > 40").select(
        "p_partkey", F.col("p_brand").alias("table"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("variable"), F.col("p_type").alias("description"))
    return load_dictionary(raw, F.col("p_partkey"))


def described_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_descriptions(_part_columns(spark, sf_dir), _part_dictionary(spark, sf_dir)).select(
        "p_partkey", "table", "column", "description")


def parts_with_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = described(_part_columns(spark, sf_dir), _part_dictionary(spark, sf_dir))
    return found.groupBy("table").agg(F.count("*").alias("described"))


def labels_that_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each label of a dictionary of large parts serves, in tables which hold the parts of even keys."""
    return dictionary_coverage(_part_columns(spark, sf_dir).filter("p_partkey % 2 = 0 AND table < 'BRAND#4'"),
                               _part_dictionary(spark, sf_dir))


EVENT_REGISTRY = Registry((
    Dataset("view", "VIEW", "VISITS", "Pages seen"), Dataset("click", "CLICK", "VISITS", "Links followed"),
    Dataset("purchase", "PURCHASE", "SALES", "Things bought")))


def events_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return with_dataset_description(
        with_dictionary_table(events, EVENT_REGISTRY, "event_type"), EVENT_REGISTRY, "event_type")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_counts(table(spark, sf_dir, "events"), "event_type", "event_id")


def first_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("variable"), F.col("p_brand").alias("table"),
        F.lit("TEXT").alias("data_type"), F.col("p_type").alias("description"))
    return preview(definitions, ["p_partkey"])


def dictionary_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = last_wins(spark, sf_dir).withColumn("full_description", F.length("description").cast("string"))
    return select_dictionary_columns(definitions)


# -- fields ------------------------------------------------------------------------


def names_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("COLUMN:  "), F.replace("p_name", F.lit(" "), F.lit("_")),
                    F.lit(" ("), F.col("p_brand"), F.lit(") ("), F.col("p_type"), F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", definition_name(line).alias("variable"))


def composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role as short text (none for the system), turn as body (none for users)."""
    short = F.when(F.col("role") == "system", "").otherwise(F.col("role"))
    body = F.when(F.col("role") != "user", F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", compose_description(short, body).alias("full_description"))


def stripped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"]).withColumn(
        "line_no", F.col("line_no").cast("bigint"))


def lines_without_page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left once page numbers and blank lines go. Each text gets its key
    as a first line and two numbers as last ones; up to three digits count as
    a page number."""
    documents = table(spark, sf_dir, "documents")
    paged = documents.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit("\n "),
                                                F.col("text"), F.lit("\n12345\n 7 ")).alias("text"))
    lines = explode_lines(paged, "text", ["doc_id"])
    kept = lines.filter((F.col("line") != "") & ~is_page_number(F.col("line"), 3))
    return kept.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


# -- sequences ---------------------------------------------------------------------


def last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return forward_fill(events, ["user_id"], "event_id",
                        F.when(F.col("event_type") == "purchase", F.col("value")), "last_purchase").drop("value")


def running_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence of all lines of order: the latest urgent order so far."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    marker = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey").cast("string"))
    return forward_fill(orders, ["o_orderstatus"], "o_orderkey", marker, "section", start="UNKNOWN").drop(
        "o_orderpriority")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return segment(turns, ["conv_id"], "turn", F.col("role") == "user")


def turn_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = forward_fill(_segments(spark, sf_dir), ["conv_id"], "turn",
                          F.when(F.col("role") == "system", F.col("text")), "section", start="UNKNOWN")
    return marked.select("conv_id", "turn", "role", "segment", "section")


def segment_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment: its last answer, and all lines after the question."""
    turn = F.col("turn")
    return _segments(spark, sf_dir).filter("segment > 0").groupBy("conv_id", "segment").agg(
        F.max_by("text", F.when(F.col("role") == "assistant", turn)).alias("answer"),
        F.expr("listagg(text, ' ') WITHIN GROUP (ORDER BY turn) FILTER (WHERE role <> 'user')").alias("body"))


def pages_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_pages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled texts written out and read back as lines, counted."""
    path = scratch(spark, "text")
    write_text(pages_joined(spark, sf_dir), path, "conv_id")
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


# -- stanzas -----------------------------------------------------------------------


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary text per brand: one page, and one stanza, per part.

    Markers stand before some stanzas; others stand between a column line and
    its description, where they are swallowed. Some stanzas have a second
    description, no data type, page numbers, or text after a stop phrase.
    """
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    marker = (F.when(F.col("p_type") == "ECONOMY", "SECTION IV of the dictionary")
              .when(F.col("p_type") == "SMALL", "SECTION V of the dictionary")
              .when(F.col("p_type") == "LARGE", "SECTION VII"))
    swallowed = F.when(F.col("p_size") < 10, "TRANSFORMATIONS TABLE DETAILS")
    kind = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("DATA TYPE: CHAR ["), F.col("p_size"), F.lit("]")))
    short = F.when(F.col("p_size") < 45, F.concat(F.lit("DESCRIPTION: "), F.col("p_brand"))).otherwise("DESCRIPTION:")
    second = F.when(F.col("p_size") > 40, F.concat(F.lit("DESCRIPTION: again "), F.col("p_brand")))
    stop = F.when(F.col("p_type") == "PROMO", "ATTRIBUTES TABLE follows\nDATA TYPE: LOST\nlost text")
    text = F.concat_ws(
        "\n", marker,
        F.concat(F.lit("  COLUMN: "), name, F.lit(" ("), F.col("p_brand"), F.lit(")")),
        swallowed, kind, short, F.concat(F.lit("  sold   as\t"), "p_type"), F.col("p_size").cast("string"),
        F.lit(""), F.concat(F.lit("priced "), F.col("p_retailprice").cast("string")), second, stop)
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("doc"), F.col("p_partkey").alias("page"), text.alias("text"))


def stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_stanzas(part_pages(spark, sf_dir), "doc", "page", "text")


def names_long_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stanzas of which every third has a name of one letter, or none."""
    name = (F.when(F.col("p_partkey") % 3 == 0, "Q (x)").when(F.col("p_partkey") % 3 == 1, F.col("p_brand"))
            .otherwise(F.replace("p_name", F.lit(" "), F.lit("_"))))
    blank = F.when(F.col("p_size") == 7, "").otherwise(name)
    pages = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("doc"), F.col("p_partkey").alias("page"),
        F.concat(F.lit("COLUMN: "), blank, F.lit("\nDESCRIPTION: "), "p_brand").alias("text"))
    return parse_stanzas(pages, "doc", "page", "text").select("doc", "variable", "description")


_STANZAS = (
    "SELECT p_partkey, p_brand AS doc, p_partkey * 2147483648 "
    "+ CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'LARGE') THEN 1 ELSE 0 END AS seq, upper(replace(p_name, ' ', '_')) AS variable, "
    "coalesce(last_value(CASE p_type WHEN 'ECONOMY' THEN 'ATTRIBUTES' WHEN 'SMALL' THEN 'RELATIONSHIPS' "
    "WHEN 'LARGE' THEN 'TRANSFORMATIONS' END IGNORE NULLS) OVER "
    "(PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING), 'UNKNOWN') AS \"table\", "
    "CASE WHEN p_size % 2 = 0 THEN 'CHAR [' || p_size || ']' ELSE '' END AS data_type, "
    "CASE WHEN p_size > 40 THEN 'again ' || p_brand WHEN p_size < 45 THEN p_brand ELSE '' END AS description, "
    "CASE WHEN p_size > 40 THEN 'again ' || p_brand WHEN p_size < 45 THEN p_brand ELSE '' END "
    "|| '. sold as ' || p_type || ' priced ' || p_retailprice AS full_description FROM part")


# -- grids -------------------------------------------------------------------------


def part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of parts: a document per type, a grid per brand.

    Brands of two digits have telling headers; the others have none that fit,
    so their first two columns count. Large parts lack a text.
    """
    part = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("doc"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint").alias("table_id"),
        (F.col("p_partkey") + 1).alias("row_no"),
        F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"),
        F.when(F.col("p_size") < 45, F.concat(F.lit("size "), "p_size")).alias("words"),
        F.col("p_retailprice").cast("string").alias("price"))
    telling = F.col("table_id") >= 10
    rows = part.select("doc", "table_id", "row_no", F.when(telling, F.array("price", "name", "words"))
                       .otherwise(F.array("name", "words", "price")).alias("cells"))
    heads = part.select("doc", "table_id").distinct().select(
        "doc", "table_id", F.lit(0).cast("bigint").alias("row_no"),
        F.when(telling, F.array(F.lit("Price"), F.lit(" Field Name"), F.lit("Definition ")))
        .otherwise(F.array(F.lit("Alpha"), F.lit(None), F.lit("Gamma"))).alias("cells"))
    return rows.unionByName(heads).select(
        "doc", "table_id", "row_no", F.posexplode("cells").alias("col_no", "text"))


def grid_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_column_roles(promote_header(part_cells(spark, sf_dir), "doc"), "doc")


def grids_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of odd brands have a header and nothing else: they are dropped."""
    cells = part_cells(spark, sf_dir).filter((F.col("row_no") == 0) | (F.col("table_id") % 2 == 0))
    return grid_kinds(cells, "doc").select("doc", "table_id", F.col("grid_no").cast("bigint").alias("grid_no"))


def grid_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_tables(part_cells(spark, sf_dir), "doc", by=["doc", "variable"])


_GRIDS = (
    "SELECT doc, variable, arg_min(description, row_key) AS description, "
    "'table_' || arg_min(grid_no, row_key) AS \"table\", '' AS data_type FROM ("
    "SELECT p_type AS doc, upper(replace(p_name, ' ', '_')) AS variable, 'size ' || p_size AS description, "
    "p_size, brand, grid_no, grid_no * 1000000000 + p_partkey AS row_key FROM ("
    "SELECT *, dense_rank() OVER (PARTITION BY p_type ORDER BY brand) AS grid_no "
    "FROM (SELECT *, replace(p_brand, 'Brand#', '')::BIGINT AS brand FROM part))) "
    "WHERE p_size < 45 GROUP BY doc, variable")


def _strategy_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents per type. Grids describe ECONOMY and SMALL; every type has
    pages, but those of PROMO hold no definitions."""
    cells = part_cells(spark, sf_dir).filter(F.col("doc").isin("ECONOMY", "SMALL"))
    text = F.concat(F.lit("COLUMN: "), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("\nDESCRIPTION: "), "p_brand")
    pages = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("doc"), F.col("p_partkey").alias("page"),
        F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(text).alias("text"))
    return cells, pages


def strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, pages = _strategy_inputs(spark, sf_dir)
    return build_dictionary(cells, pages, "doc", "page", "text")


def unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, pages = _strategy_inputs(spark, sf_dir)
    return without_definitions(pages, build_dictionary(cells, pages, "doc", "page", "text"), "doc", "page")


# -- descriptions on columns ---------------------------------------------------------


def _measured_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary which describes columns of part by what is in them."""
    part = table(spark, sf_dir, "part")
    def entry(name: str, variable: str, text) -> Column:
        return F.struct(F.lit(name).alias("table"), F.lit(variable).alias("variable"), text.alias("description"))

    rows = part.agg(F.array(
        entry("PART", " p_size ", F.concat(F.lit("from "), F.min("p_size"), F.lit(" to "), F.max("p_size"))),
        entry("part", "P_BRAND", F.concat(F.countDistinct("p_brand").cast("string"), F.lit(" brands"))),
        entry("ORDERS", "P_NAME", F.lit("not this table")),
    ).alias("rows"))
    return load_dictionary(rows.select(F.inline("rows")), F.lit(0))


def catalog_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions through Parquet: once from its schema, once from the side table."""
    out = scratch(spark, "columns")
    part = table(spark, sf_dir, "part")
    texts = descriptions_for(part, _measured_dictionary(spark, sf_dir), "PART")
    path = publish(attach_descriptions(part, texts), out, "part")
    return column_catalog(spark.read.parquet(path), "schema").unionByName(
        read_column_catalog(spark, out, "part"))


QUERIES = {
    "dictionary_last_wins": last_wins,
    "dictionary_csv_roundtrip": csv_roundtrip,
    "dictionary_columns": dictionary_columns,
    "variable_keep_first": first_kept,
    "describe_columns": described_parts,
    "described_counts": parts_with_entry,
    "dictionary_coverage": labels_that_describe,
    "dataset_tables": events_by_dataset,
    "section_counts": sections,
    "dictionary_preview": first_ten,
    "definition_names": names_from_lines,
    "compose_description": composed,
    "explode_lines": stripped_lines,
    "drop_page_numbers": lines_without_page_numbers,
    "forward_fill": last_purchase,
    "forward_fill_section": running_section,
    "segment_turns": turn_segments,
    "segment_fields": segment_fields,
    "assemble_pages": pages_joined,
    "write_text": text_sink,
    "parse_stanzas": stanzas,
    "short_names": names_long_enough,
    "grids_with_rows": grids_kept,
    "grid_roles": grid_roles,
    "clean_tables": grid_definitions,
    "dictionary_strategy": strategy,
    "dictionary_failures": unreadable,
    "column_catalog": catalog_of_columns,
}

_LAST = (
    "SELECT upper(role) AS \"table\", 'V' || conv_id AS variable, 'TEXT' AS data_type, "
    "arg_max(CASE WHEN turn = 0 THEN 'turn 0' ELSE text END, turn) AS description "
    "FROM conversations GROUP BY role, conv_id")
_ENTRIES = (
    "(SELECT upper(p_brand) AS \"table\", upper(replace(p_name, ' ', '_')) AS variable, "
    "arg_max(p_type, p_partkey) AS description FROM part WHERE p_size > 40 GROUP BY 1, 2)")
_PART_COLUMNS = (
    "(SELECT p_partkey, upper(p_brand) AS \"table\", replace(p_name, ' ', '_') AS \"column\" FROM part)")
_SEGMENTS = (
    "(SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER "
    "(PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM conversations)")
_LINES = "string_split(text, chr(10))"
_CATALOG_ROWS = (
    "SELECT unnest(['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice']) AS \"column\", "
    "unnest(['bigint', 'string', 'string', 'string', 'int', 'double']) AS type, "
    "unnest(range(6))::INTEGER AS position")

ORACLES = {
    "dictionary_last_wins": _LAST,
    "dictionary_csv_roundtrip": _LAST,
    "dictionary_columns": (
        "SELECT variable, \"table\", data_type, description, length(description)::VARCHAR AS full_description "
        f"FROM ({_LAST})"),
    "variable_keep_first": (
        "SELECT upper(name) AS variable, min(doc_id) AS doc_id, arg_min(source, doc_id) AS description "
        "FROM (SELECT doc_id, source, replace(regexp_extract(text, '^[^ \\n]*'), 'ß', 'ss') AS name FROM documents) "
        "WHERE regexp_full_match(upper(name), '[A-Z][A-Z0-9_]*') AND source <> '' GROUP BY upper(name)"),
    "describe_columns": (
        "SELECT c.p_partkey, c.\"table\", c.\"column\", coalesce(d.description, '') AS description "
        f"FROM {_PART_COLUMNS} c LEFT JOIN {_ENTRIES} d "
        "ON c.\"table\" = d.\"table\" AND upper(c.\"column\") = d.variable"),
    "dictionary_coverage": (
        "WITH entry AS (SELECT DISTINCT upper(p_brand) AS \"table\", upper(replace(p_name, ' ', '_')) AS variable "
        "FROM part WHERE p_size > 40), held AS (SELECT DISTINCT upper(p_brand) AS \"table\", "
        "upper(replace(p_name, ' ', '_')) AS variable, 1 AS met FROM part WHERE p_partkey % 2 = 0 AND upper(p_brand) < 'BRAND#4') "
        "SELECT \"table\", count(*) AS entries, count(met) AS describing, "
        "\"table\" IN (SELECT \"table\" FROM held) AS found FROM entry LEFT JOIN held USING (\"table\", variable) GROUP BY 1"),
    "described_counts": (
        f"SELECT c.\"table\", count(*)::BIGINT AS described FROM {_PART_COLUMNS} c JOIN {_ENTRIES} d "
        "ON c.\"table\" = d.\"table\" AND upper(c.\"column\") = d.variable GROUP BY c.\"table\""),
    "dataset_tables": (
        "SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click') THEN 'VISITS' "
        "WHEN event_type = 'purchase' THEN 'SALES' ELSE 'UNKNOWN' END AS dict_table, "
        "CASE event_type WHEN 'view' THEN 'Pages seen' WHEN 'click' THEN 'Links followed' "
        "WHEN 'purchase' THEN 'Things bought' ELSE 'Unknown dataset' END AS description FROM events"),
    "section_counts": (
        "SELECT event_type, count(*)::BIGINT AS n, min(event_id) AS first_seq FROM events GROUP BY event_type"),
    "dictionary_preview": (
        "SELECT p_name AS variable, p_brand AS \"table\", 'TEXT' AS data_type, p_type AS description "
        "FROM part ORDER BY p_partkey LIMIT 10"),
    "definition_names": "SELECT p_partkey, upper(replace(p_name, ' ', '_')) AS variable FROM part",
    "compose_description": (
        "SELECT conv_id, turn, CASE role WHEN 'user' THEN 'user' WHEN 'system' THEN body "
        "ELSE role || '. ' || body END AS full_description FROM (SELECT *, "
        f"trim(regexp_replace(text, '{SQL_BLANKS}+', ' ', 'g')) AS body FROM conversations)"),
    "explode_lines": (
        f"SELECT doc_id, (i - 1)::BIGINT AS line_no, trim({_LINES}[i], {SQL_WHITESPACE}) AS line "
        f"FROM (SELECT doc_id, text, unnest(range(1, len({_LINES}) + 1)) AS i FROM documents)"),
    "drop_page_numbers": (
        "SELECT doc_id, count(*)::BIGINT AS lines, sum(length(line))::BIGINT AS chars FROM (SELECT doc_id, "
        f"trim(unnest({_LINES}), {SQL_WHITESPACE}) AS line FROM (SELECT doc_id, "
        "doc_id || chr(10) || ' ' || text || chr(10) || '12345' || chr(10) || ' 7 ' AS text FROM documents)) "
        "WHERE line <> '' AND NOT regexp_full_match(line, '\\p{Nd}{1,3}') GROUP BY doc_id"),
    "forward_fill": (
        "SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'purchase' THEN value END "
        "IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_purchase "
        "FROM events"),
    "forward_fill_section": (
        "SELECT o_orderkey, o_orderstatus, coalesce(last_value(CASE WHEN o_orderpriority = '1-URGENT' "
        "THEN o_orderkey::VARCHAR END IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey "
        "ROWS UNBOUNDED PRECEDING), 'UNKNOWN') AS section FROM orders"),
    "segment_turns": (
        "SELECT conv_id, turn, role, segment, coalesce(last_value(CASE WHEN role = 'system' THEN text END "
        "IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'UNKNOWN') AS section "
        f"FROM {_SEGMENTS}"),
    "segment_fields": (
        "SELECT conv_id, segment, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS answer, "
        "string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role <> 'user') AS body "
        f"FROM {_SEGMENTS} WHERE segment > 0 GROUP BY conv_id, segment"),
    "assemble_pages": (
        "SELECT conv_id, 0::INTEGER AS part_no, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, "
        "length(string_agg(text, chr(10) || chr(10) ORDER BY turn))::BIGINT AS n_chars "
        "FROM conversations WHERE length(text) > 0 GROUP BY conv_id"),
    "write_text": (
        f"SELECT line, count(*)::BIGINT AS n FROM (SELECT unnest({_LINES}) AS line FROM (SELECT "
        "string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations "
        "WHERE length(text) > 0 GROUP BY conv_id)) GROUP BY line"),
    "parse_stanzas": f"SELECT * EXCLUDE (p_partkey) FROM ({_STANZAS})",
    "short_names": (
        "SELECT p_type AS doc, upper(CASE p_partkey % 3 WHEN 1 THEN p_brand ELSE replace(p_name, ' ', '_') END) "
        "AS variable, p_brand AS description FROM part WHERE p_partkey % 3 <> 0 AND p_size <> 7"),
    "grids_with_rows": (
        "SELECT doc, table_id, dense_rank() OVER (PARTITION BY doc ORDER BY table_id)::BIGINT AS grid_no FROM ("
        "SELECT DISTINCT p_type AS doc, replace(p_brand, 'Brand#', '')::BIGINT AS table_id FROM part) "
        "WHERE table_id % 2 = 0"),
    "grid_roles": (
        "SELECT DISTINCT p_type AS doc, brand AS table_id, "
        "CASE WHEN brand >= 10 THEN 1 ELSE 0 END::INTEGER AS name_col, "
        "CASE WHEN brand >= 10 THEN 2 ELSE 1 END::INTEGER AS text_col, "
        "CASE WHEN brand >= 10 THEN 'FIELD NAME' ELSE 'ALPHA' END AS name_header "
        "FROM (SELECT *, replace(p_brand, 'Brand#', '')::BIGINT AS brand FROM part)"),
    "clean_tables": _GRIDS,
    "dictionary_strategy": (
        "SELECT doc, variable, \"table\", data_type, description, NULL::VARCHAR AS full_description, "
        f"'grid' AS route FROM ({_GRIDS}) WHERE doc IN ('ECONOMY', 'SMALL') UNION ALL "
        "SELECT p_type, upper(replace(p_name, ' ', '_')), 'UNKNOWN', '', p_brand, p_brand, 'text' "
        "FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO')"),
    "dictionary_failures": (
        "SELECT p_type AS doc, p_partkey AS page, p_name AS text FROM part WHERE p_type = 'PROMO'"),
    "column_catalog": (
        "SELECT dataset, position, \"column\", type, CASE \"column\" "
        "WHEN 'p_size' THEN (SELECT 'from ' || min(p_size) || ' to ' || max(p_size) FROM part) "
        "WHEN 'p_brand' THEN (SELECT count(DISTINCT p_brand) || ' brands' FROM part) END AS description "
        f"FROM ({_CATALOG_ROWS}), (SELECT unnest(['schema', 'part']) AS dataset)"),
}
