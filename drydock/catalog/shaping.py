"""Registered queries: column names, order, coercion, inference, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.catalog.common import SQL_INTEGER, SQL_NUMBER, as_text, table
from drydock.config import NULL_TOKENS, ColumnRoles
from drydock.operators.columns import coerce_ids, coercion_report, map_types, standardize
from drydock.operators.infer import apply_types, blank_null_tokens, infer_types, inferred
from drydock.operators.union import union_members

LINE_ROLES = ColumnRoles(("L_ORDERKEY", "L_PARTKEY", "L_SUPPKEY"), ("L_SHIPDATE",))


def standardize_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    padded = F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" "))
    messy = lines.withColumn("l_orderkey", padded).withColumnRenamed("l_tax", " l_Tax ")
    return standardize(messy, LINE_ROLES)


# Texts which are, or nearly are, numbers: (column, Spark expression, SQL expression).
_NEAR_NUMBERS = (
    ("padded", "concat(' ', p_size, '\\t')", "concat(' ', p_size, chr(9))"),
    ("exponent", "concat(p_size, 'e2')", "concat(p_size, 'e2')"),
    ("suffixed", "concat(p_size, 'd')", "concat(p_size, 'd')"),
    ("grouped", "concat(p_size, '_000')", "concat(p_size, '_000')"),
    ("comma", "concat(p_size, ',000')", "concat(p_size, ',000')"),
    ("zeros", "concat('00', p_partkey)", "concat('00', p_partkey)"),
    ("hex", "concat('0x', p_size)", "concat('0x', p_size)"),
    ("brand", "p_brand", "p_brand"),
    ("number", "replace(p_brand, 'Brand#', '-')", "replace(p_brand, 'Brand#', '-')"),
    ("decimal", "concat(p_size, '.5')", "concat(p_size, '.5')"),
    ("whole", "concat(p_size, '.0')", "concat(p_size, '.0')"),
    ("endless", "if(p_size > 25, 'inf', '-Infinity')", "if(p_size > 25, 'inf', '-Infinity')"),
    ("overflow", "concat(p_size, 'e400')", "concat(p_size, 'e400')"),
    ("exact", "concat('90071992547409', p_size)", "concat('90071992547409', p_size)"),
    ("token", "if(p_size > 25, 'NA', '7')", "if(p_size > 25, 'NA', '7')"),
)


def _near_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", *[F.expr(e).alias(n) for n, e, _ in _NEAR_NUMBERS])


_IDS = tuple(n for n, _, _ in _NEAR_NUMBERS)


def ids_as_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_ids(_near_numbers(spark, sf_dir), _IDS)


def ids_as_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_ids(_near_numbers(spark, sf_dir), _IDS, mode="double")


def coercion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coercion_report(_near_numbers(spark, sf_dir), _IDS)


def _sql_double(x: str) -> str:
    bare = f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return (f"CASE WHEN regexp_full_match({x}, '{SQL_NUMBER}') AND "
            f"(isfinite(try_cast({bare} AS DOUBLE)) OR contains(lower({x}), 'inf')) "
            f"THEN try_cast({bare} AS DOUBLE) END")


def _sql_bigint(x: str) -> str:
    bare = f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    d = f"({_sql_double(x)})"
    return (f"CASE WHEN regexp_full_match({x}, '{SQL_INTEGER}') THEN try_cast({bare} AS BIGINT) "
            f"WHEN isfinite({d}) AND {d} = floor({d}) AND abs({d}) < 9.2e18 THEN try_cast({d} AS BIGINT) END")


_NEAR_SQL = "(SELECT p_partkey, " + ", ".join(f"{e} AS {n}" for n, _, e in _NEAR_NUMBERS) + " FROM part)"


# -- inference -----------------------------------------------------------------

# Derived columns, one per rule of the type lattice.
_TRICKY = (
    ("gap", "if(p_size > 25, 'NA', cast(p_size as string))", "if(p_size > 25, 'NA', p_size::VARCHAR)"),
    ("flag", "if(p_size > 25, 'True', 'false')", "if(p_size > 25, 'True', 'false')"),
    ("flag_gap", "if(p_size > 25, 'TRUE', '')", "if(p_size > 25, 'TRUE', '')"),
    ("flag_number", "if(p_size > 25, 'True', '1')", "if(p_size > 25, 'True', '1')"),
    ("code", "lpad(p_size, 4, '0')", "lpad(p_size::VARCHAR, 4, '0')"),
    ("huge", "concat('184467440737095', lpad(p_size, 5, '0'))", "concat('184467440737095', lpad(p_size::VARCHAR, 5, '0'))"),
    ("too_huge", "concat('184467440737096', lpad(p_size, 5, '0'))", "concat('184467440737096', lpad(p_size::VARCHAR, 5, '0'))"),
    ("huge_negative", "if(p_size > 25, '9223372036854775808', '-1')", "if(p_size > 25, '9223372036854775808', '-1')"),
    ("huge_fraction", "if(p_size > 25, '9223372036854775808', '1.5')", "if(p_size > 25, '9223372036854775808', '1.5')"),
    ("nothing", "if(p_size > 25, 'null', 'N/A')", "if(p_size > 25, 'null', 'N/A')"),
    ("mixed", "if(p_size > 25, '1', 'x')", "if(p_size > 25, '1', 'x')"),
    ("padded", "concat(' ', p_size, ' ')", "concat(' ', p_size, ' ')"),
    ("endless", "if(p_size > 25, 'inf', '1')", "if(p_size > 25, 'inf', '1')"),
)
_PLAIN = {
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "labels": ("doc_id", "quality", "toxic"),
}


def types_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = []
    for name in _PLAIN:
        df = table(spark, sf_dir, name)
        derived = [F.expr(e).alias(n) for n, e, _ in _TRICKY] if name == "part" else []
        texts = as_text(df.select("*", *derived))
        found.append(infer_types(texts).select(F.lit(name).alias("dataset"), "column", "type"))
    return reduce(DataFrame.unionByName, found)


def _sql_type(dataset: str, column: str, expression: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    bare = "trim(v, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    integer = f"regexp_full_match(v, '{SQL_INTEGER}')"
    number = f"regexp_full_match(v, '{SQL_NUMBER}')"
    wide = f"try_cast({bare} AS HUGEINT)"
    kind = (
        f"CASE WHEN v IN ('True','TRUE','true','False','FALSE','false') THEN 'bool' "
        f"WHEN {integer} AND {wide} BETWEEN -9223372036854775808 AND -1 THEN 'negative' "
        f"WHEN {integer} AND {wide} BETWEEN 0 AND 9223372036854775807 THEN 'int' "
        f"WHEN {integer} AND {wide} BETWEEN 9223372036854775808 AND 18446744073709551615 THEN 'wide' "
        f"WHEN {integer} THEN 'text' WHEN {number} THEN 'double' ELSE 'text' END")
    return (
        f"SELECT '{dataset}' AS dataset, '{column}' AS \"column\", CASE "
        "WHEN rows = 0 THEN 'string' WHEN kinds IS NULL OR len(kinds) = 0 THEN 'double' "
        "WHEN kinds = ['bool'] THEN 'boolean' "
        "WHEN list_has_any(kinds, ['bool', 'text']) THEN 'string' "
        "WHEN list_contains(kinds, 'double') THEN 'double' "
        "WHEN list_contains(kinds, 'wide') AND list_contains(kinds, 'negative') THEN 'string' "
        "WHEN list_contains(kinds, 'wide') THEN 'decimal(20,0)' ELSE 'bigint' END AS type "
        f"FROM (SELECT count(*) AS rows, array_agg(DISTINCT {kind}) FILTER (WHERE v IS NOT NULL) AS kinds "
        f"FROM (SELECT CASE WHEN x NOT IN ({tokens}) THEN x END AS v FROM "
        f"(SELECT ({expression})::VARCHAR AS x FROM {dataset})))")


_TYPES_SQL = " UNION ALL ".join(
    [_sql_type(t, c, c) for t, columns in _PLAIN.items() for c in columns]
    + [_sql_type("part", n, e) for n, _, e in _TRICKY])


def typed_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of lineitem to text, and back by inference."""
    texts = as_text(table(spark, sf_dir, "lineitem"))
    return apply_types(texts, inferred(texts), proven=True)


def tokens_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "view", "").when(F.col("event_type") == "click", "null ")
            .when(F.col("event_type") == "error", "#N/A").otherwise(F.col("event_type")))
    return blank_null_tokens(events.select("event_id", text.alias("event_type"), "props"))


def storage_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return map_types(part.withColumn("big", F.col("p_size") > 25)
                     .withColumn("price", F.col("p_retailprice").cast("float")))


def united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two members with different columns in different order, and types which disagree."""
    orders = table(spark, sf_dir, "orders")
    filled = orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("note"))
    other = orders.filter("o_orderstatus <> 'F'").select(
        F.col("o_custkey").alias("note"), "o_orderstatus", "o_orderkey", "o_orderdate")
    return union_members(filled, other)


QUERIES = {
    "standardize_lineitem": standardize_lineitem,
    "coerce_ids": ids_as_bigint,
    "coerce_ids_double": ids_as_double,
    "coercion_report": coercion_losses,
    "infer_types": types_of_tables,
    "apply_types": typed_again,
    "null_tokens": tokens_to_null,
    "map_types": storage_types,
    "union_members": united,
}

ORACLES = {
    "standardize_lineitem": (
        'SELECT l_orderkey AS "L_ORDERKEY", l_partkey AS "L_PARTKEY", l_suppkey AS "L_SUPPKEY", '
        'l_shipdate AS "L_SHIPDATE", l_discount AS "L_DISCOUNT", l_extendedprice AS "L_EXTENDEDPRICE", '
        'l_linenumber AS "L_LINENUMBER", l_linestatus AS "L_LINESTATUS", l_quantity AS "L_QUANTITY", '
        'l_returnflag AS "L_RETURNFLAG", l_tax AS "L_TAX" FROM lineitem'),
    "coerce_ids": "SELECT p_partkey, " + ", ".join(
        f"{_sql_bigint(n)} AS {n}" for n in _IDS) + f" FROM {_NEAR_SQL}",
    "coerce_ids_double": "SELECT p_partkey, " + ", ".join(
        f"{_sql_double(n)} AS {n}" for n in _IDS) + f" FROM {_NEAR_SQL}",
    "coercion_report": " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", count({n})::BIGINT AS present, "
        f"count(*) FILTER (WHERE {n} IS NOT NULL AND ({_sql_bigint(n)}) IS NULL)::BIGINT AS lost FROM {_NEAR_SQL}"
        for n in _IDS),
    "infer_types": _TYPES_SQL,
    "apply_types": (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, "
        "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
        "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem"),
    "null_tokens": (
        "SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'null ' "
        "WHEN 'error' THEN NULL ELSE event_type END AS event_type, props FROM events"),
    "map_types": (
        "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice, "
        "p_size > 25 AS big, p_retailprice::FLOAT::DOUBLE AS price FROM part"),
    "union_members": (
        "SELECT o_orderkey::VARCHAR AS o_orderkey, "
        "CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR END AS o_custkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_custkey::VARCHAR END AS note, "
        "CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate "
        "FROM orders"),
}
