"""Whole-column type inference over text columns, in one aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from drydock.config import NULL_TOKENS
from drydock.functions import numbers
from drydock.functions.text import null_tokens
from drydock.operators.columns import column


def blank_null_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Null tokens become null in every text column."""
    tokens = list(tokens)
    return df.select(*[
        (null_tokens(column(n), tokens) if t == "string" else column(n)).alias(n)
        for n, t in df.dtypes])


def infer_types(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS,
                string_columns: Iterable[str] = ()) -> DataFrame:
    """``(position, column, type)`` of text columns.

    Every value is reduced to one bit for its kind, and the bits are or-ed per
    column on the map side: a task shuffles one tiny row per column. Values are
    laid out under each other first, so that one short expression serves a
    table of any width instead of one copy of it per column.
    """
    protected = set(string_columns)
    columns = df.sparkSession.createDataFrame(
        [(i, n, n in protected) for i, n in enumerate(df.columns)],
        "position int, column string, protected boolean")
    values = df.select(F.posexplode(F.array(*[column(n) for n in df.columns])).alias("position", "value"))
    value = F.col("value")
    seen = values.select("position", null_tokens(value, tokens).alias("value")).select(
        "position", "value", numbers.pattern_class(value).alias("looks"))
    kinds = seen.groupBy("position").agg(
        F.count("*").alias("rows"), F.bit_or(numbers.kind(value, F.col("looks"))).alias("kinds"))
    found = numbers.type_of(F.col("kinds"), F.col("rows"))
    return columns.join(kinds, "position", "left").select(
        "position", "column",
        F.when(F.col("protected") | F.col("rows").isNull(), "string").otherwise(found).alias("type"))


def inferred(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS,
             string_columns: Iterable[str] = ()) -> dict[str, str]:
    """The inferred types as a mapping; one row per column reaches the driver."""
    return {r["column"]: r["type"] for r in infer_types(df, tokens, string_columns).collect()}


def apply_types(df: DataFrame, types: Mapping[str, str], tokens: Iterable[str] = NULL_TOKENS,
                proven: bool = False) -> DataFrame:
    """Turn text columns into the given types, null tokens into nulls.

    ``proven`` says that the types were inferred from this very table, so no
    value needs to be checked again.
    """
    tokens = list(tokens)
    return df.select(*[
        numbers.as_type(null_tokens(column(n), tokens), types.get(n, "string"), proven).alias(n)
        for n in df.columns])
