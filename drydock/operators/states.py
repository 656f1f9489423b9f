"""What is known of a dataset's columns, as states that are joined and never computed again.

A state says of each column in which layouts it stands, which kinds of values
it holds (one bit each) and between which dates its values lie. Places join by
least, kinds by bit-or, dates by least and greatest: however records are
divided into deliveries, and in whatever order these are joined, the outcome is
that of all records together.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from drydock.config import NULL_TOKENS, WHITESPACE, ColumnRoles, DateRules
from drydock.functions import numbers
from drydock.functions.dates import to_date_time
from drydock.functions.text import null_tokens
from drydock.session import scratch

STATE_SCHEMA = ("dataset string, column string, layout bigint, place int, rows bigint, kinds int, "
                "text_low timestamp_ntz, text_high timestamp_ntz, whole_low timestamp_ntz, whole_high timestamp_ntz")

#: Beside the bits of kinds: a whole number which as a floating-point one would keep its sign.
MINUS_ZERO = 64
_MINUS_ZERO = r"\A\s*-0+\s*\z"


def column_states(rows: DataFrame, roles: ColumnRoles = ColumnRoles(), tokens: Iterable[str] = NULL_TOKENS,
                  rules: DateRules = DateRules()) -> DataFrame:
    """``STATE_SCHEMA`` of expanded records ``(dataset, layout, row_no, fields, error)`` of any datasets.

    One aggregation over the cells for all datasets and columns: cells are laid
    out under each other, and a task sends one small row per column it met.
    Dates are looked for in the date columns only, as texts and as whole
    numbers, since the column's type is not settled yet.
    """
    spark, stored = rows.sparkSession, scratch(rows.sparkSession, "headers")
    # Headers are stored first: their size is known then, so that a few of them do not make Spark deal records by layout.
    (rows.filter((F.col("row_no") == 0) & F.col("error").isNull() & F.col("layout").isNotNull())
     .groupBy("dataset", "layout").agg(F.min("fields").alias("names")).write.parquet(stored))
    found = spark.read.schema(rows.select("dataset", "layout", F.col("fields").alias("names")).schema).parquet(stored)
    names = found.groupBy("layout").agg(F.min("names").alias("names"))
    clean = F.upper(F.btrim(F.col("name"), F.lit(WHITESPACE)))
    dated = F.exists("names", lambda name: F.upper(F.btrim(name, F.lit(WHITESPACE))).isin(list(roles.date_columns)))
    where = names.select("layout", F.when(dated, F.col("names")).alias("names"))
    data = rows.filter((F.col("row_no") > 0) & F.col("error").isNull()).select("dataset", "layout", "fields")
    cells = (data.join(where, "layout").select("dataset", "layout", "names", F.posexplode("fields").alias("place", "value"))
             .select("dataset", "layout", "place", F.get("names", F.col("place")).alias("name"),
                     null_tokens(F.col("value"), tokens).alias("value")))
    value, is_date = F.col("value"), clean.isin(list(roles.date_columns))
    # a date cell stands twice, as its text and as its whole number, so that one parser serves both
    whole = F.when(is_date, numbers.to_double(value))
    whole = F.when(whole == F.floor(whole), whole).try_cast("decimal(20,0)").cast("string")
    forms = F.array_compact(F.array(F.struct(F.lit(True).alias("text"), value.alias("value")),
                                    F.when(whole.isNotNull(), F.struct(F.lit(False).alias("text"), whole.alias("value")))))
    seen = (cells.select("dataset", "layout", "place", is_date.alias("dated"), F.inline(forms))
            .select("dataset", "layout", "place", "text", "value", numbers.pattern_class(value).alias("looks"),
                    F.when(F.col("dated"), to_date_time(value, T.StringType(), rules)).alias("date")))
    kinds = numbers.kind(value, F.col("looks")).bitwiseOR(F.when(value.rlike(_MINUS_ZERO), MINUS_ZERO).otherwise(0))
    met = seen.groupBy("dataset", "layout", "place").agg(
        F.count_if("text").alias("rows"), F.bit_or(F.when(F.col("text"), kinds)).cast("int").alias("kinds"),
        *[end(F.when(F.col("text") == form, F.col("date"))).alias(f"{name}_{side}")
          for name, form in (("text", True), ("whole", False)) for side, end in (("low", F.min), ("high", F.max))])
    headers = (found.select("dataset", "layout").join(names, "layout")
               .select("dataset", "layout", F.posexplode("names").alias("place", "column")))
    return headers.join(met, ["dataset", "layout", "place"], "left").select(
        "dataset", "column", "layout", "place", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("kinds", F.lit(0)).alias("kinds"), "text_low", "text_high", "whole_low", "whole_high")


def joined_states(states: DataFrame) -> DataFrame:
    """``dataset, column, first, kinds, rows, type, low, high`` of each column over all states.

    ``rows`` is the dataset's number of records, ``first`` orders the columns as a
    table of all records would, and ``type`` is the type of all values. A column
    of texts has the dates of its texts, one of numbers those of its whole ones.
    """
    totals = states.groupBy(F.col("dataset").alias("of")).agg(
        F.sum(F.when(F.col("place") == 0, F.col("rows")).otherwise(0)).alias("rows"))
    columns = states.groupBy("dataset", "column").agg(
        F.min(F.struct("layout", "place")).alias("first"), F.bit_or("kinds").alias("kinds"),
        *[F.min(c).alias(c) for c in ("text_low", "whole_low")], *[F.max(c).alias(c) for c in ("text_high", "whole_high")])
    kind = numbers.type_of(F.col("kinds"), F.col("rows"))
    known = columns.join(totals, columns["dataset"] == totals["of"]).withColumn("type", kind)

    def of(end: str):
        return (F.when(F.col("type") == "string", F.col(f"text_{end}"))
                .when(F.col("type") != "boolean", F.col(f"whole_{end}")).alias(end))

    return known.select("dataset", "column", "first", "kinds", "rows", "type", of("low"), of("high"))
