"""Column names and order."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from drydock.config import WHITESPACE, ColumnRoles
from drydock.functions import numbers


def normalized_names(names: Iterable[str], strip_prefix: str | None = None) -> list[str]:
    """Upper-case, stripped names; clashing ones are refused by name."""
    clean = [n.upper().strip(WHITESPACE) for n in names]
    if strip_prefix:
        clean = [re.sub(f"^(?:{strip_prefix})", "", n) for n in clean]
    clashes = sorted(n for n, k in Counter(clean).items() if k > 1)
    if clashes:
        raise ValueError(f"columns share a name once upper-cased: {', '.join(clashes)}")
    return clean


def normalize_columns(df: DataFrame, strip_prefix: str | None = None) -> DataFrame:
    return df.toDF(*normalized_names(df.columns, strip_prefix))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str):
    """A column by its exact name, whatever dots or blanks it holds."""
    return F.col(_quoted(name))


def _coerced(df: DataFrame, name: str, mode: str):
    source, data_type = column(name), df.schema[name].dataType
    if isinstance(data_type, T.BooleanType):
        return source
    if isinstance(data_type, T.StringType):
        value = column(_parsed(name))
        return numbers.to_bigint(source, value) if mode == "bigint" else value
    if mode == "double":
        return source.try_cast("double")
    if isinstance(data_type, T.IntegralType):
        return source.cast("bigint")
    if isinstance(data_type, (T.FractionalType,)):
        return F.when(source == F.floor(source), source.try_cast("bigint"))
    return numbers.to_bigint(source.try_cast("string"))


def _parsed(name: str) -> str:
    return f"_number of {name}"


def _with_parsed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add the numbers of text columns, each parsed once for all later uses."""
    texts = [n for n in names if isinstance(df.schema[n].dataType, T.StringType)]
    return df.select("*", *[numbers.to_double(column(n)).alias(_parsed(n)) for n in texts])


def coerce_ids(df: DataFrame, ids: Iterable[str], mode: str = "bigint") -> DataFrame:
    """Make the identifier columns present numeric; what cannot be is null.

    ``mode="bigint"`` keeps whole numbers exact. ``mode="double"`` gives
    floating-point columns, fractions and infinities included.
    """
    wanted = set(ids).intersection(df.columns)
    return _with_parsed(df, wanted).select(*[
        (_coerced(df, n, mode) if n in wanted else column(n)).alias(n, metadata=df.schema[n].metadata)
        for n in df.columns])


def coercion_report(df: DataFrame, ids: Iterable[str], mode: str = "bigint") -> DataFrame:
    """Per identifier column: values present, and values lost by coercion."""
    present = [n for n in ids if n in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, present bigint, lost bigint")
    counts = _with_parsed(df, present).agg(*[
        F.struct(
            F.lit(n).alias("column"),
            F.count(column(n)).alias("present"),
            F.count_if(column(n).isNotNull() & _coerced(df, n, mode).isNull()).alias("lost"),
        ).alias(f"c{i}") for i, n in enumerate(present)])
    return counts.select(F.inline(F.array(*counts.columns)))


def counted_losses(df: DataFrame, roles: ColumnRoles = ColumnRoles(), mode: str = "bigint"
                   ) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """A table with its identifiers coerced from text and its rows counted on their way, and what to call for
    the counts when it has been written.

    The counts are ``rows`` and, by name, the values of each identifier that
    coercion has lost. They come from the job that writes the table: nothing is
    read or parsed a second time.
    """
    ids = [n for n in df.columns if n.upper().strip(WHITESPACE) in roles.id_columns
           and isinstance(df.schema[n].dataType, T.StringType)]
    made = [f"_made of {n}" for n in ids]
    coerced = _with_parsed(df, ids).select(*[column(n) for n in df.columns],
                                           *[_coerced(df, n, mode).alias(m) for n, m in zip(ids, made, strict=True)])
    losses = [F.count_if(column(n).isNotNull() & column(m).isNull()).alias(f"lost_{i}")
              for i, (n, m) in enumerate(zip(ids, made, strict=True))]
    seen = Observation()
    counted = coerced.observe(seen, F.count(F.lit(1)).alias("rows"), *losses)
    new = dict(zip(ids, made, strict=True))

    def told() -> dict[str, int]:
        found = seen.get
        return {"rows": found.get("rows", 0)} | {
            n.upper().strip(WHITESPACE): found.get(f"lost_{i}", 0) for i, n in enumerate(ids)}

    return counted.select(*[column(new.get(n, n)).alias(n, metadata=df.schema[n].metadata) for n in df.columns]), told


def ordered_names(names: Iterable[str], roles: ColumnRoles = ColumnRoles()) -> list[str]:
    """Identifiers, then dates, both in role order; the rest by code point."""
    present = list(names)
    leading = [n for n in dict.fromkeys(roles.id_columns + roles.date_columns) if n in present]
    return leading + sorted(n for n in present if n not in leading)


def order_columns(df: DataFrame, roles: ColumnRoles = ColumnRoles()) -> DataFrame:
    return df.select(*[column(n) for n in ordered_names(df.columns, roles)])


def standardize(df: DataFrame, roles: ColumnRoles = ColumnRoles(), mode: str = "bigint",
                strip_prefix: str | None = None) -> DataFrame:
    """Normalised names, numeric identifiers, settled column order."""
    named = normalize_columns(df, strip_prefix)
    return order_columns(coerce_ids(named, roles.id_columns, mode), roles)


def map_types(df: DataFrame) -> DataFrame:
    """Cast every column to its storage type; unknown types become text."""
    def storage(data_type: T.DataType) -> str:
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "timestamp_ntz"
        if isinstance(data_type, T.IntegralType):
            return "bigint"
        if isinstance(data_type, T.DecimalType) and data_type.scale == 0:
            return data_type.simpleString()
        if isinstance(data_type, T.FractionalType):
            return "double"
        if isinstance(data_type, T.BooleanType):
            return "boolean"
        return "string"

    return df.select(*[
        column(f.name).cast(storage(f.dataType)).alias(f.name, metadata=f.metadata)
        for f in df.schema.fields])


def type_names(df: DataFrame) -> Mapping[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}
