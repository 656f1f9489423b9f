"""Members of many archives put together by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from drydock.operators.columns import column
from drydock.sources.archives import stored_layouts


def union_members(*tables: DataFrame) -> DataFrame:
    """Bag union by name on text columns; a column missing somewhere is null there.

    Everything is text until all members are together, so members which
    disagree about a column's type cannot break the union.
    """
    texts = [t.select(*[column(n).cast("string").alias(n) for n in t.columns]) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)


def assemble_table(rows: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Expanded records as one table of text columns, united by column name.

    ``rows`` comes from ``expand_archives``; ``headers`` may be a cheaper source
    of the header records than ``rows``. Columns stand in the order in which the
    headers, sorted by their layout number, first name them. Only column names
    reach the driver. Each record is joined to the places of its layout; how,
    Spark decides by their size.
    """
    found = stored_layouts(rows if headers is None else headers)
    named = (found.select("layout", F.posexplode("names").alias("place", "name"))
             .groupBy("name").agg(F.min(F.struct("layout", "place")).alias("first"), F.count("*").alias("n")).collect())
    data = rows.filter((F.col("row_no") > 0) & F.col("error").isNull())
    if not named:
        return data.select()
    names = [r["name"] for r in sorted(named, key=lambda r: tuple(r["first"]))]
    if len({r["first"]["layout"] for r in named}) == 1 and all(r["n"] == 1 for r in named):  # one header in all
        return data.select(*[F.col("fields")[i].alias(n) for i, n in enumerate(names)])
    places = found.select("layout", F.array(*[
        F.nullif(F.array_position("names", n).cast("int"), F.lit(0)) for n in names]).alias("places"))
    return data.join(places, "layout").select(*[
        F.try_element_at("fields", F.col("places")[i]).alias(n) for i, n in enumerate(names)])
