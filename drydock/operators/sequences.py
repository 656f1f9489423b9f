"""Ordered-sequence logic: running sums, running maxima, forward fill.

A sequence may hold a third of all rows, so no window runs over a whole one.
Sequences are cut into blocks along their order. Windows run inside a block;
what a block hands to the next ones is one small row per block, and those rows
alone are scanned per sequence and joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from drydock.functions.text import strip
from drydock.session import scratch

BLOCK_ROWS = 100_000
#: Rows drawn from a long sequence, most splitters without further cuts, and the range of the hash that draws.
SAMPLE_ROWS, SPLITTERS, _DRAWS = 4096, 64, 1 << 40


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``sum`` or ``max`` of a value, or its ``last``
    non-null one; ``inclusive`` says whether the current row counts."""

    kind: str
    value: Column
    inclusive: bool = True


def _over(kind: str, value: Column, window) -> Column:
    if kind == "sum":
        return F.sum(value).over(window)
    if kind == "max":
        return F.max(value).over(window)
    return F.last(value, ignorenulls=True).over(window)


def with_sequence_key(df: DataFrame, keys: Sequence[str], name: str = "_key") -> DataFrame:
    """Add the keys as one struct. Unlike its parts it is never null, so
    sequences with a null key join like any other."""
    return df.withColumn(name, F.struct(*[F.col(f"`{k}`") for k in keys]))


def with_blocks(df: DataFrame, keys: Sequence[str], order: str, name: str = "_block",
                rows: int | None = None) -> DataFrame:
    """Add a block number which cuts each sequence into about one piece per ``rows`` rows.

    Sequences are counted first, by a job of its own; one of up to ``rows`` rows
    stays whole, and where all do, rows are neither joined nor moved. A longer
    one is cut at splitters: quantiles of about ``SAMPLE_ROWS`` of its rows. They
    are written to the shared folder, so every evaluation sees the same ones; a
    join adds them, without a shuffle of the rows while they are small enough for
    Spark to broadcast. Up to ``SPLITTERS`` pieces lie between splitters alone,
    however unevenly the order is filled; of a sequence of more pieces, each span
    between two splitters is cut again into equal widths, so where many rows
    crowd inside a span a piece may hold all of it, which costs a sort that
    spills and no memory. Splitters stand close together near both ends, so an
    outlier shares its span with few rows. Rows of equal order stay together;
    those without an order are block -1.
    """
    rows = BLOCK_ROWS if rows is None else rows
    key, at = F.struct(*[F.col(f"`{k}`") for k in keys]), F.col(order).cast("decimal(38,6)")
    whole = F.when(at.isNull(), -1).otherwise(0).cast("bigint")
    long = _kept(df.groupBy(key.alias("_of")).agg(
        F.min(at).alias("_least"), F.max(at).alias("_most"), F.count("*").alias("_rows"))
        .filter(F.col("_rows") > rows), "sequences")
    if long.isEmpty():
        return df.withColumn(name, whole)
    pieces = F.ceil(F.col("_rows") / F.lit(rows))
    drawn = (df.select(key.alias("_of"), at.alias("_at")).filter(F.col("_at").isNotNull())
             .withColumn("_draw", F.pmod(F.xxhash64("_of", "_at"), F.lit(_DRAWS)))
             .filter(F.col("_draw") < int(_DRAWS * min(1.0, SAMPLE_ROWS / rows)))
             .join(long.select("_of", "_rows"), "_of").filter(F.col("_draw") < F.lit(_DRAWS * SAMPLE_ROWS) / F.col("_rows"))
             .groupBy("_of").agg(F.sort_array(F.collect_list("_at")).alias("_drawn")))
    cuts = long.join(drawn, "_of", "left").select(
        "_of", _splitters(F.coalesce("_drawn", F.array().cast("array<decimal(38,6)>")), pieces).alias("_inner"),
        "_least", "_most", F.ceil(pieces / F.lit(SPLITTERS)).alias("_parts"))
    cuts = _kept(cuts.select("_of", "_inner", "_parts",
                             F.concat(F.array("_least"), "_inner", F.array("_most")).alias("_edges")), "splitters")
    span = F.size(F.filter("_inner", lambda edge: edge <= at))  # splitters at or before the row
    low, high = F.get("_edges", F.col("_span")), F.get("_edges", F.col("_span") + 1)
    width = F.greatest((high - low).cast("double"), F.lit(1e-6)) / F.col("_parts")
    part = F.least(F.floor((at - low).cast("double") / width), F.col("_parts") - 1)
    block = F.col("_span") * F.col("_parts") + F.when(F.col("_parts") > 1, part).otherwise(0)
    return (df.withColumn("_of", key).join(cuts, "_of", "left")
            .withColumn("_span", F.when(F.col("_inner").isNotNull() & at.isNotNull(), span))
            .select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(block.cast("bigint"), whole).alias(name)))


def _kept(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _splitters(drawn: Column, pieces: Column) -> Column:
    """Values of a sorted sample which part it evenly, and in many pieces also near its ends."""
    n, parts = F.size(drawn), F.least(pieces, F.lit(SPLITTERS)).cast("int")
    even = F.transform(F.sequence(F.lit(1), parts), lambda k: F.floor(k * n / parts))
    near = F.when(pieces > SPLITTERS, F.array(*[F.lit(k) for k in (1, 4, 16)], *[n - k for k in (1, 4, 16)]))
    places = F.concat(even, F.coalesce(near, F.array().cast("array<int>")))
    chosen = F.transform(F.filter(places, lambda k: (k > 0) & (k < n)), lambda k: F.get(drawn, k.cast("int")))
    return F.array_sort(F.array_distinct(chosen))


def scan(df: DataFrame, keys: Sequence[str], order: str, outputs: Mapping[str, Running],
         block: str | None = None) -> DataFrame:
    """Add running aggregates along ``order`` within each sequence of ``keys``.

    ``block`` names a column which cuts a sequence into pieces of bounded size
    without breaking its order; by default pieces are made by ``with_blocks``. A key made by ``with_sequence_key`` is used as it is,
    so that scans which follow one another need no further shuffle.
    """
    if block is None:
        return scan(with_blocks(df, keys, order), keys, order, outputs, "_block").drop("_block")
    if not (len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.StructType)):
        return scan(with_sequence_key(df, keys), ["_key"], order, outputs, block).drop("_key")
    key = keys[0]
    within = Window.partitionBy(key, block).orderBy(order)
    frames = {True: within.rowsBetween(Window.unboundedPreceding, 0),
              False: within.rowsBetween(Window.unboundedPreceding, -1)}
    before = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)

    def whole(run: Running) -> Column:
        if run.kind == "sum":
            return F.sum(run.value)
        if run.kind == "max":
            return F.max(run.value)
        return F.max_by(run.value, F.when(run.value.isNotNull(), F.col(order)))

    totals = df.groupBy(key, block).agg(*[whole(r).alias(n) for n, r in outputs.items()])
    carried = totals.select(
        key, block, *[_over(r.kind, F.col(n), before).alias(f"_in_{n}") for n, r in outputs.items()])
    known = F.lit(False)
    for n in outputs:
        known = known | F.col(f"_in_{n}").isNotNull()
    local = df.select("*", *[_over(r.kind, r.value, frames[r.inclusive]).alias(f"_at_{n}")
                             for n, r in outputs.items()])
    joined = local.join(carried.filter(known), [key, block], "left")

    def settled(name: str, run: Running) -> Column:
        here, carry = F.col(f"_at_{name}"), F.col(f"_in_{name}")
        if run.kind == "sum":
            return F.when(here.isNotNull() | carry.isNotNull(),
                          F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)))
        if run.kind == "max":
            return F.greatest(here, carry)
        return F.coalesce(here, carry)

    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[settled(n, r).alias(n) for n, r in outputs.items()])


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
                 start: str | None = None, block: str | None = None) -> DataFrame:
    """Carry the latest non-null value forward; ``start`` stands before the first."""
    filled = scan(df, keys, order, {name: Running("last", value)}, block)
    return filled if start is None else filled.withColumn(name, F.coalesce(name, F.lit(start)))


def segment(df: DataFrame, keys: Sequence[str], order: str, is_start: Column,
            name: str = "segment", block: str | None = None) -> DataFrame:
    """Number the segments which rows with ``is_start`` open (0 before the first)."""
    opened = F.when(is_start, 1).otherwise(0).cast("bigint")
    return scan(df, keys, order, {name: Running("sum", opened)}, block)


def explode_lines(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Stripped lines of a text with their number, starting at 0."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line")).withColumn(
        "line", strip(F.col("line")))
