"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Column, last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if last else F.min_by
    row = choose(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def keep_first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """First row of each key. Combined on the map side: one row per key and
    task is shuffled, so a hot key costs no more than any other."""
    return _pick(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Last row of each key (later rows overwrite earlier ones)."""
    return _pick(df, keys, order, last=True)
