"""Descriptions carried by the columns of a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from drydock.config import WHITESPACE
from drydock.operators.columns import column


def descriptions_for(df: DataFrame, dictionary: DataFrame, table: str) -> dict[str, str]:
    """Texts for the columns of one table.

    Only the entries of this table naming one of its columns reach the driver,
    so the result is no larger than the schema it describes.
    """
    wanted = {n.upper().strip(WHITESPACE): n for n in df.columns}
    found = dictionary.filter((F.col("table") == table) & F.col("variable").isin(list(wanted)))
    return {wanted[r["variable"]]: r["description"] for r in found.select("variable", "description").collect()}


def attach_descriptions(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Add ``description`` (and ``comment``, shown by DESCRIBE) to the columns
    with a text. A later cast loses them, so this comes last before writing."""
    def tagged(name: str):
        text = texts.get(name)
        if not text:
            return column(name)
        metadata = {**df.schema[name].metadata, "description": text, "comment": text}
        return column(name).alias(name, metadata=metadata)

    return df.select(*[tagged(n) for n in df.columns])
