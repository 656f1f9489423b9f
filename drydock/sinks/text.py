"""CSV and plain-text sinks. Each writes a folder of part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drydock.operators.dictionary import DICTIONARY_COLUMNS
from drydock.operators.profile import export_profile


def _csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", "true").option("escape", '"')
     .option("emptyValue", "").option("lineSep", "\n").csv(path))


def write_dictionary_csv(definitions: DataFrame, path: str) -> None:
    """Definitions in the fixed column order; grid definitions lack full texts."""
    names = DICTIONARY_COLUMNS if "full_description" in definitions.columns else (
        "variable", "description", "table", "data_type")
    _csv(definitions.select(*names), path)


def export_profile_csv(profiles: DataFrame, path: str) -> None:
    _csv(export_profile(profiles), path)


def write_text(parts: DataFrame, path: str, doc: str, text: str = "text", order: str = "part_no") -> None:
    """Raw texts, documents in order and the parts of one in order.

    Range partitioning keeps the order across the part files without putting
    everything into one.
    """
    (parts.repartitionByRange(doc, order).sortWithinPartitions(doc, order)
     .select(F.col(text).alias("value")).write.mode("overwrite").text(path))
