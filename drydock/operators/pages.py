"""Page texts put together in page order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drydock.operators.sequences import Running, scan, with_blocks

PAGES_PER_BLOCK = 4096


def assemble_pages(pages: DataFrame, doc: str, order: str, text: str, sep: str = "\n\n",
                   part_chars: int | None = None) -> DataFrame:
    """Texts ``(doc, part_no, text, n_chars)`` of all non-empty pages in order.

    A document is one row. A caller whose documents are too long for that names
    ``part_chars``, and gets those beyond it in several numbered parts, cut
    between pages: then no document is held whole in one task, and joining its
    parts with ``sep`` gives its full text. ``n_chars`` is the length of the
    whole document either way.
    """
    filled = pages.select(doc, order, text).filter(F.length(text) > 0)
    size = F.length(text).cast("bigint")
    joined = F.expr(
        f"listagg(`{text}`, {_literal(sep)}) WITHIN GROUP (ORDER BY `{order}`)")
    if part_chars is None:
        return filled.groupBy(doc).agg(joined.alias("text")).select(
            doc, F.lit(0).alias("part_no"), "text", F.length("text").cast("bigint").alias("n_chars"))
    offsets = scan(with_blocks(filled, [doc], order, "_block", PAGES_PER_BLOCK), [doc], order,
                   {"_before": Running("sum", size, inclusive=False)}, "_block")
    part = F.floor(F.coalesce(F.col("_before"), F.lit(0)) / F.lit(part_chars)).cast("int")
    whole = filled.groupBy(F.struct(doc).alias("_doc")).agg(
        (F.sum(size) + F.lit(len(sep)) * (F.count("*") - 1)).alias("n_chars"))
    parts = offsets.withColumn("part_no", part).groupBy(doc, "part_no").agg(joined.alias("text"))
    return (parts.withColumn("_doc", F.struct(doc)).join(whole, "_doc")
            .select(doc, "part_no", "text", "n_chars"))


def _literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"'{escaped}'"
