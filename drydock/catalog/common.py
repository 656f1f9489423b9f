"""Helpers shared by the registered queries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from drydock.config import WHITESPACE, Dataset, Registry

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DESCRIPTIONS = {
    "customer": "Customers", "documents": "Texts", "events": "User events",
    "lineitem": "Order lines", "orders": "Orders", "part": "Parts", "supplier": "Suppliers"}

TABLE_REGISTRY = Registry(tuple(
    Dataset(name, f"CSV_{name.upper()}", name.upper(), text) for name, text in DESCRIPTIONS.items()))

SQL_BLANKS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_WHITESPACE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
SQL_INTEGER = r"[ \t\n\x0B\f\r]*[+-]?[0-9]+[ \t\n\x0B\f\r]*"
SQL_NUMBER = (r"(?i)[ \t\n\x0B\f\r]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?"
              r"|inf|infinity)[ \t\n\x0B\f\r]*")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# -- archives made from tables ----------------------------------------------

ARCHIVE_SCHEMA = "path string, length bigint, content binary"


def csv_line(columns: Sequence[Column]) -> Column:
    """One quoted CSV record."""
    options = {"escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": ""}
    return F.to_csv(F.struct(*columns), options)


def csv_members(df: DataFrame, path: Column, member: Column, order: str,
                columns: Sequence[str]) -> DataFrame:
    """Rows as CSV members ``(path, member, text)`` with a header line."""
    header = ",".join(f'"{c}"' for c in columns)
    lines = df.select(path.alias("path"), member.alias("member"), F.col(order).alias("_order"),
                      csv_line([F.col(c).cast("string").alias(c) for c in columns]).alias("_line"))
    return lines.groupBy("path", "member").agg(
        F.expr("listagg(_line, '\\n') WITHIN GROUP (ORDER BY _order)").alias("_text")).select(
        "path", "member", F.concat(F.lit(header + "\n"), "_text").alias("text"))


def _zip(members: pa.Table) -> pa.Table:
    """The members of one archive, packed in the order of their names."""
    parts = sorted(zip(members["member"].to_pylist(), members["body"].to_pylist(), strict=True),
                   key=lambda part: [(x is not None, x) for x in part])
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, body in parts:
            archive.writestr(member, body)
    content = buffer.getvalue()
    return pa.table([members["path"][:1], pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())],
                    names=["path", "length", "content"])


def zip_members(members: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """CSV members as ZIP archives ``(path, length, content)``, one per path.

    The callers cut their tables into archives of a bounded number of rows; a
    worker holds one archive's members at a time, however many its task has.
    """
    return (members.select("path", "member", F.encode("text", charset).alias("body"))
            .groupBy("path").applyInArrow(_zip, ARCHIVE_SCHEMA))


def block_of(key: str, rows: int) -> Column:
    return F.floor(F.col(key) / F.lit(rows)).cast("bigint")


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = pafs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                with system.open_output_stream(f"{inner}/{path.rsplit('/', 1)[-1]}") as out:
                    out.write(content.as_buffer())
            yield batch.select(["path"])
    return write


def write_archives(archives: DataFrame, folder: str) -> None:
    """Put archives into a folder, each by the task which holds it."""
    uri = folder if "://" in folder else f"file://{folder}"
    archives.select("path", "content").mapInArrow(_writer(uri), "path string").count()


def order_archives(spark: SparkSession, sf_dir: str, rows: int = 5000) -> DataFrame:
    """Orders as archives of two members with different columns, by status."""
    orders = table(spark, sf_dir, "orders")
    path = F.concat(F.lit("/landing/CSV_ORDERS_"), block_of("o_orderkey", rows).cast("string"), F.lit(".ZIP"))
    filled = csv_members(orders.filter("o_orderstatus = 'F'"), path, F.lit("filled.csv"), "o_orderkey",
                         ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                          "o_orderpriority"])
    other = csv_members(orders.filter("o_orderstatus <> 'F'"), path, F.lit("OTHER.CSV"), "o_orderkey",
                        ["o_totalprice", "o_orderdate", "o_orderstatus", "o_custkey", "o_orderkey"])
    notes = filled.select("path", F.lit("readme.txt").alias("member"), F.lit("not data").alias("text"))
    return zip_members(filled.unionByName(other).unionByName(notes))


def document_archives(spark: SparkSession, sf_dir: str, rows: int = 50) -> DataFrame:
    """Documents as archives: quoted line breaks, doubled quotes, many scripts."""
    documents = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/landing/csv_documents_"), block_of("doc_id", rows).cast("string"), F.lit(".zip"))
    member = F.concat(F.col("lang"), F.lit(".csv"))
    return zip_members(csv_members(documents, path, member, "doc_id",
                                   ["doc_id", "text", "lang", "source", "n_chars"]))
