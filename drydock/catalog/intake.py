"""Registered queries: archives, decoding, classification, ingest, landing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.catalog.common import (
    ARCHIVE_SCHEMA, TABLE_REGISTRY, block_of, csv_members, document_archives, order_archives, table, write_archives,
    zip_members)
from drydock.config import ColumnRoles, Dataset, FILE_CLASSES, Provenance, Registry
from drydock.functions.text import decode_text, file_name, is_csv_member, stem
from drydock.operators.landing import (
    all_succeeded, deletion_preview, failures, ingest_report, inventory_totals, landed_archives, reconcile,
    select_datasets, select_keys, skip_or_force, unknown_keys)
from drydock.operators.lookups import classify
from drydock.plans.ingest import archive_outcomes, ingest, plan_work, stage_records, typed_table
from drydock.session import remove_path, scratch
from drydock.sinks.parquet import publish
from drydock.sources.archives import errors_by_archive, expand_archives, list_members
from drydock.sources.listing import (
    dataset_catalog, list_archives, list_files, match_files, published_names, scan_published, union_distinct_paths)
from drydock.streaming.incremental import incremental_ingest, landed, landed_profiles

ORDER_ROLES = ColumnRoles(("O_ORDERKEY", "O_CUSTKEY"), ("O_ORDERDATE",))


# -- decoding ------------------------------------------------------------------


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded one way or the other, then read back without being told which.

    A text goes out as ISO-8859-1 where that can hold it and is not by chance
    valid UTF-8; every other text goes out as UTF-8, with a byte-order mark
    where its language is English.
    """
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("part"),
        "text", (F.col("lang") == "en").alias("mark"))
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("kind"), F.col("conv_id").alias("id"), F.col("turn").alias("part"),
        "text", F.lit(False).alias("mark"))
    texts = documents.unionByName(turns)
    fits = ~F.col("text").rlike(r"[^\x{00}-\x{ff}]")
    narrow = F.encode(F.regexp_replace("text", r"[^\x{00}-\x{ff}]", "?"), "ISO-8859-1")
    marked = F.when(F.col("mark"), F.concat(F.lit("﻿"), "text")).otherwise(F.col("text"))
    content = F.when(fits & ~F.is_valid_utf8(narrow.cast("string")), narrow).otherwise(
        F.encode(marked, "UTF-8"))
    return texts.select("kind", "id", "part", decode_text(content).alias("text"))


# -- classification -------------------------------------------------------------

# SRC1 is also part of SRC10 to SRC19: the first pattern in order wins.
SOURCE_REGISTRY = Registry((
    Dataset("first", "SRC1", "ONES", "Sources with a leading one"),
    Dataset("tenth", "SRC10", "TENS", "Source ten"),
    Dataset("second", "SRC2", "TWOS", "Source two"),
    Dataset("third", "SRC3", "THREES", "Source three"),
))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/landing/SRC3.d/"), F.col("lang"), F.lit("_"), F.col("source"), F.lit("."),
                    F.col("doc_id").cast("string"), F.lit(".zip"))
    return classify(documents.select("doc_id", path.alias("path")), SOURCE_REGISTRY)


#: Ten thousand patterns of four digits to the base of 16, scattered, so that many occur in a stem and the first wins.
LARGE_REGISTRY = Registry(tuple(
    Dataset(f"d{i}", f"{i * 40503 % 65536:04X}", f"T{i % 7}", f"Set {i}") for i in range(10_000)))


def classified_by_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/landing/"), F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(".zip"))
    return classify(table(spark, sf_dir, "documents").select("doc_id", path.alias("path")), LARGE_REGISTRY)


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names and stems of page addresses."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", file_name(url).alias("name"), stem(url).alias("stem"))


# -- archives ------------------------------------------------------------------


def orders_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand_archives(order_archives(spark, sf_dir))
    return typed_table(stage_records(records, scratch(spark, "records")), ORDER_ROLES)


def documents_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through CSV and ZIP and back, line breaks and quotes included."""
    records = stage_records(expand_archives(document_archives(spark, sf_dir)), scratch(spark, "records"))
    return typed_table(records, ColumnRoles(("DOC_ID",), ()), string_columns=("text",))


def documents_from_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as members of many blocks each, which are parsed side by side."""
    documents, landing = table(spark, sf_dir, "documents"), scratch(spark, "landing")
    path = F.concat(F.lit("/landing/csv_documents_"), block_of("doc_id", 500).cast("string"), F.lit(".zip"))
    write_archives(zip_members(csv_members(documents, path, F.lit("all.csv"), "doc_id",
                                           ["doc_id", "text", "lang", "source", "n_chars"])), landing)
    rows = expand_archives(list_archives(spark, landing), split_above=0, block_bytes=65_536)
    return typed_table(stage_records(rows, scratch(spark, "records")), ColumnRoles(("DOC_ID",), ()), string_columns=("text",))


def headers_of_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers alone, told without reading the records."""
    headers = expand_archives(order_archives(spark, sf_dir), header_only=True)
    return headers.select(file_name(F.col("path")).alias("file"), "member", F.array_join("fields", ",").alias("columns"))


def latin1_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts which ISO-8859-1 can hold in archives of that charset, all others in
    UTF-8 ones: members with an accent fail as UTF-8 and are read again as a whole."""
    fits = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x{00}-\x{ff}]")
    documents = table(spark, sf_dir, "documents").withColumn("narrow", fits)

    def archives(narrow: bool, charset: str) -> DataFrame:
        path = F.concat(F.lit(f"/landing/csv_{charset}_"), block_of("doc_id", 50).cast("string"), F.lit(".zip"))
        own = documents.filter(F.col("narrow") == narrow)
        return zip_members(csv_members(own, path, F.lit("all.csv"), "doc_id", ["doc_id", "text"]), charset)

    rows = expand_archives(archives(True, "ISO-8859-1").unionByName(archives(False, "UTF-8"))).filter("row_no > 0")
    return rows.select(F.col("fields")[0].cast("bigint").alias("doc_id"), F.col("fields")[1].alias("text"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV members of the archives of orders; other members are left out."""
    found = list_members(order_archives(spark, sf_dir))
    return found.filter(is_csv_member(F.col("member"))).select(file_name(F.col("path")).alias("file"), "member")


def _mixed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound archives (orders), broken ones (web pages), ones of an unknown
    dataset (customers by nation), ones without CSV (labels) and ones with rows
    too long for their header (suppliers by nation)."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/landing/csv_documents_"), F.col("page_id").cast("string"), F.lit(".zip")).alias("path"),
        F.length(F.encode("html", "UTF-8")).cast("bigint").alias("length"),
        F.encode("html", "UTF-8").alias("content"))

    def by(df, key, name, suffix, columns):
        path = F.concat(F.lit(f"/landing/{name}_"), F.col(key).cast("string"), F.lit(".ZIP"))
        return zip_members(csv_members(df, path, F.lit(f"data{suffix}"), columns[0], columns))

    customers = by(table(spark, sf_dir, "customer").withColumn("block", block_of("c_custkey", 500)),
                   "block", "mystery", ".csv", ["c_custkey", "c_name"])
    labels = by(table(spark, sf_dir, "labels").withColumn("block", block_of("doc_id", 500)),
                "block", "csv_part", ".txt", ["doc_id", "quality"])
    supplier = table(spark, sf_dir, "supplier").withColumn("block", block_of("s_suppkey", 20))
    path = F.concat(F.lit("/landing/csv_supplier_"), F.col("block").cast("string"), F.lit(".ZIP"))
    suppliers = zip_members(
        supplier.groupBy(path.alias("path")).agg(F.concat(
            F.lit("s_suppkey,s_name\n"),
            F.expr("listagg(concat_ws(',', s_suppkey, s_name, 'extra'), '\\n') WITHIN GROUP (ORDER BY s_suppkey)")
        ).alias("text")).select("path", F.lit("data.csv").alias("member"), "text"))
    return reduce(DataFrame.unionByName,
                  [order_archives(spark, sf_dir), pages, customers, labels, suppliers])


def _staged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed archives, built once and read from there."""
    return _staged(spark, _mixed_archives(spark, sf_dir))


def _staged(spark: SparkSession, archives: DataFrame) -> DataFrame:
    place = scratch(spark, "archives")
    archives.write.parquet(place)
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(place)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = _staged_archives(spark, sf_dir)
    published = spark.createDataFrame([("lineitem",)], "dataset string")
    work, settled = plan_work(archives, published, TABLE_REGISTRY, collisions="union")
    return settled.unionByName(archive_outcomes(expand_archives(archives), work))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_report(_outcomes(spark, sf_dir))


def report_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(_outcomes(spark, sf_dir)).select(file_name(F.col("path")).alias("file"), "name")


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_succeeded(_outcomes(spark, sf_dir))


def archive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults per broken archive."""
    broken = errors_by_archive(expand_archives(_mixed_archives(spark, sf_dir)))
    return broken.select(file_name(F.col("path")).alias("file"), "faults")


def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per dataset is taken, the first by path; others are settled."""
    documents = table(spark, sf_dir, "documents")
    files = documents.select(F.format_string("/landing/%s_%08d.zip", "source", "doc_id").alias("path"))
    published = documents.limit(0).select(F.lit("").alias("dataset")).unionByName(
        documents.filter("source = 'src2'").select(F.lit("second").alias("dataset")).distinct())
    work, settled = plan_work(files, published, SOURCE_REGISTRY)
    return settled.select("path", "status", "dataset").unionByName(
        work.select("path", F.lit("work").alias("status"), "dataset"))


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: archives in a folder to a published table, then read back."""
    landing, out = scratch(spark, "landing"), scratch(spark, "out")
    write_archives(order_archives(spark, sf_dir), landing)
    ingest(spark, landing, out, TABLE_REGISTRY, roles=ORDER_ROLES, collisions="union",
           provenance=Provenance(source="orders")).count()
    return spark.read.parquet(f"{out}/orders.parquet")


def ingested_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one folder, archives being added between them: outcomes of both."""
    base = scratch(spark, "stream")
    landing, out, seen = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    for archives in (order_archives(spark, sf_dir), document_archives(spark, sf_dir)):
        write_archives(archives, landing)
        incremental_ingest(spark, landing, out, seen, TABLE_REGISTRY).awaitTermination()
    return landed(spark, out).select(file_name(F.col("path")).alias("file"), "status", "dataset", "rows")


# -- landing zone ----------------------------------------------------------------


def landing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are expected, labelled ones have landed."""
    expected = table(spark, sf_dir, "documents").select("doc_id", "source")
    arrived = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") * 2 + F.col("toxic")) * F.lit(393216)).cast("bigint").alias("length"))
    return reconcile(expected, arrived, "doc_id").select("doc_id", "source", "status", "message")


def forced_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "documents").select("doc_id")
    arrived = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).cast("bigint").alias("length"))
    return reconcile(expected, arrived, "doc_id", force=True).select("doc_id", "status")


def work_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_or_force(table(spark, sf_dir, "documents").select("doc_id", "lang"),
                         table(spark, sf_dir, "labels"), "doc_id")


def keys_not_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without any event."""
    requested = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return unknown_keys(requested, table(spark, sf_dir, "events"), "user_id")


def selected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_keys(table(spark, sf_dir, "events"), "event_type", ["signup", "purchase"]).select(
        "event_id", "event_type")


def _document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file listing; some names match two patterns, some none."""
    ending = (F.when(F.col("lang") == "en", ".zip").when(F.col("lang") == "fr", ".ZIP")
              .when(F.col("lang") == "de", ".parquet").otherwise(".csv.gz"))
    path = F.concat(F.lit("/zone/"), "source", F.lit("/"), F.col("doc_id").cast("string"), ending)
    return table(spark, sf_dir, "documents").select(path.alias("path"), F.col("n_chars").alias("length"))


def file_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_totals(match_files(_document_files(spark, sf_dir)))


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deletion_preview(match_files(_document_files(spark, sf_dir)))


def distinct_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files listed by two patterns, in either case, count once."""
    files = _document_files(spark, sf_dir)
    lower = files.filter(F.col("path").rlike(r"(?i)\.zip$"))
    return union_distinct_paths(lower, files.filter(F.col("path").rlike(r"\.(ZIP|zip|parquet)$")))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of orders in a folder, listed and counted."""
    landing = scratch(spark, "landing")
    write_archives(order_archives(spark, sf_dir), landing)
    return inventory_totals(match_files(list_files(spark, landing), FILE_CLASSES)).select("file_class", "files")


def published_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per kind of event, published and found by listing."""
    out, events = scratch(spark, "out"), table(spark, sf_dir, "events")
    for kind in sorted(r[0] for r in events.select("event_type").distinct().collect()):  # a handful of kinds
        publish(events.filter(F.col("event_type") == kind), out, kind)
    return published_names(list_files(spark, out, recursive=True))


def published_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of a table that is published twice: new ones win, others stay."""
    out, part = scratch(spark, "out"), table(spark, sf_dir, "part")
    largest = part.agg(F.max("p_size").cast("string")).first()[0]
    publish(part, out, "part", {"source": "first", "largest": largest})
    publish(part, out, "part", {"source": "second", "kind": "parts"})
    publish(part.limit(0), out, "part", {"source": "ignored"}, mode="ignore")
    count = spark.read.parquet(f"{out}/part.parquet").groupBy().agg(F.count("*").cast("string").alias("value"))
    return spark.read.parquet(f"{out}/_datasets/part").unionByName(
        count.select(F.lit("part").alias("dataset"), F.lit("rows").alias("property"), "value"))


def resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table left half written by a run that died is ingested again, as a whole."""
    landing, out = scratch(spark, "landing"), scratch(spark, "out")
    write_archives(order_archives(spark, sf_dir), landing)
    table(spark, sf_dir, "orders").limit(5).write.parquet(f"{out}/orders.parquet")
    remove_path(spark, f"{out}/orders.parquet/_SUCCESS")
    ingest(spark, landing, out, TABLE_REGISTRY, roles=ORDER_ROLES, collisions="union").count()
    return spark.read.parquet(f"{out}/orders.parquet")


def published_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives in two runs over one folder: the table published after the second."""
    base = scratch(spark, "stream")
    archives = _staged(spark, order_archives(spark, sf_dir))
    half = F.pmod(F.xxhash64("path"), F.lit(2))
    for run in (0, 1):
        write_archives(archives.filter(half == run), f"{base}/landing")
        incremental_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", TABLE_REGISTRY,
                           publish_to=f"{base}/published", roles=ORDER_ROLES).awaitTermination()
    return spark.read.parquet(f"{base}/published/orders.parquet")


CUSTOMER_ROLES = ColumnRoles(("C_CUSTKEY", "C_PARTNER"), ())


def _customer_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in three deliveries: whole balances and no segments; segments, and balances with cents;
    partners, of which every seventh has no number."""
    customers = table(spark, sf_dir, "customer").withColumn("part", F.col("c_custkey") % 3)
    cents = F.col("c_acctbal").cast("decimal(18,2)")
    partner = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("no. "), "c_nationkey")).otherwise(F.col("c_nationkey").cast("string"))
    own = customers.select(
        "part", "c_custkey", "c_name", F.when(F.col("part") == 0, F.floor(cents).cast("string")).otherwise(cents.cast("string"))
        .alias("balance"), F.when(F.col("part") > 0, F.col("c_mktsegment")).alias("segment"), partner.alias("c_partner"))
    path = F.concat(F.lit("/landing/CSV_CUSTOMER_"), F.col("part").cast("string"), F.lit("_"),
                    block_of("c_custkey", 5000).cast("string"), F.lit(".ZIP"))
    columns = ["c_custkey", "c_name", "balance", "segment"]
    first = csv_members(own.filter("part < 2"), path, F.lit("all.csv"), "c_custkey", columns)
    last = csv_members(own.filter("part = 2"), path, F.lit("all.csv"), "c_custkey", [*columns, "c_partner"])
    return zip_members(first.unionByName(last))


def widened_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: the second turns whole balances into fractions and fills a column that had no
    value, the third brings a new column."""
    base = scratch(spark, "stream")
    archives = _staged(spark, _customer_archives(spark, sf_dir))
    for part in range(3):
        write_archives(archives.filter(F.contains("path", F.lit(f"CUSTOMER_{part}_"))), f"{base}/landing")
        incremental_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", TABLE_REGISTRY,
                           publish_to=f"{base}/published", roles=CUSTOMER_ROLES).awaitTermination()
    return scan_published(spark, f"{base}/published", "customer")


def replaced_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second archive comes a second time under its old name: first with a third of its orders, without
    prices and with a column that goes again, then as it should be. The table published after that."""
    base = scratch(spark, "stream")
    archives = _staged(spark, order_archives(spark, sf_dir))
    again = block_of("o_orderkey", 5000) % 2 == 0
    path = F.concat(F.lit("/landing/CSV_ORDERS_"), block_of("o_orderkey", 5000).cast("string"), F.lit(".ZIP"))
    early = table(spark, sf_dir, "orders").filter(again & (F.col("o_orderkey") % 3 == 0)).select(
        "o_orderkey", F.lit("unknown").alias("o_totalprice"), F.lit("early").alias("o_note"))
    early = _staged(spark, zip_members(csv_members(early, path, F.lit("early.csv"), "o_orderkey", early.columns)))
    for run in (archives.join(early, "path", "left_anti").unionByName(early), archives.join(early, "path", "left_semi")):
        write_archives(run, f"{base}/landing")
        incremental_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", TABLE_REGISTRY,
                           publish_to=f"{base}/published", roles=ORDER_ROLES).awaitTermination()
    return scan_published(spark, f"{base}/published", "orders")


def profiled_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of landed orders from the states of two micro-batches, without a look at a record."""
    base = scratch(spark, "stream")
    archives = _staged(spark, order_archives(spark, sf_dir))
    half = F.pmod(F.xxhash64("path"), F.lit(2))
    for run in (0, 1):
        write_archives(archives.filter(half == run), f"{base}/landing")
        incremental_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", TABLE_REGISTRY,
                           publish_to=f"{base}/published", roles=ORDER_ROLES).awaitTermination()
    return landed_profiles(spark, f"{base}/out", TABLE_REGISTRY, ORDER_ROLES).select(
        "dataset", "description", "rows", "variables", "date_min", "date_max")


def lost_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers which were no numbers, as the outcomes of an ingest tell them."""
    landing, out = scratch(spark, "landing"), scratch(spark, "out")
    write_archives(_customer_archives(spark, sf_dir), landing)
    outcomes = ingest(spark, landing, out, TABLE_REGISTRY, roles=CUSTOMER_ROLES, collisions="union")
    return outcomes.select("dataset", F.explode("lost").alias("column", "lost")).distinct()


def catalog_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of registered sources against the files which are there."""
    registry = select_datasets(Registry(tuple(
        Dataset(f"source_{i}", f"CSV_SRC{i}", "SOURCES", f"Source {i}") for i in range(25))))
    path = F.concat(F.lit("/zone/CSV_"), F.upper("source"), F.lit(".ZIP"))
    files = table(spark, sf_dir, "documents").select(
        path.alias("path"), (F.col("n_chars") * 10).alias("length"))
    expected = dataset_catalog(spark, registry)
    return reconcile(expected, landed_archives(files), "file").select("dataset", "file", "status", "message")


QUERIES = {
    "decode_text": decoded,
    "classify_dataset": classified,
    "classify_large_registry": classified_by_many,
    "file_stems": stems,
    "archive_roundtrip": orders_from_archives,
    "archive_documents": documents_from_archives,
    "archive_blocks": documents_from_blocks,
    "archive_headers": headers_of_archives,
    "archive_latin1": latin1_archives,
    "csv_members": members,
    "ingest_report": report,
    "ingest_failures": report_failures,
    "ingest_totals": report_totals,
    "archive_errors": archive_errors,
    "plan_work": work_list,
    "ingest_publish": ingested,
    "resume_publish": resumed,
    "published_properties": published_properties,
    "incremental_ingest": ingested_incrementally,
    "incremental_publish": published_incrementally,
    "incremental_widening": widened_incrementally,
    "incremental_profile": profiled_incrementally,
    "incremental_replacement": replaced_incrementally,
    "coerced_identifiers": lost_identifiers,
    "landing_reconcile": landing_reconcile,
    "forced_reconcile": forced_reconcile,
    "skip_or_force": work_left,
    "unknown_keys": keys_not_expected,
    "select_datasets": selected_events,
    "inventory_totals": file_classes,
    "deletion_preview": dry_run,
    "union_distinct_paths": distinct_paths,
    "file_inventory": file_inventory,
    "published_names": published_datasets,
    "dataset_catalog": catalog_landing,
}

_ORDERS = (
    'SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", '
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS \"O_ORDERDATE\", "
    "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS \"O_ORDERPRIORITY\", "
    'o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE" FROM orders')

_OUTCOMES = (
    "SELECT DISTINCT 'success' AS status, 'orders' AS dataset, 'CSV_ORDERS_' || (o_orderkey // 5000) || '.ZIP' AS file "
    "FROM orders UNION ALL "
    "SELECT 'error', 'documents', 'csv_documents_' || page_id || '.zip' FROM pages UNION ALL "
    "SELECT DISTINCT 'error', '', 'mystery_' || (c_custkey // 500) || '.ZIP' FROM customer UNION ALL "
    "SELECT DISTINCT 'error', 'part', 'csv_part_' || (doc_id // 500) || '.ZIP' FROM labels UNION ALL "
    "SELECT DISTINCT 'error', 'supplier', 'csv_supplier_' || (s_suppkey // 20) || '.ZIP' FROM supplier")

_FILES = (
    "(SELECT '/zone/' || source || '/' || doc_id || CASE lang WHEN 'en' THEN '.zip' WHEN 'fr' THEN '.ZIP' "
    "WHEN 'de' THEN '.parquet' ELSE '.csv.gz' END AS path, n_chars AS length, "
    "CASE lang WHEN 'en' THEN 'raw' WHEN 'fr' THEN 'raw' WHEN 'de' THEN 'processed' END AS file_class "
    "FROM documents)")

_SOURCE_CASE = (
    "CASE WHEN contains(base, 'SRC1') THEN 'first' WHEN contains(base, 'SRC10') THEN 'tenth' "
    "WHEN contains(base, 'SRC2') THEN 'second' WHEN contains(base, 'SRC3') THEN 'third' END")

ORACLES = {
    "decode_text": (
        "SELECT 'documents' AS kind, doc_id AS id, 0::BIGINT AS part, text FROM documents UNION ALL "
        "SELECT 'conversations', conv_id, turn, text FROM conversations"),
    "classify_dataset": (
        "SELECT doc_id, path, dataset, "
        "CASE dataset WHEN 'first' THEN 'ONES' WHEN 'tenth' THEN 'TENS' WHEN 'second' THEN 'TWOS' "
        "WHEN 'third' THEN 'THREES' ELSE 'UNKNOWN' END AS dict_table, "
        "CASE dataset WHEN 'first' THEN 'Sources with a leading one' WHEN 'tenth' THEN 'Source ten' "
        "WHEN 'second' THEN 'Source two' WHEN 'third' THEN 'Source three' ELSE 'Unknown dataset' END AS description "
        f"FROM (SELECT *, {_SOURCE_CASE} AS dataset FROM (SELECT doc_id, "
        "'/landing/SRC3.d/' || lang || '_' || source || '.' || doc_id || '.zip' AS path, "
        "upper(lang || '_' || source || '.' || doc_id) AS base FROM documents))"),
    "classify_large_registry": (
        "WITH found AS (SELECT doc_id, '/landing/' || md5(doc_id::VARCHAR) || '.zip' AS path, "
        "(SELECT min(i) FROM range(10000) t(i) WHERE contains(upper(md5(d.doc_id::VARCHAR)), "
        "format('{:04X}', i * 40503 % 65536))) AS i FROM documents d) "
        "SELECT doc_id, path, 'd' || i AS dataset, coalesce('T' || i % 7, 'UNKNOWN') AS dict_table, "
        "coalesce('Set ' || i, 'Unknown dataset') AS description FROM found"),
    "file_stems": (
        "SELECT page_id, name, CASE WHEN regexp_matches(name, '^.+\\.[^.]+$') "
        "THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS stem "
        "FROM (SELECT page_id, regexp_extract(url, '([^/]*)/*$', 1) AS name FROM pages)"),
    "archive_roundtrip": _ORDERS,
    "archive_documents": (
        'SELECT doc_id AS "DOC_ID", text AS "TEXT", lang AS "LANG", source AS "SOURCE", n_chars AS "N_CHARS" '
        "FROM documents"),
    "archive_blocks": (
        'SELECT doc_id AS "DOC_ID", text AS "TEXT", lang AS "LANG", source AS "SOURCE", n_chars AS "N_CHARS" '
        "FROM documents"),
    "archive_headers": (
        "SELECT DISTINCT 'CSV_ORDERS_' || (o_orderkey // 5000) || '.ZIP' AS file, "
        "CASE WHEN o_orderstatus = 'F' THEN 'filled.csv' ELSE 'OTHER.CSV' END AS member, "
        "CASE WHEN o_orderstatus = 'F' THEN "
        "'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' ELSE "
        "'o_totalprice,o_orderdate,o_orderstatus,o_custkey,o_orderkey' END AS \"columns\" FROM orders"),
    "archive_latin1": "SELECT doc_id, text FROM documents",
    "csv_members": (
        "SELECT DISTINCT 'CSV_ORDERS_' || (o_orderkey // 5000) || '.ZIP' AS file, "
        "CASE WHEN o_orderstatus = 'F' THEN 'filled.csv' ELSE 'OTHER.CSV' END AS member FROM orders"),
    "ingest_report": (
        f"SELECT status, dataset, count(*)::BIGINT AS archives FROM ({_OUTCOMES}) GROUP BY status, dataset"),
    "ingest_failures": (
        "SELECT file, CASE WHEN dataset = '' THEN file ELSE dataset END AS name "
        f"FROM ({_OUTCOMES}) WHERE status = 'error'"),
    "ingest_totals": (
        "SELECT count(*) FILTER (WHERE status = 'success')::BIGINT AS success, "
        "count(*) FILTER (WHERE status = 'skipped')::BIGINT AS skipped, "
        "count(*) FILTER (WHERE status = 'error')::BIGINT AS error, "
        f"count(*) FILTER (WHERE status = 'error') = 0 AS ok FROM ({_OUTCOMES})"),
    "archive_errors": (
        "SELECT 'csv_documents_' || page_id || '.zip' AS file, 1::BIGINT AS faults FROM pages UNION ALL "
        "SELECT DISTINCT 'csv_part_' || (doc_id // 500) || '.ZIP', 1::BIGINT FROM labels UNION ALL "
        "SELECT 'csv_supplier_' || (s_suppkey // 20) || '.ZIP', count(*)::BIGINT FROM supplier GROUP BY 1"),
    "plan_work": (
        "SELECT path, CASE WHEN dataset IS NULL THEN 'error' WHEN dataset = 'second' THEN 'skipped' "
        "WHEN path = min(path) OVER (PARTITION BY dataset) THEN 'work' ELSE 'skipped' END AS status, dataset "
        f"FROM (SELECT path, {_SOURCE_CASE} AS dataset FROM (SELECT "
        "'/landing/' || source || '_' || lpad(doc_id::VARCHAR, 8, '0') || '.zip' AS path, "
        "upper(source || '_' || lpad(doc_id::VARCHAR, 8, '0')) AS base FROM documents))"),
    "ingest_publish": _ORDERS,
    "resume_publish": _ORDERS,
    "incremental_publish": _ORDERS,
    "incremental_replacement": _ORDERS,
    "incremental_widening": (
        'SELECT c_custkey AS "C_CUSTKEY", CASE WHEN c_custkey % 3 = 2 AND c_custkey % 7 <> 0 '
        'THEN c_nationkey::BIGINT END AS "C_PARTNER", (CASE WHEN c_custkey % 3 = 0 '
        'THEN floor(c_acctbal::DECIMAL(18,2)) ELSE c_acctbal::DECIMAL(18,2) END)::DOUBLE AS "BALANCE", '
        'c_name AS "C_NAME", CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS "SEGMENT" FROM customer'),
    "incremental_profile": (
        "SELECT 'orders' AS dataset, 'Orders' AS description, count(*) AS rows, 6::INTEGER AS variables, "
        "min(o_orderdate) AS date_min, max(o_orderdate) AS date_max FROM orders"),
    "coerced_identifiers": (
        "SELECT 'customer' AS dataset, 'C_CUSTKEY' AS \"column\", 0::BIGINT AS lost UNION ALL "
        "SELECT 'customer', 'C_PARTNER', count(*) FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 7 = 0"),
    "published_properties": (
        "SELECT 'part' AS dataset, 'source' AS property, 'second' AS value UNION ALL "
        "SELECT 'part', 'kind', 'parts' UNION ALL SELECT 'part', 'largest', max(p_size)::VARCHAR FROM part UNION ALL "
        "SELECT 'part', 'rows', count(*)::VARCHAR FROM part"),
    "incremental_ingest": (
        "SELECT 'CSV_ORDERS_' || (o_orderkey // 5000) || '.ZIP' AS file, 'success' AS status, "
        "'orders' AS dataset, count(*)::BIGINT AS rows FROM orders GROUP BY 1 UNION ALL "
        "SELECT 'csv_documents_' || (doc_id // 50) || '.zip', 'success', 'documents', count(*)::BIGINT "
        "FROM documents GROUP BY 1"),
    "landing_reconcile": (
        "SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NULL THEN 'fetch' ELSE 'present' END AS status, "
        "CASE WHEN l.doc_id IS NULL THEN '' ELSE "
        "printf('Already exists (%.2f MB)', (l.quality * 2 + l.toxic) * 393216 / 1048576.0) END AS message "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"),
    "forced_reconcile": "SELECT doc_id, 'fetch' AS status FROM documents",
    "skip_or_force": (
        "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "unknown_keys": (
        "SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"),
    "select_datasets": (
        "SELECT event_id, event_type FROM events WHERE event_type IN ('signup', 'purchase')"),
    "inventory_totals": (
        "SELECT coalesce(file_class, 'total') AS file_class, count(*)::BIGINT AS files, "
        "sum(length)::BIGINT AS bytes, sum(length)::DOUBLE / 1048576.0 AS size_mb "
        f"FROM {_FILES} WHERE file_class IS NOT NULL GROUP BY ROLLUP (file_class)"),
    "deletion_preview": (
        "SELECT file_class, regexp_extract(path, '([^/]*)$', 1) AS file, "
        f"printf('%.1f', length / 1048576.0) AS size_mb FROM {_FILES} WHERE file_class IS NOT NULL"),
    "union_distinct_paths": (
        f"SELECT DISTINCT path, length FROM {_FILES} WHERE file_class IS NOT NULL"),
    "file_inventory": (
        "SELECT unnest(['raw', 'total']) AS file_class, count(DISTINCT o_orderkey // 5000)::BIGINT AS files FROM orders"),
    "published_names": "SELECT DISTINCT event_type AS dataset FROM events",
    "dataset_catalog": (
        "SELECT 'source_' || i AS dataset, 'CSV_SRC' || i || '.ZIP' AS file, "
        "CASE WHEN bytes IS NULL THEN 'fetch' ELSE 'present' END AS status, "
        "CASE WHEN bytes IS NULL THEN '' ELSE printf('Already exists (%.2f MB)', bytes / 1048576.0) END AS message "
        "FROM range(25) r(i) LEFT JOIN (SELECT source, sum(n_chars) * 10 AS bytes FROM documents GROUP BY source) d "
        "ON d.source = 'src' || i"),
}
