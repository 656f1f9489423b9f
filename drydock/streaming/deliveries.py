"""Datasets published delivery by delivery, from states instead of all history."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from drydock.config import WHITESPACE, ColumnRoles, Dataset, Provenance, Registry
from drydock.operators.columns import column, counted_losses, normalized_names, standardize
from drydock.operators.describe import attach_descriptions, descriptions_for
from drydock.operators.infer import apply_types
from drydock.operators.profile import PROFILE_COLUMNS, description_of
from drydock.operators.states import MINUS_ZERO, joined_states
from drydock.operators.union import assemble_table
from drydock.session import create_file, path_exists, remove_path
from drydock.sinks.parquet import describe_published
from drydock.sinks.versions import (
    WHOLE, Delivery, Manifest, add_files, folder_of, read_manifest, sweep, write_manifest, write_schema_file)
from drydock.sources.listing import described_columns

#: What a stored column can be cast to, so that its records need not be read again.
CASTS = {("bigint", "double"), ("bigint", "decimal(20,0)")}


def known_columns(states: DataFrame, dataset: str) -> tuple[dict[str, str], int]:
    """The type of each column of a dataset, by its name in the source and in the order in which headers name them,
    and the number of records. A row per column reaches the driver."""
    found = joined_states(states.filter(F.col("dataset") == dataset)).select("column", "first", "type", "rows").collect()
    found = sorted(found, key=lambda r: tuple(r["first"]))
    return {r["column"]: r["type"] for r in found}, max((r["rows"] for r in found), default=0)


def _castable(wider: set[tuple[str, str, str]], kinds: Mapping[str, int]) -> bool:
    return all((old, new) in CASTS and not (new == "double" and kinds[name] & MINUS_ZERO) for name, old, new in wider)


def _settled(types: Mapping[str, str], roles: ColumnRoles) -> dict[str, str]:
    """Types with identifiers as texts: they are made numeric straight from their text."""
    clean = normalized_names(types)  # refuses names which would collide
    return {n: "string" if c in roles.id_columns else t for (n, t), c in zip(types.items(), clean, strict=True)}


def _described(spark: SparkSession, types: Mapping[str, str], dictionary: DataFrame | None, dataset: Dataset,
               roles: ColumnRoles, mode: str) -> T.StructType:
    empty = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in types]))
    table = standardize(apply_types(empty, types, proven=True), roles, mode)
    texts = {} if dictionary is None else descriptions_for(table, dictionary, dataset.dict_table)
    return attach_descriptions(table, texts).schema


def _written(spark: SparkSession, folder: str, number: int, rows: DataFrame, types: Mapping[str, str],
             kinds: Mapping[str, int], schema: T.StructType, roles: ColumnRoles, mode: str,
             revision: int | None) -> Delivery:
    """Type the records of one delivery and write them; columns of which it has no value are left out."""
    texts = assemble_table(rows)
    held = [n for n in texts.columns if kinds.get(n)] or texts.columns[:1]
    typed = apply_types(texts.select(*[column(n) for n in held]), {n: types[n] for n in held}, proven=True)
    counted, told = counted_losses(typed, roles, mode)
    table = standardize(counted, roles, mode)
    files = add_files(spark, table.select(*[
        column(n).alias(n, metadata=schema[n].metadata) for n in table.columns]), folder, number)
    lost = told()
    return Delivery(number, files, lost.pop("rows"), {n: types[n] for n in held}, lost, revision)


def publish_delivery(spark: SparkSession, records: Callable[[int], DataFrame], states: DataFrame, out: str,
                     dataset: Dataset, number: int, dictionary: DataFrame | None = None,
                     roles: ColumnRoles = ColumnRoles(), provenance: Provenance = Provenance(),
                     mode: str = "bigint") -> tuple[str, str, dict[str, int]]:
    """Add delivery ``number`` to a published dataset: status, message, identifiers lost by coercion.

    ``records(n)`` are the expanded records of delivery ``n``, ``states`` the
    column states of all deliveries (with ``batch``). Only the new records are
    typed and written. An earlier delivery is written again only if a column it
    has values of has become wider meanwhile: from its own Parquet where a cast
    gives what its text would have given, else from its records. Everything
    else stays in the files it is in. The result equals one ingest of all
    deliveries. A delivery that comes again replaces what it had added, and one
    that is known by its states but was never published is published now. One of
    which a later delivery has replaced archives (``revision`` of its states) is
    written again from what is left of it, and goes when nothing is. Schema,
    descriptions and properties are written where the schema has changed.
    """
    folder = folder_of(out, dataset.name)
    types, total = known_columns(states, dataset.name)
    try:
        types = _settled(types, roles)
        schema = _described(spark, types, dictionary, dataset, roles, mode)
    except ValueError as clash:  # names which collide once upper-cased
        return "error", f"Error processing {dataset.name}: {clash}", {}
    current = read_manifest(spark, folder)
    if current:  # what a writer that stopped has left
        sweep(spark, folder, current)

    def kinds_in(delivery: int) -> dict[str, int]:
        own = states.filter((F.col("dataset") == dataset.name) & (F.col("batch") == delivery))
        return {r["column"]: r["kinds"] for r in own.groupBy("column").agg(F.bit_or("kinds").alias("kinds")).collect()}

    replaced = F.when(F.col("revision") > F.col("batch"), F.col("revision")) if "revision" in states.columns else F.lit(None)
    landed = {r["batch"]: r["revision"] for r in states.filter(F.col("dataset") == dataset.name).groupBy("batch").agg(
        F.max(replaced).alias("revision")).collect()}

    def retyped(delivery: int) -> Delivery:
        return _written(spark, folder, delivery, records(delivery), types, kinds_in(delivery), schema, roles, mode,
                        landed.get(delivery))

    kept = []
    for old in current.deliveries if current else ():
        if old.number in (number, WHOLE) or old.number not in landed:
            continue
        if old.revision != landed[old.number]:  # some of its archives have come again
            kept.append(retyped(old.number))
            continue
        wider = {(n, t, types[n]) for n, t in old.types.items() if types[n] != t}
        if not wider:
            kept.append(old)
        elif _castable(wider, kinds_in(old.number)):
            stored = spark.read.parquet(*[f"{folder}/{name}" for name in old.files])
            cast = stored.select(*[column(n).cast(schema[n].dataType).alias(n, metadata=schema[n].metadata)
                                   for n in stored.columns])
            kept.append(Delivery(old.number, add_files(spark, cast, folder, old.number), old.rows,
                                 {n: types[n] for n in old.types}, old.lost, old.revision))
        else:
            kept.append(retyped(old.number))
    missing = set(landed) - {d.number for d in kept} - {number}
    kept += [retyped(n) for n in sorted(missing)]  # of a writer that stopped before its version was there
    added = retyped(number)
    mark = f"{folder}/_SUCCESS"
    settled = current is not None and current.schema == schema and path_exists(spark, mark)
    if not settled:  # what stands beside the data is written again, and the mark comes last
        remove_path(spark, mark)
    manifest = Manifest(current.version + 1 if current else 1, schema, (*kept, added))
    write_manifest(spark, folder, manifest)
    if not settled:
        write_schema_file(spark, folder, schema)
        describe_published(spark.createDataFrame([], schema), out, dataset.name,
                           provenance.properties(dataset.description))
        create_file(spark, mark, "")
    sweep(spark, folder, manifest)
    return ("success", f"{total:,} rows, {len(schema)} columns, {described_columns(schema)} descriptions",
            dict(added.lost))


def published_deliveries(spark: SparkSession, out: str, dataset: str) -> DataFrame:
    """``delivery, rows, file`` of the current version."""
    manifest = read_manifest(spark, folder_of(out, dataset))
    rows = [(d.number, d.rows, name) for d in (manifest.deliveries if manifest else ()) for name in d.files]
    return spark.createDataFrame(rows, "delivery int, rows bigint, file string")


def profile_states(states: DataFrame, registry: Registry, roles: ColumnRoles = ColumnRoles(),
                   described: Mapping[str, int] | None = None) -> DataFrame:
    """Profiles of datasets from their column states: no record is read.

    The date range is that of the first date column with any valid date, as in
    ``profile_all``. ``described`` gives the number of columns with a text.
    """
    spark = states.sparkSession
    clean = F.upper(F.btrim(F.col("column"), F.lit(WHITESPACE)))
    order = F.coalesce(*[F.when(clean == n, F.lit(k)) for k, n in enumerate(roles.date_columns)])
    columns = joined_states(states).withColumn("order", order)
    first = F.min(F.when(F.col("order").isNotNull() & F.col("low").isNotNull(), F.struct("order", "low", "high")))
    found = columns.groupBy("dataset").agg(F.max("rows").alias("rows"), F.count("*").cast("int").alias("variables"),
                                           first.alias("range"))
    texts = spark.createDataFrame(
        [(d.name, description_of(d.name, registry), (described or {}).get(d.name, 0), f"{d.name}.parquet") for d in registry],
        "dataset string, description string, with_descriptions int, file string")
    return found.join(texts, "dataset").select(
        "dataset", "description", "rows", "variables", "with_descriptions", F.lit(None).cast("double").alias("size_mb"),
        F.col("range.low").alias("date_min"), F.col("range.high").alias("date_max"), "file").select(
        *PROFILE_COLUMNS).orderBy("dataset")


def described_in(spark: SparkSession, out: str, registry: Registry) -> dict[str, int]:
    """The number of described columns of each dataset that is kept in versions."""
    found = {d.name: read_manifest(spark, folder_of(out, d.name)) for d in registry}
    return {name: described_columns(m.schema) for name, m in found.items() if m}
