"""Archives of CSV files to described Parquet, end to end."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.config import ColumnRoles, Dataset, Provenance, Registry
from drydock.functions.text import file_name
from drydock.operators.columns import counted_losses, normalized_names, standardize
from drydock.operators.describe import attach_descriptions, descriptions_for
from drydock.operators.distinct import keep_first
from drydock.operators.infer import apply_types, inferred
from drydock.operators.lookups import classify, exclude, include
from drydock.operators.union import assemble_table
from drydock.session import remove_path, scratch
from drydock.sinks.parquet import is_published, publish
from drydock.sources.archives import ROW_SCHEMA, SPLIT_ABOVE, archive_faults, expand_archives, open_path
from drydock.sources.listing import list_archives

# Datasets published at the same time.
PARALLEL_DATASETS = 8

OUTCOME_SCHEMA = "path string, status string, dataset string, message string, lost map<string, bigint>"


def plan_work(files: DataFrame, published: DataFrame, registry: Registry, force: bool = False,
              collisions: str = "first") -> tuple[DataFrame, DataFrame]:
    """Split listed archives into work ``(path, dataset)`` and settled outcomes.

    Unrecognised names are errors. What is published is skipped unless
    ``force``. Of several archives for one dataset the first by path is taken
    and the others are skipped, or, with ``collisions="union"``, all are taken.
    """
    named = classify(files.select("path"), registry).select("path", "dataset")
    unknown = named.filter(F.col("dataset").isNull()).select(
        "path", F.lit("error").alias("status"), "dataset",
        F.concat(F.lit("Unknown dataset type: "), file_name(F.col("path"))).alias("message"))
    known = named.filter(F.col("dataset").isNotNull())
    fresh = known if force else exclude(known, published, ["dataset"])
    done = known.limit(0) if force else include(known, published, ["dataset"])
    work = fresh if collisions == "union" else keep_first(fresh, ["dataset"], F.col("path")).select(
        "path", "dataset")
    late = exclude(fresh, work, ["path"])

    def skipped(rows: DataFrame, message: str) -> DataFrame:
        return rows.select("path", F.lit("skipped").alias("status"), "dataset", F.lit(message).alias("message"))

    settled = unknown.unionByName(skipped(done, "Already exists")).unionByName(
        skipped(late, "Another archive of this dataset comes first"))
    return work, settled


def typed_table(rows: DataFrame, roles: ColumnRoles = ColumnRoles(), mode: str = "bigint",
                string_columns=(), headers: DataFrame | None = None) -> DataFrame:
    """Expanded records of one dataset as its standardised, typed table.

    Identifiers skip inference: they are made numeric straight from their text.
    """
    return standardize(_typed_texts(rows, roles, string_columns, headers), roles, mode)


def _typed_texts(rows: DataFrame, roles: ColumnRoles, string_columns=(), headers: DataFrame | None = None) -> DataFrame:
    texts = assemble_table(rows, headers)
    clean = normalized_names(texts.columns)  # refuses names which would collide
    ids = [n for n, c in zip(texts.columns, clean) if c in roles.id_columns]
    types = inferred(texts, string_columns=[*string_columns, *ids])
    return apply_types(texts, types, proven=True)


def published_of(spark: SparkSession, root: str, registry: Registry) -> DataFrame:
    """The registered datasets that are published as a whole: a few looks at marks, no listing of files."""
    names = [(d.name,) for d in registry if is_published(spark, root, d.name)]
    return spark.createDataFrame(names, "dataset string")


def ingest(spark: SparkSession, root: str, out: str, registry: Registry,
           dictionary: DataFrame | None = None, roles: ColumnRoles = ColumnRoles(),
           provenance: Provenance = Provenance(), force: bool = False, collisions: str = "first",
           mode: str = "bigint", string_columns=(), staging: str | None = None, opener=open_path,
           split_above: int | None = SPLIT_ABOVE) -> DataFrame:
    """Expand, unite, type, standardise, describe and publish all new archives.

    The expanded records are staged once as Parquet in the shared folder, which
    ends the one-task-per-archive stage: everything after it reads splittable
    files, and survives the loss of an executor without unpacking again. Records
    are removed when all datasets are done. Whatever goes wrong with one dataset
    becomes the outcome of its archives, and the others go on.
    Returns the outcomes ``(path, status, dataset, message, lost)``; ``lost`` tells
    how many values of each identifier of the dataset were no numbers and became
    null, counted by the job that published it.
    """
    work, settled = plan_work(list_archives(spark, root), published_of(spark, out, registry), registry, force, collisions)
    staged_at = staging or scratch(spark, "ingest")
    settled.write.mode("overwrite").parquet(f"{staged_at}/settled")
    work.write.mode("overwrite").parquet(f"{staged_at}/work")
    work = spark.read.schema("path string, dataset string").parquet(f"{staged_at}/work")
    present = {r["dataset"] for r in work.select("dataset").distinct().collect()}
    found = [d for d in registry if d.name in present]

    def run(dataset: Dataset) -> DataFrame:
        paths, place = work.filter(F.col("dataset") == dataset.name), f"{staged_at}/outcomes/{dataset.name}"
        try:
            records = stage_records(expand_archives(paths.select("path"), opener=opener,
                                                                    split_above=split_above),
                                    f"{staged_at}/records/{dataset.name}")
            outcome = publish_staged(records, paths, out, dataset, dictionary, roles, provenance, mode, string_columns,
                                     f"{staged_at}/archives/{dataset.name}")
            outcome.write.mode("overwrite").parquet(place)
        except Exception as fault:  # any fault: the other datasets must not be lost with this one
            outcome = failed_outcomes(paths, dataset.name, fault)
            outcome.write.mode("overwrite").parquet(place)
        return spark.read.schema(OUTCOME_SCHEMA).parquet(place)

    outcomes = [spark.read.schema(OUTCOME_SCHEMA).parquet(f"{staged_at}/settled")]
    # Datasets are independent, so their jobs are submitted side by side.
    with ThreadPoolExecutor(max_workers=max(1, min(len(found), PARALLEL_DATASETS))) as pool:
        outcomes += pool.map(inheritable_thread_target(spark)(run), found)
    remove_path(spark, f"{staged_at}/records")
    return reduce(DataFrame.unionByName, outcomes)


def failed_outcomes(work: DataFrame, dataset: str, fault: Exception) -> DataFrame:
    first = (str(fault).strip().splitlines() or [""])[0][:500]
    return work.select("path", F.lit("error").alias("status"), "dataset",
                       F.lit(f"Error processing {dataset}: {type(fault).__name__}: {first}").alias("message"))


def stage_records(rows: DataFrame, path: str) -> DataFrame:
    """Expanded records, written once and read from there ever after."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(ROW_SCHEMA).parquet(path)


def archive_outcomes(rows: DataFrame, work: DataFrame) -> DataFrame:
    """What became of each archive ``(path, status, dataset, message)``."""
    checked = work.join(archive_faults(rows), "path", "left")
    done = F.concat(F.format_number(F.coalesce("rows", F.lit(0)), 0), F.lit(" rows"))
    failed = F.concat(F.lit("Error processing "), file_name(F.col("path")), F.lit(": "), F.col("error"))
    return checked.select(
        "path", F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), "dataset",
        F.when(F.col("error").isNull(), done).otherwise(failed).alias("message"))


def publish_staged(records: DataFrame, work: DataFrame, out: str, dataset: Dataset,
                   dictionary: DataFrame | None, roles: ColumnRoles, provenance: Provenance,
                   mode: str, string_columns, told_at: str) -> DataFrame:
    """Publish the sound archives of one dataset; outcomes of all its archives.

    The records are read once for a row per archive, kept at ``told_at``. Only
    where that names a fault are the records of sound archives picked out.
    """
    archive_faults(records).write.mode("overwrite").parquet(told_at)
    told = work.join(records.sparkSession.read.parquet(told_at).select("path", "faults", "error"), "path", "left")
    failed = told.filter("faults > 0").select(
        "path", F.lit("error").alias("status"), "dataset",
        F.concat(F.lit("Error processing "), file_name(F.col("path")), F.lit(": "), "error").alias("message"))
    sound = told.filter("coalesce(faults, 0) = 0").select("path", "dataset")
    if sound.isEmpty():
        return failed
    rows = records if failed.isEmpty() else include(records, sound, ["path"])
    status, message, lost = publish_records(rows, out, dataset, dictionary, roles, provenance, mode, string_columns)
    counts = F.create_map(*[F.lit(x) for pair in sorted(lost.items()) for x in pair]).cast("map<string, bigint>")
    return failed.unionByName(sound.select(
        "path", F.lit(status).alias("status"), "dataset", F.lit(message).alias("message"), counts.alias("lost")),
        allowMissingColumns=True)


def publish_records(rows: DataFrame, out: str, dataset: Dataset, dictionary: DataFrame | None = None,
                    roles: ColumnRoles = ColumnRoles(), provenance: Provenance = Provenance(),
                    mode: str = "bigint", string_columns=()) -> tuple[str, str, dict[str, int]]:
    """Type, describe and publish the records of one dataset; status, message, and the values of each
    identifier that coercion lost. Rows and losses are counted by the job that writes the table."""
    try:
        typed = _typed_texts(rows, roles, string_columns)
    except ValueError as clash:  # names which collide once upper-cased
        return "error", f"Error processing {dataset.name}: {clash}", {}
    counted, told = counted_losses(typed, roles, mode)
    table = standardize(counted, roles, mode)
    texts = {} if dictionary is None else descriptions_for(table, dictionary, dataset.dict_table)
    publish(attach_descriptions(table, texts), out, dataset.name, provenance.properties(dataset.description))
    lost = told()
    return "success", f"{lost.pop('rows'):,} rows, {len(table.columns)} columns, {len(texts)} descriptions", lost
