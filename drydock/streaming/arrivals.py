"""Which archives have arrived, in which version, and which of them count.

Spark's file source knows a file by its path: one that is replaced under its old
name is never read again, and one that is older than what came a week later is
passed over. So the archives of a folder are listed, each is noticed once per
path, time and length, and the stream reads the notices. What an archive held is
known by its digest; of several sound versions of an archive the latest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from drydock.session import make_folder
from drydock.sources.listing import LISTING_SCHEMA, list_archives

NOTICE_SCHEMA = LISTING_SCHEMA
CHANGED_SCHEMA = "path string, digest string, changed boolean"
OUTCOME_SCHEMA = ("path string, status string, rows bigint, message string, digest string, dataset string, "
                  "dict_table string, description string, batch int")
UNCHANGED = "Unchanged since it was read"


def notice_archives(spark: SparkSession, root: str, notices: str, per_file: int) -> None:
    """Note the archives of ``root`` that are not noted yet with their time and length, at most ``per_file`` a file.

    A writer that stops half-way has noted some of them; the next call notes the others.
    """
    make_folder(spark, notices)
    known = spark.read.schema(NOTICE_SCHEMA).parquet(notices)
    new = list_archives(spark, root).join(known, ["path", "modified", "length"], "left_anti")
    count = new.count()
    if count:
        (new.repartitionByRange(-(-count // per_file), "path").write.option("maxRecordsPerFile", per_file)
         .mode("append").parquet(notices))


def sound_versions(outcomes: DataFrame) -> DataFrame:
    """``path, dataset, batch, digest, next``: the sound versions of each archive; ``next`` is the micro-batch that has
    replaced one, or null for the one that counts. An archive has a row per version, so a path's rows are few."""
    later = F.lead("batch").over(Window.partitionBy("path").orderBy("batch"))
    return outcomes.filter("status = 'success'").select("path", "dataset", "batch", "digest", later.alias("next"))


def changed_archives(digests: DataFrame, earlier: DataFrame) -> DataFrame:
    """``path, digest, changed`` of noticed archives: whether one differs from its sound version that counts. One that
    has none, or one without a digest, does."""
    known = sound_versions(earlier).filter("next IS NULL").select("path", F.col("digest").alias("_known"))
    return digests.join(known, "path", "left").select(
        "path", "digest", (~F.col("digest").eqNullSafe(F.col("_known"))).alias("changed"))


def replaced_in(outcomes: DataFrame, batch: int) -> list[int]:
    """The micro-batches of which ``batch`` has replaced archives; a number a micro-batch reaches the driver."""
    hit = sound_versions(outcomes).filter(F.col("next") == batch).select("batch").distinct()
    return sorted(r["batch"] for r in hit.collect())


def revisions(outcomes: DataFrame) -> DataFrame:
    """``batch, dataset, revision``: the last micro-batch that has replaced archives of a dataset's delivery."""
    return sound_versions(outcomes).groupBy("batch", "dataset").agg(F.max("next").cast("int").alias("revision"))
