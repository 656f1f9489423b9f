"""Incremental ingest: only archives which have not been read before as they are now."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from drydock.config import ColumnRoles, Provenance, Registry
from drydock.operators.lookups import classify, lookup
from drydock.operators.states import STATE_SCHEMA, column_states
from drydock.session import path_exists
from drydock.sources.archives import (
    ROW_SCHEMA, SPLIT_ABOVE, archive_digests, archive_faults, expand_archives, open_path)
from drydock.streaming.arrivals import (
    CHANGED_SCHEMA, NOTICE_SCHEMA, OUTCOME_SCHEMA, UNCHANGED, changed_archives, notice_archives, replaced_in, revisions,
    sound_versions)
from drydock.streaming.deliveries import described_in, profile_states, publish_delivery

PUBLISHED_SCHEMA = "dataset string, status string, message string, lost map<string, bigint>"
# What is stored of every micro-batch; columns that older ones lack are null.
LANDED_SCHEMAS = {"outcomes": OUTCOME_SCHEMA, "states": f"{STATE_SCHEMA}, revision int, batch int"}


def incremental_ingest(spark: SparkSession, root: str, out: str, checkpoint: str,
                       registry: Registry | None = None, files_per_batch: int = 1000,
                       publish_to: str | None = None, dictionary: DataFrame | None = None,
                       roles: ColumnRoles = ColumnRoles(), provenance: Provenance = Provenance(),
                       opener=open_path, split_above: int | None = SPLIT_ABOVE) -> StreamingQuery:
    """Expand all new archives of a folder into ``{out}/records`` and
    ``{out}/outcomes``, then stop.

    With a registry and ``publish_to``, the new records of each dataset are a
    delivery that is added to what is published there. What is known of a
    dataset's columns is kept as states in ``{out}/states`` and joined with that
    of the new records, so history is not typed again; earlier deliveries are
    written again only where a column they hold has become wider. What became of
    a dataset is told in ``{out}/published``. The stream
    itself carries only paths: archives of any size are opened by the tasks.
    ``{out}/notices`` tells which archives have been met, and the checkpoint which
    of these are done. Each micro-batch writes its
    own folder and overwrites it when it is repeated after a failure, so a
    record is never published twice.

    An archive that comes again under its path, with another time or length, is
    read again if its bytes differ (outcome ``skipped`` if not). If it is sound,
    it takes the place of its earlier version: the micro-batches that held this
    one get new states from what is left of them, their deliveries are written
    again, and types may become narrower. A faulty one leaves the earlier version
    in place, and an archive that is deleted keeps what it has brought. Earlier
    records stay in ``{out}/records``; ``current_records`` leaves them out.
    """
    notice_archives(spark, root, f"{out}/notices", files_per_batch)
    archives = (spark.readStream.schema(NOTICE_SCHEMA).option("maxFilesPerTrigger", 1)
                .parquet(f"{out}/notices").select("path"))

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows_at, told_at, digests_at = (f"{out}/{kind}/batch={batch_id}" for kind in ("records", "outcomes", "digests"))
        # Digests come first: an archive that changes while it is read is found changed the next time.
        earlier = all_outcomes(session, out).filter(F.col("batch") < batch_id)
        changed_archives(archive_digests(batch.distinct(), opener), earlier).write.mode("overwrite").parquet(digests_at)
        met = session.read.schema(CHANGED_SCHEMA).parquet(digests_at)
        expand_archives(met.filter("changed").select("path"), opener=opener, split_above=split_above).write.mode(
            "overwrite").parquet(rows_at)
        seen = archive_faults(session.read.schema(ROW_SCHEMA).parquet(rows_at))
        outcomes = lookup(seen, met, ["path"]).select(
            "path", F.when(F.col("faults") == 0, "success").otherwise("error").alias("status"),
            "rows", F.coalesce("error", F.lit("")).alias("message"), "digest")
        outcomes = outcomes.unionByName(met.filter(~F.col("changed")).select(
            "path", F.lit("skipped").alias("status"), F.lit(0).cast("bigint").alias("rows"),
            F.lit(UNCHANGED).alias("message"), "digest"))
        if registry is not None:
            outcomes = classify(outcomes, registry)
        outcomes.write.mode("overwrite").parquet(told_at)
        if registry is None or publish_to is None:
            return
        for number in (*replaced_in(all_outcomes(session, out), batch_id), batch_id):
            _store_states(session, out, number, roles)
        states = landed(session, out, "states")
        new = states.filter(F.col("batch") == batch_id).select("dataset").distinct()
        names, done = {r["dataset"] for r in new.collect()}, []  # registered ones
        for dataset in registry:
            if dataset.name in names:
                def records(number: int, name: str = dataset.name) -> DataFrame:
                    return sound_records(session, out, number).filter(F.col("dataset") == name).drop("dataset")
                try:
                    told = publish_delivery(session, records, states, publish_to, dataset, batch_id, dictionary, roles,
                                            provenance)
                except Exception as fault:  # the other datasets, and the stream, go on
                    told = "error", f"Error processing {dataset.name}: {type(fault).__name__}: {fault}", {}
                done.append((dataset.name, *told))
        session.createDataFrame(done, PUBLISHED_SCHEMA).write.mode("overwrite").parquet(f"{out}/published/batch={batch_id}")

    return (archives.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def landed(spark: SparkSession, out: str, kind: str = "outcomes") -> DataFrame:
    """Everything landed so far, over all micro-batches."""
    reader = spark.read
    return (reader.schema(LANDED_SCHEMAS[kind]) if kind in LANDED_SCHEMAS else reader).parquet(f"{out}/{kind}")


def all_outcomes(spark: SparkSession, out: str) -> DataFrame:
    """Outcomes of all micro-batches; none before the first."""
    return landed(spark, out) if path_exists(spark, f"{out}/outcomes") else spark.createDataFrame([], OUTCOME_SCHEMA)


def current_records(spark: SparkSession, out: str) -> DataFrame:
    """The records of all sound archives as they last came, with their dataset and micro-batch."""
    current = sound_versions(all_outcomes(spark, out)).filter("next IS NULL").select("path", "batch", "dataset")
    return lookup(landed(spark, out, "records"), current, ["path", "batch"], "inner")


def sound_records(spark: SparkSession, out: str, batch: int) -> DataFrame:
    """The records of a micro-batch's sound archives that no later one has replaced, with their dataset."""
    sound = sound_versions(landed(spark, out)).filter(
        (F.col("batch") == batch) & F.col("next").isNull() & F.col("dataset").isNotNull())
    rows = spark.read.schema(ROW_SCHEMA).parquet(f"{out}/records/batch={batch}")  # no look at the other micro-batches
    return lookup(rows, sound.select("path", "dataset"), ["path"], "inner")


def _store_states(spark: SparkSession, out: str, batch: int, roles: ColumnRoles) -> None:
    """The states of what counts of a micro-batch, with the micro-batch that has last replaced some of it."""
    states = column_states(sound_records(spark, out, batch), roles)
    revised = revisions(landed(spark, out)).filter(F.col("batch") == batch).select("dataset", "revision")
    lookup(states, revised, ["dataset"]).write.mode("overwrite").parquet(f"{out}/states/batch={batch}")


def landed_profiles(spark: SparkSession, out: str, registry: Registry, roles: ColumnRoles = ColumnRoles(),
                    published: str | None = None) -> DataFrame:
    """Profiles of all that has landed, from the states of the micro-batches: no record is read."""
    described = described_in(spark, published, registry) if published else {}
    return profile_states(landed(spark, out, "states"), registry, roles, described)
