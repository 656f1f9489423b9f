"""Published datasets that grow by deliveries: immutable files, and a manifest which says which of them count.

``{dataset}.parquet`` holds the data files of all deliveries side by side. A
version of the dataset is a manifest in its ``_versions``: the schema, and for
each delivery its files and the types they were written with. A manifest is
written whole, and takes the next number by a rename that fails if somebody
else has it; the highest number is the current version. Files are never
changed: a version that replaces some names the new ones, and the old ones are
deleted when it is there. A reader who goes by the manifest (``scan_versioned``)
sees the one version or the other, wherever a writer stops.

For readers of the folder alone the schema is also kept as ``_common_metadata``,
from which Spark takes it before any data file. They may meet files of two
versions while one takes the place of the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from drydock.session import (
    child_names, create_file, make_folder, move_file, path_exists, read_file, remove_path)

#: The number of the one delivery of a dataset that was published as a whole.
WHOLE = -1


@dataclass(frozen=True)
class Delivery:
    """What one delivery has added: its files, rows, and the type of each column
    its files hold, by the name in the source. A column without any value is
    left out of the files; it is null whatever type it gets later. ``revision`` is
    the delivery that last replaced some of it, if any has."""

    number: int
    files: tuple[str, ...]
    rows: int
    types: Mapping[str, str]
    lost: Mapping[str, int] = field(default_factory=dict)
    revision: int | None = None


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    deliveries: tuple[Delivery, ...]

    def files(self) -> list[str]:
        return [name for d in self.deliveries for name in d.files]

    def rows(self) -> int:
        return sum(d.rows for d in self.deliveries)


def folder_of(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}.parquet"


def read_manifest(spark: SparkSession, folder: str) -> Manifest | None:
    """The current version, or none if the folder is not kept in versions."""
    names = [n for n in child_names(spark, f"{folder}/_versions") if n.endswith(".json") and n[:-5].isdigit()]
    if not names:
        return None
    found = json.loads(read_file(spark, f"{folder}/_versions/{max(names)}"))
    return Manifest(found["version"], T.StructType.fromJson(found["schema"]), tuple(
        Delivery(**{**d, "files": tuple(d["files"])}) for d in found["deliveries"]))


def write_manifest(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    """Make a version the current one; fails if another writer has taken its number."""
    body = json.dumps({"version": manifest.version, "schema": manifest.schema.jsonValue(),
                       "deliveries": [asdict(d) for d in manifest.deliveries]})
    beside = f"{folder}/_versions/.{uuid.uuid4().hex}"
    create_file(spark, beside, body)
    place = f"{folder}/_versions/{manifest.version:010d}.json"
    if path_exists(spark, place) or not move_file(spark, beside, place):
        remove_path(spark, beside)
        raise OSError(f"version {manifest.version} of {folder} is taken: another writer was faster")


def scan_versioned(spark: SparkSession, folder: str, manifest: Manifest, deliveries=None) -> DataFrame:
    """The rows of a version, or of some of its deliveries; columns a file lacks are null."""
    chosen = [d for d in manifest.deliveries if deliveries is None or d.number in deliveries]
    files = [f"{folder}/{name}" for d in chosen for name in d.files]
    if not files:
        return spark.createDataFrame([], manifest.schema)
    return spark.read.schema(manifest.schema).parquet(*files)


def add_files(spark: SparkSession, df: DataFrame, folder: str, delivery: int | None = None) -> tuple[str, ...]:
    """Write a table beside the data files and move its files among them; no version knows them yet."""
    incoming = f"{folder}/_incoming-{uuid.uuid4().hex}"
    make_folder(spark, folder)
    df.write.option("compression", "snappy").parquet(incoming)
    moved = []
    for name in child_names(spark, incoming):
        if name.endswith(".parquet"):
            moved.append(name if delivery is None else f"d{delivery:06d}-{name}")
            if not move_file(spark, f"{incoming}/{name}", f"{folder}/{moved[-1]}"):
                raise OSError(f"cannot move {name} into {folder}")
    remove_path(spark, incoming)
    return tuple(sorted(moved))


def sweep(spark: SparkSession, folder: str, manifest: Manifest | None) -> None:
    """Delete data files and half-written folders that the current version does not name:
    what it has replaced, and what a writer left that stopped before its version was there."""
    named = set(manifest.files()) if manifest else set()
    for name in child_names(spark, folder):
        if name.startswith("_incoming-") or (name.endswith(".parquet") and name not in named):
            remove_path(spark, f"{folder}/{name}")


def write_schema_file(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Keep the schema where readers of the folder alone look for it first."""
    incoming = f"{folder}/_incoming-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(incoming)
    part = next(name for name in child_names(spark, incoming) if name.endswith(".parquet"))
    remove_path(spark, f"{folder}/_common_metadata")
    move_file(spark, f"{incoming}/{part}", f"{folder}/_common_metadata")
    remove_path(spark, incoming)
