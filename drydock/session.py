"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "drydock", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks (no web page, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session may fall back on a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="drydock-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store Spark reads."""
    system, place = _path(spark, path)
    return system.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    system, place = _path(spark, path)
    system.delete(place, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if it is missing."""
    system, place = _path(spark, path)
    if not system.exists(place):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(place))


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _path(spark, path)
    system.mkdirs(place)


def move_file(spark: SparkSession, old: str, new: str) -> bool:
    """Rename within a store; false if the new name is taken."""
    system, place = _path(spark, new)
    return system.rename(_path(spark, old)[1], place)


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; fails if there is one already."""
    system, place = _path(spark, path)
    system.mkdirs(place.getParent())
    out = system.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    system, place = _path(spark, path)
    into = system.open(place)
    try:
        return bytes(into.readAllBytes()).decode()
    finally:
        into.close()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of the session.

    Spark copies the bundle from the driver to every executor, as with
    ``--py-files``. Not needed where the package is installed on the cluster.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    bundle = os.path.join(tempfile.mkdtemp(prefix="drydock-"), "drydock.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(bundle)
    _SHIPPED.add(application)
