"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# SQL settings the operators rely on; all are runtime-settable.
_RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `sluice` importable by Python workers: zip the package once per
    Spark application in the driver's own temp folder and add it with
    addPyFile (the driver's file server hands it to every executor)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="sluice-py-"))
    archive = shutil.make_archive(os.path.join(folder, "sluice"), "zip",
                                  root_dir=os.path.dirname(package_dir), base_dir="sluice")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    try:
        spark.conf.set("spark.sql.timeType.enabled", "true")
    except Exception:  # older builds without TIME support: TIME columns stay strings
        pass
    return spark


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """A job's shuffle files go when it ends, not when a collection of the driver's finds them
    unused, so that the jobs of a long load do not add up on the executors' disks."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    previous = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def time_type_enabled(spark: SparkSession) -> bool:
    return (spark.conf.get("spark.sql.timeType.enabled", "false") or "false").lower() == "true"


def build_session(master: str = "local[*]", app: str = "sluice", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Only on a local master (tests), where driver and executors are one process.
        base = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the cluster's shared checkpoint directory."""
    base = _checkpoint_base(spark)
    path = "/".join([base, "sluice", *parts] + ([uuid.uuid4().hex] if unique else []))
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application's own, on whatever filesystem it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class FileExists(RuntimeError):
    """A file that must be new is there already."""


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, on whatever filesystem it is; none if there is no such folder."""
    path, fs = _file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of this application's own."""
    file, fs = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all; FileExists if there is one of that name."""
    file, fs = _file_system(spark, path)
    part, _ = _file_system(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(file.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(part, file, options)
    except Py4JJavaError as error:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExists(path) from error
        raise
