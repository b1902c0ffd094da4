"""Session settings used by the tests and the benchmark.

On a cluster the session belongs to the caller; nothing in the library
changes its settings.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
import weakref
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app: str = "spanvec") -> SparkSession:
    """A local session with the settings the results are defined under."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spanvec-code-")) / "spanvec_code"
    made = shutil.make_archive(str(archive), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(made)
    _shipped.add(app)


_own_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    that leaves it unset gets a temporary folder; elsewhere it is an error,
    because executors could not see the driver's disk.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.TemporaryDirectory(prefix="spanvec-")
    return _own_dirs[app].name


def has_folder(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, in whatever store it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that the library wrote, in whatever store it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a result several later steps need: they read it instead of computing
    it again, and a lost executor takes none of it along.
    """
    path = f"{shared_dir(df.sparkSession)}/spanvec-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete written frames whose readers have all been written themselves."""
    for frame in frames:
        path = _written.pop(frame, None)
        if path is not None:
            delete_folder(frame.sparkSession, path)
