"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "sparktab", **conf) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config(CHECKPOINT_CONF, _own_folder())
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _own_folder() -> str:
    """A temporary folder that goes when this process ends, for a local session alone."""
    folder = tempfile.mkdtemp(prefix="sparktab-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it, so an unset folder is an error there.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        named = _own_folder()
        spark.conf.set(CHECKPOINT_CONF, named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, for those of its
    functions that run in tasks. Clusters that install it can do without."""
    context = spark.sparkContext
    if getattr(context, "_sparktab_shipped", None):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="sparktab-package-"), "sparktab")
    context.addPyFile(shutil.make_archive(archive, "zip", root, "sparktab"))
    context._sparktab_shipped = True


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str = "settled") -> DataFrame:
    """Writes a narrow result that several passes will read, and reads it back.

    What it was computed from is then read once, and losing an executor costs a read of
    the written files, not the computation. The files stay while results may read them;
    ``release`` deletes those of a session.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Deletes what this application's ``settled`` calls wrote, once no result needs it; how many folders."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
