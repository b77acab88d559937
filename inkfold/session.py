"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import suppress
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on; a cluster's own values for the rest are kept.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str = "local[*]", app: str = "inkfold", **conf: str) -> SparkSession:
    """A session with DEFAULTS; conf keys use ``__`` for ``.``."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors of a cluster where it isn't installed."""
    home = Path(__file__).resolve().parent
    spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{home.name}", "zip", home.parent, home.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where it is unset and the session runs in one process (tests), a new local folder is set. A cluster without the
    setting is an error: each executor would write to a disk of its own, and what is read back would lack rows.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[\d*,\s]+\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="inkfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's tables within the shared folder; ``release`` deletes it, as does the end of Python."""
    path = f"{shared_dir(spark)}/inkfold/{spark.sparkContext.applicationId}"
    if path not in _RUNS:
        _RUNS.add(path)
        atexit.register(release, spark, path)
    return path


_RUNS: set[str] = set()


def release(spark: SparkSession, path: str | None = None) -> None:
    """Deletes tables written by ``durable``: one folder, or all of this application.

    Frames that read them can't be used any more; call it when a query's result has been written or collected.
    """
    with suppress(Exception):  # the session may have ended
        folder = path or run_dir(spark)
        if folder.startswith("file:"):
            return _remove(re.sub("^file:(//(?=/))?", "", folder))
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _remove(folder: str) -> None:
    """Deletes a local folder; names go as they are listed, while Hadoop's delete holds all names of a folder at once."""
    with os.scandir(folder) as found:
        for entry in found:
            _remove(entry.path) if entry.is_dir(follow_symlinks=False) else os.unlink(entry.path)
    shutil.rmtree(folder)  # with what a file system left out while its folder changed


def new_path(spark: SparkSession) -> str:
    """A path in ``run_dir`` that nothing has."""
    return f"{run_dir(spark)}/{uuid.uuid4().hex}"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names within a folder of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]


def durable(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, and a lost executor costs no recomputation.

    The written columns are columnar, so later reads prune them, unlike ``checkpoint()``'s row blocks.
    """
    path = new_path(df.sparkSession)
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(df: DataFrame) -> DataFrame:
    """``df``, spread over all cores first if it is read in fewer pieces than there are cores.

    For costly work per row on a table of few files; a large table already has more pieces and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
