"""Intermediate tables in the cluster's shared folder.

A job that needs the same costly result twice writes it once and reads it back.
The table lies in the folder that ``spark.checkpoint.dir`` or
``SparkContext.setCheckpointDir`` names, so it outlives executors.  Only a local
session may do without one; its tables go to a temporary folder.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import offerquarry


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """Fallback for local sessions: driver and tasks are one process."""
    folder = tempfile.mkdtemp(prefix="offerquarry-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


class NoSharedFolder(RuntimeError):
    """A cluster session names no folder that all its machines share."""


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored tables; an error on a cluster that names none."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/") + "/offerquarry"
    if context.master == "local" or context.master.startswith("local["):
        return _local_folder()
    raise NoSharedFolder(
        "set spark.checkpoint.dir to a folder that all machines of the cluster share"
    )


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Materialise a result as Parquet and return a scan of it.

    Later steps read only the columns they need, and a lost executor never
    leads back to before this point.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def no_rows(spark: SparkSession, kinds: str) -> DataFrame:
    """An empty table, without the Python workers that an empty list would start."""
    fields = StructType.fromDDL(kinds).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def drop_stored(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete tables of ``write_and_read`` (or paths) that no later step reads.

    The collection of the driver's garbage lets Spark's cleaner delete the shuffle
    files of finished jobs, too, which else stay until the driver runs out of memory.
    """
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table.stored_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles of finished jobs."""
    gc.collect()
    spark._jvm.System.gc()


def remove_stored(spark: SparkSession) -> bool:
    """Delete all tables this session stored; call it once results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.delete(path, True)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per session.

    Does what ``--py-files`` does at submission; jobs with Python steps call it, so
    executors need no installation.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(offerquarry.__file__))
    folder = tempfile.mkdtemp(prefix="offerquarry-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "offerquarry.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for inside, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(inside, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
