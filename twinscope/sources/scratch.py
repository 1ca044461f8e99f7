"""Shared scratch space for checkpoints and written intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KEPT: dict[tuple, tuple[str, T.StructType]] = {}
_LOCK = threading.RLock()


def _home(spark: SparkSession) -> str:
    """The user's folder on the session's default file system, which all executors reach."""
    context = spark.sparkContext
    files = context._jvm.org.apache.hadoop.fs.FileSystem.get(context._jsc.hadoopConfiguration())
    home = files.getHomeDirectory().toString().rstrip("/")
    if home.startswith("file:") and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir: the default file system is a folder of one machine")
    return f"{home}/.twinscope"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; if unset, one under the home
    folder of the default file system, unless that is local to each machine of a cluster."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _home(spark)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def _own_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one written table, in this application's folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to this application's folder once; all that follow read it there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files behind a table."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def kept(spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from ``sources``, written when first asked for and read from then on.

    It is made again in another application or when the files of a source have changed.
    """
    key = (spark.sparkContext.applicationId, name, *[_state(spark, s) for s in sources])
    with _LOCK:
        if key not in _KEPT:
            path, table = scratch_path(spark, name), build()
            table.write.parquet(path)
            _KEPT[key] = path, table.schema
    path, schema = _KEPT[key]
    return spark.read.schema(schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables this application has written here. Results not read yet are lost."""
    with _LOCK:
        for key in [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]:
            del _KEPT[key]
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
