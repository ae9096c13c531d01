"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "galewright", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the session the cluster gives you."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GALEWRIGHT_DRIVER_MEMORY", "8g"))
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_SCRATCH: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A temporary folder is used only where neither is set and all tasks run on this machine; on a
    cluster without a shared folder this raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else _own_dir(spark.sparkContext.master)


def _own_dir(master: str) -> str:
    if not is_local(master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _LOCAL_SCRATCH
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="galewright-")
    return _LOCAL_SCRATCH


def is_local(master: str) -> bool:
    """Do all tasks run in the driver's own process?"""
    return master == "local" or master.startswith("local[")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_WRITTEN: list[str] = []


def materialize(df: DataFrame, label: str, **options: object) -> DataFrame:
    """Write ``df`` once below the shared folder, with options of the writer if any, and read it back.

    Cuts the lineage like ``checkpoint()`` does, but computes the input only once and keeps it
    columnar, so that later passes read just the columns they need. Survives lost executors.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._written_path = path
    _WRITTEN.append(path)
    return read


def drop_written(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later step reads."""
    for table in tables:
        _WRITTEN.remove(table._written_path)
        _delete(table.sparkSession, table._written_path)


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def drop_materialized(spark: SparkSession) -> int:
    """Delete what ``materialize`` wrote in this process, once no result needs it; the number of tables."""
    dropped = 0
    while _WRITTEN:
        dropped += _delete(spark, _WRITTEN.pop())
    return dropped


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, for the few vectorised UDFs."""
    application = spark.sparkContext.applicationId
    # Two archives under one name would differ, and executors that find both end.
    with _SHIPPING:
        if application in _SHIPPED:
            return
        home = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='galewright-')}/{home.name}", "zip", home.parent, home.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)
