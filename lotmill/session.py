"""Session builder and the few settings the library relies on."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "lotmill", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with adaptive execution and skew handling switched on.

    On a cluster ``master`` stays unset and comes from spark-submit; every key in ``conf``
    (dots written as ``__``) overrides the defaults below.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder every executor can reach, as named by the session (``spark.checkpoint.dir``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set; name a shared folder for written tables")
    return folder.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing, _before = threading.Lock(), 0, None


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Shuffle files of a write go when it has ended, not when the driver happens to collect its garbage; threads may write at once."""
    global _writing, _before
    with _lock:
        if not _writing:
            _before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writing += 1
    try:
        yield
    finally:
        with _lock:
            _writing -= 1
            if not _writing:
                spark.conf.unset(CLEANUP) if _before is None else spark.conf.set(CLEANUP, _before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back, so that iterations start from a short plan and survive lost executors.

    Without ``spark.checkpoint.dir`` a temporary folder serves in local mode only. Columns may have any names.
    """
    spark = df.sparkSession
    master = spark.sparkContext.master
    folder = shared_dir(spark, tempfile.gettempdir() if master == "local" or master.startswith("local[") else None)
    path = f"{folder}/lotmill-{name}-{uuid.uuid4().hex}"
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    with _shuffles_end(spark):
        plain.write.parquet(path)
    table = spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)
    table.stored_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written`; all that reads them has to be finished. A table that is not written stays."""
    for table in tables:
        path = vars(table).get("stored_at")
        if path:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: as :func:`written`, or persisted where there is no shared folder or a column has no type to write."""
    local = df.sparkSession.sparkContext.master.split("[")[0] == "local"
    if (local or df.sparkSession.conf.get("spark.checkpoint.dir", None)) and "void" not in df.schema.simpleString():
        return written(df, name)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
