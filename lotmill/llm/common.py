"""Helpers of the text operators: table access, written intermediate tables, measured broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # of two or three numbers each; beyond it the joins are planned without a hint
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set; it has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="lotmill-")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends here and survives lost executors.

    Shuffle files of the write go when it has ended, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return _stored_at(spark.read.schema(df.schema).parquet(path), path)


def _stored_at(df: DataFrame, path: str | None) -> DataFrame:
    df.stored_at = path
    return df


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written`. All that reads them has to be written before; a table that is not written stays."""
    for table_ in tables:
        path = vars(table_).get("stored_at")
        if path:
            spark = table_.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows) with a broadcast hint if it was counted to be small enough."""
    return _stored_at(F.broadcast(df), vars(df).get("stored_at")) if df.limit(max_rows + 1).count() <= max_rows else df


def without_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one column, any name); rows with a null id stay."""
    gone = ids.select(F.col(ids.columns[0]).alias("_gone_id")).where("_gone_id IS NOT NULL").distinct()
    gone = small(written(gone, "gone"))
    return docs.join(gone, docs[id_col] == gone["_gone_id"], "left_anti")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a, b)``: one row (id, component) per vertex, component = smallest id.

    Alternates large-star and small-star steps until the edges no longer change. Every step is a
    minimum per vertex (combined map-side) and a join that adaptive execution can split; each
    round is written to the shared folder, and the one before it goes. Rounds grow with the logarithm of the longest chain.
    The result reads the last round's table, which :func:`dropped` of the result deletes.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, written(hung.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
                                     .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        dropped(last)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return _stored_at(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots), edges.stored_at)
