"""Full-row duplicates: removal, flags, shares. Groups of copies may hold most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_TASK_ROW = 100_000


def drop_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row (nulls compare equal); copies collapse before the shuffle."""
    return df.dropDuplicates()


def drop_near_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` and then by the remaining columns.

    ``min`` over a struct combines map-side, so a hot key does not gather in one task the way a
    window would.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def count_copies(df: DataFrame, name: str = "n_copies") -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def unfold(df: DataFrame, times: str, name: str, chunk: int = COPIES_PER_TASK_ROW, keep: bool = True) -> DataFrame:
    """Each row ``times`` times, numbered 0, 1, ... in ``name``.

    Rows to be repeated more than ``chunk`` times are cut into chunks that are spread over the
    cluster before they are unfolded. The counted rows are kept, as they are looked at first, unless ``keep`` is off
    because they are already.
    """
    columns = [c for c in df.columns if c != times]
    if keep:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if (df.agg(F.max(times)).first()[0] or 0) <= chunk:
        numbers = F.sequence(F.lit(0).cast("long"), F.col(times) - 1)
        return df.where(F.col(times) > 0).select(*columns, F.explode(numbers).alias(name))
    step = F.lit(chunk).cast("long")
    small = df.where((F.col(times) > 0) & (F.col(times) <= chunk)).select(*columns, F.lit(0).cast("long").alias("_from"), F.col(times).alias("_n"))
    large = (
        df.where(F.col(times) > chunk)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), (F.col(times) - 1).cast("long"), step)))
        .repartition(*columns, "_from")
        .select(*columns, "_from", F.least(step, F.col(times) - F.col("_from")).alias("_n"))
    )
    numbers = F.sequence(F.col("_from"), F.col("_from") + F.col("_n") - 1)
    return small.unionByName(large).select(*columns, F.explode(numbers).alias(name))


def number_copies(df: DataFrame, name: str = "copy_no", chunk: int = COPIES_PER_TASK_ROW) -> DataFrame:
    """Every row of ``df``, numbered 0, 1, ... among its exact copies.

    Equivalent to ``row_number()`` over all columns, but copies travel as a count.
    """
    return unfold(count_copies(df, "_times"), "_times", name, chunk).select(*df.columns, name)


def copy_flags(df: DataFrame, name: str = "is_copy") -> DataFrame:
    """Every row with a flag that is true for the second and later copies."""
    return number_copies(df, "_copy").withColumn(name, F.col("_copy") > 0).drop("_copy")


def copied_rows(df: DataFrame) -> DataFrame:
    """All members of groups of copies, first ones included."""
    groups = count_copies(df, "_times").where(F.col("_times") > 1)
    return unfold(groups, "_times", "_i").select(*df.columns)


def copy_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each value among the members of groups of copies, in percent."""
    groups = count_copies(df, "_n").where(F.col("_n") > 1)
    total = groups.agg(F.sum("_n")).scalar()
    return groups.where(F.col(column).isNotNull()).groupBy(column).agg((F.sum("_n") * 100.0 / total).alias("pct"))


def uniqueness(df: DataFrame) -> DataFrame:
    """Row count, surplus copies, their percentage and the uniqueness score."""
    out = count_copies(df, "_n").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    share = F.try_divide(F.col("duplicate_rows") * 100.0, F.col("rows"))
    return out.select(
        "rows", "duplicate_rows",
        F.round(F.coalesce(share, F.lit(0.0)), 4).alias("duplicate_rows_pct"),
        F.round(F.coalesce(100.0 - share, F.lit(100.0)), 2).alias("uniqueness_score_pct"),
    )
