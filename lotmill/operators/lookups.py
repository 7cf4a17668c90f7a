"""Joins against lookup tables and group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 32 << 20


def attach(df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS) -> DataFrame:
    """Join a derived lookup table, broadcasting it only after measuring it.

    The lookup is an aggregate that can be tiny (brands) or huge (distinct prices), which no
    static estimate tells apart. One job materialises and measures it; below both limits it is
    broadcast so the big side is not shuffled, above them it is a plain equi-join in which
    adaptive execution splits hot keys. Null keys never match.
    """
    lookup = lookup.persist(StorageLevel.MEMORY_AND_DISK)
    width = sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in lookup.columns), F.lit(0))
    rows, chars = lookup.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows <= max_rows and chars <= max_chars:
        return df.join(F.broadcast(lookup), list(on), how)
    return df.join(lookup, list(on), how)


def lookup_table(spark, entries: Mapping, key: str, value: str, schema: str) -> DataFrame:
    """A lookup dictionary as a table (its size is fixed by the dictionary)."""
    return spark.createDataFrame(list(entries.items()), f"{key} {schema.split()[0]}, {value} {schema.split()[1]}")


def frequency_table(df: DataFrame, column: str, name: str = "freq") -> DataFrame:
    """Relative frequency of every non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, (F.col("n") / total).alias(name))


def group_mode(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent non-null value per key (ties: smallest), without one big buffer per key.

    Counting (key, value) first spreads a hot key over its values and combines map-side; the
    second aggregation then sees one row per distinct value.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(column).alias("v")))["v"]
    return counts.groupBy(*keys).agg(best.alias(column))


def fill_from_group_mode(df: DataFrame, keys: Sequence[str], column: str, fallback: str | None = None) -> DataFrame:
    """Fill nulls with the mode of the row's group, then with ``fallback`` where the group exists."""
    modes = group_mode(df, keys, column).withColumnRenamed(column, "_mode")
    joined = attach(df, modes, keys)
    filled = F.coalesce(F.col(column), F.col("_mode"))
    if fallback is not None:
        in_group = F.lit(True)
        for key in keys:
            in_group = in_group & F.col(key).isNotNull()
        filled = F.coalesce(filled, F.when(in_group, F.lit(fallback)))
    return joined.withColumn(column, filled).select(*df.columns)


def not_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct folded values that are not in the rule list."""
    folded = F.lower(F.col(column)).alias(column)
    rule_rows = df.sparkSession.createDataFrame([(v.lower(),) for v in allowed], f"`{column}` string")
    found = df.where(F.col(column).isNotNull()).select(folded).distinct()
    return found.join(F.broadcast(rule_rows), column, "left_anti")
