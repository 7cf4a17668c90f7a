"""Column-layout operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail when columns are missing, else project to exactly these."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_source(df: DataFrame, source: str, column: str = "dataSource") -> DataFrame:
    return df.withColumn(column, F.lit(source))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absent columns are ignored."""
    return df.drop(*columns)


def reindex(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Exactly these columns in this order; absent ones filled, others dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def fill_missing(df: DataFrame, values: Mapping) -> DataFrame:
    return df.fillna(dict(values))
