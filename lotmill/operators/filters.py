"""Row filters: domain bounds, nulls, outlier fences, violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators.fixed import Fixed
from lotmill.operators.order_stats import quantile_row

DOMAIN_BOUNDS = {c: (r["min"], r["max"]) for c, r in rules.CLEANING_RULES.items() if "min" in r}


def inside_domain(bounds: Mapping[str, tuple[float, float]] = DOMAIN_BOUNDS) -> Column:
    """True when every bounded column lies in its inclusive range; null counts as outside."""
    ok = F.lit(True)
    for column, (lo, hi) in bounds.items():
        ok = ok & F.col(column).between(lo, hi)
    return F.coalesce(ok, F.lit(False))


def remove_invalid(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = DOMAIN_BOUNDS) -> DataFrame:
    """Written as plain range predicates so that they reach the scan."""
    for column, (lo, hi) in bounds.items():
        df = df.where(F.col(column).between(lo, hi))
    return df


def plausible(df: DataFrame) -> DataFrame:
    """Ad-hoc validity filter: open power bounds, years 1950 to 2023."""
    return df.where(
        (F.col("power") > 0) & (F.col("power") < 5000)
        & F.col("kilometer").between(0, 300_000) & F.col("yearOfRegistration").between(1950, 2023)
    )


def violation_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows violating each named predicate, count and percentage, in one pass."""
    names = list(predicates)
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(p).alias(n) for n, p in predicates.items()])
    long = row.unpivot(["_rows"], names, "violation", "n")
    return long.select("violation", "n", F.round(F.try_divide(F.col("n") * 100.0, F.col("_rows")), 2).alias("pct"))


def iqr_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[Column, Column]]:
    """Per column the (lower, upper) fence as literals."""
    row = quantile_row(df, columns, {"q1": 0.25, "q3": 0.75})
    fences = {}
    for c in columns:
        q1, q3 = row.getField(f"{c}_q1"), row.getField(f"{c}_q3")
        fences[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return fences


def zscore(df: DataFrame, column: str, population: bool = False) -> Column:
    """(x - mean) / std; null for a constant column."""
    std = F.stddev_pop(column) if population else F.stddev_samp(column)
    stats = Fixed(df.agg(F.avg(column).alias("m"), std.alias("s")))
    return F.try_divide(F.col(column) - stats.getField("m"), stats.getField("s"))


def outside_iqr(df: DataFrame, column: str) -> Column:
    lo, hi = iqr_fences(df, [column])[column]
    return F.coalesce((F.col(column) < lo) | (F.col(column) > hi), F.lit(False))


def outside_zscore(df: DataFrame, column: str, limit: float = 3.0) -> Column:
    return F.coalesce(F.abs(zscore(df, column)) > limit, F.lit(False))


def remove_outliers(df: DataFrame, column: str) -> DataFrame:
    """Drop rows flagged by the IQR fences or by the z-score."""
    return df.where(~(outside_iqr(df, column) | outside_zscore(df, column)))


def keep_inside_iqr(df: DataFrame, column: str) -> DataFrame:
    lo, hi = iqr_fences(df, [column])[column]
    return df.where(F.col(column).between(lo, hi))


def flagged_rows(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Distinct keys of rows flagged by either outlier rule (union of the two row sets)."""
    by_iqr = df.where(outside_iqr(df, column)).select(*key)
    by_z = df.where(outside_zscore(df, column)).select(*key)
    return by_iqr.union(by_z).distinct()


def cap_outliers(df: DataFrame, columns: Sequence[str], statistics_from: DataFrame | None = None,
                 lower: Mapping[str, float] | None = None, approximate: bool = False) -> DataFrame:
    """Clip to [domain minimum, Q3 + 1.5 IQR]; integer columns use floor/ceil of the limits.

    ``statistics_from`` may name an earlier, narrower frame with the same values, so that the
    quantile pass does not replay joins it does not need.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    lower = {c: b[0] for c, b in DOMAIN_BOUNDS.items()} if lower is None else lower
    source = df if statistics_from is None else statistics_from
    if approximate:
        row = Fixed(source.agg(*[
            F.percentile_approx(c, p, 10_000).cast("double").alias(f"{c}_{n}") for c in columns for n, p in (("q1", 0.25), ("q3", 0.75))
        ]))
    else:
        row = quantile_row(source.select(*columns), columns, {"q1": 0.25, "q3": 0.75})
    integral = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "short", "byte")}
    out = {}
    for c in columns:
        q1, q3 = row.getField(f"{c}_q1"), row.getField(f"{c}_q3")
        lo, hi = F.lit(float(lower.get(c, 0.0))), q3 + 1.5 * (q3 - q1)
        if c in integral:
            kind = df.schema[c].dataType
            lo, hi = F.floor(lo).cast(kind), F.ceil(hi).cast(kind)
        # least/greatest skip nulls, so a null value has to be kept null explicitly
        out[c] = F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), lo), hi))
    return df.withColumns(out)
