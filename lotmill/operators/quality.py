"""Table-quality checks. Each returns a small table; passes over the data are shared per check."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators.fixed import Fixed
from lotmill.functions.numeric import known, normal_cdf, pearson
from lotmill.operators.lookups import attach
from lotmill.operators.order_stats import (
    ROWS_PER_BUCKET, QUARTILES, average_ranks, quantile_columns, ranked_values,
)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _rows(df: DataFrame, cells: Mapping[str, list], fields: Sequence[str]) -> DataFrame:
    """One aggregation over ``df``; ``cells[column]`` are aggregates, returned as one row per column."""
    packed = df.agg(*[F.struct(*[v.alias(f) for v, f in zip(values, fields)]).alias(c) for c, values in cells.items()])
    return packed.unpivot([], list(cells), "column", "cell").select("column", "cell.*")


def schema_check(df: DataFrame, expected: Mapping[str, str] = rules.EXPECTED_TYPES) -> DataFrame:
    """Missing columns and type mismatches fail; extra columns are only noted."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [("missing", c, t, None, True) for c, t in sorted(expected.items()) if c not in actual]
    rows += [("extra", c, None, t, False) for c, t in sorted(actual.items()) if c not in expected]
    rows += [("type", c, t, actual[c], True) for c, t in expected.items() if c in actual and actual[c] != t]
    return df.sparkSession.createDataFrame(rows, "kind string, column string, expected string, actual string, fails boolean")


def schema_findings(df: DataFrame, expected: Mapping[str, str] = rules.EXPECTED_TYPES) -> DataFrame:
    """:func:`schema_check` with ``bad_values``: how many values of a column of another type do not cast to the expected one."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = {c: [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())] for c, t in expected.items() if actual.get(c, t) != t}
    found = schema_check(df, expected)
    if not cells:
        return found.withColumn("bad_values", F.lit(None).cast("long"))
    return found.join(F.broadcast(_rows(df, cells, ["bad_values"])), "column", "left")  # one row per column


def _there(df: DataFrame, c: str):
    """The value of a column, null where it is missing: null or, in floating columns, NaN."""
    return known(f"`{c}`") if df.schema[c].dataType.typeName() in ("float", "double") else F.col(f"`{c}`")


def completeness(df: DataFrame, required: Sequence[str] = rules.REQUIRED_COLUMNS, limit: float = 0.05) -> DataFrame:
    """Null count and percentage per column; a required column fails above ``limit``."""
    cells = {c: [F.count(F.lit(1)), F.count_if(_there(df, c).isNull())] for c in df.columns}
    counted = _rows(df, cells, ["rows", "missing_count"])
    share = F.coalesce(F.try_divide(F.col("missing_count").cast("double"), F.col("rows")), F.lit(0.0))
    return counted.select(
        "column", "missing_count", F.round(share * 100, 4).alias("missing_pct"),
        (F.col("column").isin(list(required)) & (share > limit)).alias("failed"),
    )


def completeness_score(df: DataFrame) -> DataFrame:
    """Non-null cells as a percentage of all cells (0 for an empty table)."""
    filled = sum((F.count(_there(df, c)) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(F.round(F.coalesce(F.try_divide(filled * 100.0, cells), F.lit(0.0)), 2).alias("completeness_score_pct"))


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns that have nulls, with count and percentage."""
    return (
        completeness(df, required=()).where(F.col("missing_count") > 0)
        .select("column", "missing_count", F.round("missing_pct", 2).alias("missing_pct"))
    )


def range_checks(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = rules.RANGE_RULES) -> DataFrame:
    cells = {}
    for c in _present(df, list(bounds)):
        lo, hi = bounds[c]
        cells[c] = [F.count(_there(df, c)), F.count_if(known(c) < lo), F.count_if(known(c) > hi)]
    counted = _rows(df, cells, ["values", "below_min", "above_max"])
    good = (F.col("values") - F.col("below_min") - F.col("above_max")) * 100.0
    return counted.withColumn(
        "accuracy_score_pct", F.round(F.coalesce(F.try_divide(good, F.col("values")), F.lit(100.0)), 2)
    )


def category_checks(df: DataFrame, allowed: Mapping[str, Sequence[str]] = rules.CATEGORY_RULES) -> DataFrame:
    """(column, invalid_value): folded values outside the rule list, each once."""
    columns = _present(df, list(allowed))
    pairs = [(c, v.lower()) for c in columns for v in allowed[c]]
    rule_rows = df.sparkSession.createDataFrame(pairs, "column string, invalid_value string")
    found = (
        df.select(*[F.lower(F.col(c)).alias(c) for c in columns])
        .unpivot([], columns, "column", "invalid_value")
        .where(F.col("invalid_value").isNotNull()).distinct()
    )
    return found.join(F.broadcast(rule_rows), ["column", "invalid_value"], "left_anti")


def rule_violations(df: DataFrame, schema: Mapping[str, Mapping] = rules.CLEANING_RULES) -> DataFrame:
    """(column, rule, n) for every broken rule: missing, nulls, min, max, allowed."""
    missing = [(c, "missing", 0) for c in schema if c not in df.columns]
    tests = {}
    for c, rule in schema.items():
        if c not in df.columns:
            continue
        if not rule.get("nullable", True):
            tests[f"{c}\tnulls"] = F.count_if(_there(df, c).isNull())
        if "min" in rule:
            tests[f"{c}\tmin"] = F.count_if(F.col(c) < rule["min"])
        if "max" in rule:
            tests[f"{c}\tmax"] = F.count_if(F.col(c) > rule["max"])
        if "allowed" in rule:
            tests[f"{c}\tallowed"] = F.count_if(~F.col(c).isin(list(rule["allowed"])))
    absent = df.sparkSession.createDataFrame(missing, "column string, rule string, n long")
    if not tests:
        return absent
    counted = df.agg(*[v.alias(k) for k, v in tests.items()]).unpivot([], [f"`{k}`" for k in tests], "test", "n")
    broken = counted.where(F.col("n") > 0).select(
        F.split_part("test", F.lit("\t"), F.lit(1)).alias("column"), F.split_part("test", F.lit("\t"), F.lit(2)).alias("rule"), "n"
    )
    return broken.unionByName(absent)


def _outlier_scores(table: DataFrame) -> DataFrame:
    pct = F.round(F.try_divide(F.col("outlier_count") * 100.0, F.col("values")), 4)
    return table.withColumn("outlier_pct", pct).withColumn("quality_score_pct", F.round(100.0 - F.col("outlier_pct"), 2))


def zscore_outliers(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS, limit: float = 3.0) -> DataFrame:
    """Values with |z| above the limit (population std); columns with fewer than two values skipped."""
    columns = _present(df, columns)
    wide = df.agg(*[F.avg(known(c)).alias(f"{c}_m") for c in columns], *[F.stddev_pop(known(c)).alias(f"{c}_s") for c in columns])
    stats = Fixed(wide)
    cells = {}
    for c in columns:
        z = F.try_divide(known(c) - stats.getField(f"{c}_m"), stats.getField(f"{c}_s"))
        cells[c] = [F.count(known(c)), F.count_if(F.abs(z) > limit)]
    return _outlier_scores(_rows(df, cells, ["values", "outlier_count"]).where(F.col("values") >= 2))


def iqr_outliers(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS, k: float = 1.5,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Values outside the quartile fences, counted on the value-count table. Null % when all null."""
    columns = _present(df, columns)
    ranked = ranked_values(df, columns, rows_per_bucket=rows_per_bucket)
    fences = ranked.groupBy("column").agg(*quantile_columns({"q1": 0.25, "q3": 0.75})).select(
        "column", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_fence"),
    )
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    counted = (
        # one row per column on the right side
        ranked.join(F.broadcast(fences), "column")
        .groupBy("column", "q1", "q3", "iqr", "lower_fence", "upper_fence")
        .agg(F.sum("n").alias("values"), F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outlier_count"))
    )
    return _outlier_scores(counted)


def _shape_label(value, zero: str, positive: str, negative: str):
    return F.when(F.abs(value) < 0.5, zero).when(value > 0, positive).otherwise(negative)


def distribution(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS,
                 mean_bounds: Mapping[str, tuple[float, float]] = rules.MEAN_BOUNDS,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Moments, quartiles, mode, shape labels, mean bounds and a normality test per column.

    One pass for the moments, one for the value counts. The Kolmogorov-Smirnov statistic is read
    off the running counts, so no column is sorted by a single task.
    """
    columns = _present(df, columns)
    fields = ["mean", "std", "min", "max", "skewness", "kurtosis"]
    makers = [F.avg, F.stddev_samp, F.min, F.max, F.skewness, F.kurtosis]
    moments = _rows(df, {c: [make(known(c)) for make in makers] for c in columns}, fields)
    ranked = ranked_values(df, columns, rows_per_bucket=rows_per_bucket)
    # at most one row per column on the broadcast side
    placed = ranked.join(F.broadcast(moments), "column").where(F.col("total") >= 2)
    expected = normal_cdf((F.col("value") - F.col("mean")) / F.col("std"))
    gap = F.greatest(
        F.col("upto") / F.col("total") - expected, expected - (F.col("upto") - F.col("n")) / F.col("total")
    )
    table = placed.groupBy("column", *fields).agg(
        F.max("total").alias("values"), *quantile_columns(QUARTILES),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))["v"].alias("mode"),
        F.max(F.when(F.col("std") > 0, gap)).alias("ks_statistic"),
    )
    lo = F.element_at(F.create_map(*[F.lit(x) for c, b in mean_bounds.items() for x in (c, float(b[0]))]), F.col("column"))
    hi = F.element_at(F.create_map(*[F.lit(x) for c, b in mean_bounds.items() for x in (c, float(b[1]))]), F.col("column"))
    # one row per column goes through the exact distribution
    few = F.col("values") <= KS_EXACT_ROWS
    p_value = F.when(few, exact_ks_p_values()(F.when(few, F.col("ks_statistic")), F.col("values"))).otherwise(ks_p_value(F.col("ks_statistic"), F.col("values")))
    skew, kurt = F.col("skewness"), F.col("kurtosis")
    return table.select(
        "column", "values",
        *[F.round(c, 4).alias(c) for c in ("mean", "median", "mode", "std", "min", "max", "q1", "q3", "skewness")],
        _shape_label(skew, "Symmetric", "Positive Skew (right tail)", "Negative Skew (left tail)").alias("skewness_label"),
        F.round(kurt, 4).alias("kurtosis_excess"),
        _shape_label(kurt, "Mesokurtic (normal)", "Leptokurtic (heavy tails)", "Platykurtic (light tails)").alias("kurtosis_label"),
        F.coalesce(F.col("mean").between(lo, hi), F.lit(True)).alias("mean_in_bounds"),
        F.round("ks_statistic", 4).alias("ks_statistic"),
        F.round(p_value, 4).alias("ks_pvalue"),
        (p_value < 0.05).alias("rejects_normality"),
    )


KS_EXACT_ROWS = 10_000


def exact_ks_p_value(d: float, n: int) -> float:
    """P(D_n >= d) of the two-sided one-sample statistic, exact for every n.

    Marsaglia, Tsang and Wang (2003): with d = (k - h) / n the probability of a smaller statistic is n! / n^n times
    the middle entry of the n-th power of a matrix of 2k - 1 rows. Beyond n d^2 = 18 the value is below 1e-15 and counts as 0.
    """
    if n * d <= 0.5:
        return 1.0
    if d >= 1.0 or n * d * d > 18.0:
        return 0.0
    k = int(n * d) + 1
    h, m = k - n * d, 2 * k - 1
    inverse = 1.0 / np.cumprod(np.arange(1.0, m + 1))  # 1 / i!
    step = np.subtract.outer(np.arange(m), np.arange(m)) + 1
    matrix = np.where(step >= 0, np.where(step > 0, inverse[np.maximum(step, 1) - 1], 1.0), 0.0)
    powers = h ** np.arange(1.0, m + 1)
    matrix[:, 0] -= powers * inverse
    matrix[-1, :] -= (powers * inverse)[::-1]
    if 2 * h > 1:
        matrix[-1, 0] += (2 * h - 1) ** m * inverse[-1]
    out, exponent, factor, factor_exponent, left = np.eye(m), 0, matrix, 0, n
    while left:  # power by squaring, with the exponent of ten kept apart
        if left & 1:
            out, exponent = out @ factor, exponent + factor_exponent
            if abs(out[k - 1, k - 1]) > 1e140:
                out, exponent = out * 1e-140, exponent + 140
        left >>= 1
        if left:
            factor, factor_exponent = factor @ factor, 2 * factor_exponent
            if abs(factor[k - 1, k - 1]) > 1e140:
                factor, factor_exponent = factor * 1e-140, factor_exponent + 140
    if out[k - 1, k - 1] <= 0.0:  # smaller than any double
        return 1.0
    below = math.log(out[k - 1, k - 1]) + exponent * math.log(10.0) + math.lgamma(n + 1) - n * math.log(n)
    return min(1.0, max(0.0, 1.0 - math.exp(below)))


def exact_ks_p_values():
    """:func:`exact_ks_p_value` as a column function of statistic and row count; null where one is null."""

    @F.arrow_udf("double")
    def found(statistic: pa.Array, n: pa.Array) -> pa.Array:
        pairs = zip(statistic.to_pylist(), n.to_pylist())
        return pa.array([None if d is None or k is None else exact_ks_p_value(d, k) for d, k in pairs], pa.float64())

    return found


def ks_p_value(statistic, n):
    """Kolmogorov's series with the usual small-sample correction of the argument (Stephens 1970)."""
    root = F.sqrt(n.cast("double"))
    t = statistic * (root + F.lit(0.12) + F.lit(0.11) / root)
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * t * t) for k in range(1, 31)), F.lit(0.0))
    return F.when(t < 0.3, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def pearson_matrix(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS) -> DataFrame:
    """(col_a, col_b, r) over rows complete in all columns; one aggregation, symmetric pairs shared."""
    complete = df.select(*[known(c).alias(c) for c in columns]).dropna()
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = complete.agg(*[pearson(a, b).alias(f"{a}\t{b}") for a, b in pairs])
    return _pair_rows(row, pairs)


def _pair_rows(row: DataFrame, pairs) -> DataFrame:
    long = row.unpivot([], [f"`{a}\t{b}`" for a, b in pairs], "pair", "r")
    split = long.select(
        F.split_part("pair", F.lit("\t"), F.lit(1)).alias("col_a"), F.split_part("pair", F.lit("\t"), F.lit(2)).alias("col_b"),
        F.round("r", 4).alias("r"),
    )
    mirrored = split.where(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r"
    )
    return split.unionByName(mirrored)


def spearman_matrix(df: DataFrame, columns: Sequence[str] = rules.NUMERIC_COLUMNS,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rank correlation with average ranks for ties.

    Rows are first collapsed to distinct value combinations with a weight, so copies never travel
    one by one; each combination then picks up its ranks and one weighted aggregation finishes.
    """
    complete = df.select(*[known(c).alias(c) for c in columns]).dropna()
    ranks = average_ranks(complete, columns, rows_per_bucket).persist(StorageLevel.MEMORY_AND_DISK)
    combos = complete.groupBy(*columns).agg(F.count(F.lit(1)).alias("_w"))
    for c in columns:
        table = ranks.where(F.col("column") == c).select(F.col("value").alias(c), F.col("rank").alias(f"{c}_rank"))
        combos = attach(combos, table, [c])
    middle = (Fixed(complete.agg(F.count(F.lit(1)).alias("n"))).getField("n") + 1) / 2.0
    centred = combos.select("_w", *[(F.col(f"{c}_rank") - middle).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    dot = lambda a, b: F.sum(F.col("_w") * F.col(a) * F.col(b))
    row = centred.agg(*[
        F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))).alias(f"{a}\t{b}") for a, b in pairs
    ])
    return _pair_rows(row, pairs)


def correlation_bounds(matrix: DataFrame, expected=rules.EXPECTED_CORRELATIONS) -> DataFrame:
    """Expected pairs with their correlation; a missing or NaN value is out of bounds."""
    spark = matrix.sparkSession
    pairs = spark.createDataFrame(
        [(a, b, float(lo), float(hi)) for a, b, lo, hi in expected], "col_a string, col_b string, min_r double, max_r double"
    )
    joined = pairs.join(matrix, ["col_a", "col_b"], "left")
    inside = F.col("r").between(F.col("min_r"), F.col("max_r")) & ~F.isnan("r")
    return joined.withColumn("within_bounds", F.coalesce(inside, F.lit(False)))


def roll_up(reports: DataFrame) -> DataFrame:
    """Totals over report rows that carry a boolean ``passed``."""
    out = reports.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("passed")).alias("passed"))
    rate = F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(0.0))
    return out.select("total", "passed", (F.col("total") - F.col("passed")).alias("failed"), rate.alias("success_rate"))
