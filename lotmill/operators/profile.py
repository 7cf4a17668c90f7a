"""Descriptive tables: counts, shares, group statistics, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators.fixed import Fixed
from lotmill.functions.numeric import known, minmax, pearson
from lotmill.operators.lookups import attach
from lotmill.operators.order_stats import (
    QUARTILES, ROWS_PER_BUCKET, quantile_columns, quantile_row, quantiles, ranked_values,
)
from lotmill.operators.quality import _rows
from lotmill.session import kept


def counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of every non-null value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, column: str, of_all_rows: bool = False) -> DataFrame:
    """Counts with percentages of the non-null values (or of all rows)."""
    counted = counts(df, column)
    total = (df if of_all_rows else counted).agg(F.count(F.lit(1)) if of_all_rows else F.sum("n")).scalar()
    return counted.withColumn("pct", F.round(F.col("n") * 100.0 / total, 2))


def counts_within(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & F.col(group).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values (ties: smallest value)."""
    return counts(df, column).orderBy(F.desc("n"), column).limit(n)


def top_n_plus_other(counted: DataFrame, column: str, n: int) -> DataFrame:
    """The n largest counts; the rest is one ``Other`` row, present only when it is not zero."""
    head = counted.orderBy(F.desc("n"), column).limit(n)
    rest = counted.agg(F.sum("n").alias("all")).select(
        F.lit("Other").alias(column), (F.col("all") - F.coalesce(head.agg(F.sum("n")).scalar(), F.lit(0))).alias("n")
    ).where(F.col("n") > 0)
    return head.unionByName(rest)


def group_mean(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(column).alias("mean")).orderBy("mean", group)


def summary(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    fields = ["n", "mean", "std", "min", "max"]
    makers = [F.count, F.avg, F.stddev_samp, F.min, F.max]
    base = _rows(df, {c: [make(known(c)) for make in makers] for c in columns}, fields)
    quart = quantiles(df, columns, rows_per_bucket=rows_per_bucket).select("column", "q1", "median", "q3")
    return base.join(F.broadcast(quart), "column", "left")  # one row per column


def kpis(df: DataFrame, tier_column: str = "price_tier", top: str = "luxury") -> DataFrame:
    """Listing count, mean and median price, share of the top tier, mean mileage."""
    df = kept(df.select("price", tier_column, "kilometer"), "kpis")  # read by each step of the median and by the sums
    median = quantile_row(df, ["price"], {"median": 0.5}).getField("price_median")
    one = df.agg(
        F.count(F.lit(1)).alias("listings"), F.avg("price").alias("mean_price"),
        (F.count_if(F.col(tier_column) == top) * 100.0 / F.count(F.lit(1))).alias("luxury_share_pct"),
        F.avg("kilometer").alias("mean_km"),
    )
    return one.withColumn("median_price", median)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of row x column for a fixed column list, zero where absent."""
    kept = df.where(F.col(row).isNotNull())
    return kept.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def stacked_top(df: DataFrame, row: str, column: str, values: Sequence[str], n: int = 15) -> DataFrame:
    """Crosstab of the n rows with the largest total."""
    table = crosstab(df, row, column, values)
    total = sum((F.col(v) for v in values), F.lit(0))
    return table.withColumn("total", total).orderBy(F.desc("total"), row).limit(n)


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed on both sides."""
    value = known(column)
    ends = Fixed(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    width = (ends.getField("hi") - ends.getField("lo")) / F.lit(float(bins))
    position = F.coalesce(F.try_divide(value - ends.getField("lo"), width), F.lit(0.0))
    bin_no = F.least(F.floor(position), F.lit(bins - 1)).cast("int")
    counted = df.where(value.isNotNull()).groupBy(*by, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*by, "bin", (ends.getField("lo") + F.col("bin") * width).alias("bin_start"), "n")


def full_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """As :func:`histogram`, with empty bins as zero rows."""
    filled = histogram(df, column, bins).select("bin", "n")
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(filled), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame, group: str, column: str, k: float = 1.5, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the fences) and outlier count per group."""
    kept = df.where(F.col(group).isNotNull())
    ranked = ranked_values(kept, [column], by=[group], rows_per_bucket=rows_per_bucket)
    quart = ranked.groupBy(group).agg(*quantile_columns(QUARTILES))
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(lo, hi)
    return attach(ranked, quart, [group], "inner").groupBy(group, "q1", "median", "q3").agg(
        F.sum("n").alias("n"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def _scott(n: Column, std: Column, dims: int) -> Column:
    return std * F.pow(n.cast("double"), F.lit(-1.0 / (dims + 4)))


REACH = 9.0  # bandwidths beyond which the kernel (below 1.1e-18) counts as 0


def _as_columns(df: DataFrame, name: str, z: str, terms: int) -> DataFrame:
    """Adds ``name`` 0, 1, ...: the polynomials at ``z``, each step from the two columns before it."""
    df = df.withColumns({f"{name}0": F.lit(1.0), f"{name}1": F.col(z)})
    for j in range(2, terms):
        df = df.withColumn(f"{name}{j}", F.col(z) * F.col(f"{name}{j - 1}") - F.lit(float(j - 1)) * F.col(f"{name}{j - 2}"))
    return df


def _reached(start: Column, step: Column, centre: Column, points: int, reach: float) -> Column:
    """Numbers of the grid points within ``reach`` of a centre, none as null."""
    low = F.greatest(F.ceil((centre - reach - start) / step), F.lit(0)).cast("int")
    high = F.least(F.floor((centre + reach - start) / step), F.lit(points - 1)).cast("int")
    return F.when(low <= high, F.sequence(low, high))


def density(df: DataFrame, column: str, points: int = 200, cut: float = 3.0, cells: int = 4, terms: int = 12) -> DataFrame:
    """Gaussian kernel density on an even grid (Scott's bandwidth), over all rows.

    Rows are summed once into cells of 1 / ``cells`` bandwidths as ``terms`` moments about the cell's centre, and the cells, no
    longer the rows, meet the grid points within 9 bandwidths: the kernel around a row is the kernel around its centre times a
    series in the row's offset. The part of the series left out is below 2e-15 of the kernel's peak a row with the defaults
    (at most ``sum over j >= terms of (1 / (2 * cells))^j / sqrt(j!)``). Work is rows x terms + cells x points.
    """
    value = known(column)
    stats = Fixed(df.agg(
        F.count(value).alias("n"), F.stddev_samp(value).alias("s"), F.min(value).alias("lo"), F.max(value).alias("hi")
    ))
    n = stats.getField("n")
    bandwidth = F.nullif(_scott(n, stats.getField("s"), 1), F.lit(0.0))  # one value only: null densities
    lo = stats.getField("lo")
    reach = (stats.getField("hi") - lo) / bandwidth + 2 * cut
    step = reach / F.lit(float(points - 1))  # in bandwidths, as all below
    start = F.lit(-float(cut))
    rows = df.where(value.isNotNull()).select(((value - lo) / bandwidth).alias("_z"))
    rows = rows.select("_z", F.floor(F.col("_z") * cells).alias("cell"))
    offset = F.col("_z") - (F.col("cell") + 0.5) / F.lit(float(cells))
    moments = rows.groupBy("cell").agg(*[F.sum(F.pow(offset, F.lit(float(j)))).alias(f"m{j}") for j in range(terms)])
    centre = (F.col("cell") + 0.5) / F.lit(float(cells))
    met = moments.withColumn("point", F.explode(_reached(start, step, centre, points, REACH)))
    met = _as_columns(met.withColumn("z", start + F.col("point") * step - centre), "he", "z", terms)
    series = sum((F.col(f"he{j}") * F.col(f"m{j}") / F.lit(float(math.factorial(j))) for j in range(1, terms)), F.col("m0"))
    weight = F.exp(-F.col("z") * F.col("z") / 2) / F.lit(math.sqrt(2 * math.pi)) * series
    summed = met.groupBy("point").agg(F.sum(weight).alias("_w"))
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    placed = every.join(F.broadcast(summed), "point", "left")  # at most ``points`` rows
    grid = lo + (start + F.col("point") * step) * bandwidth
    return placed.select("point", grid.alias("x"), F.try_divide(F.coalesce("_w", F.lit(0.0)), n * bandwidth).alias("density")).where(n > 0)


def density_2d(df: DataFrame, x: str, y: str, points: int = 30, cut: float = 3.0, cells: int = 8, terms: int = 8) -> DataFrame:
    """Two-dimensional kernel density on a points x points grid with the full covariance matrix.

    As :func:`density`, in coordinates that turn the kernel into a round one; moments go up to total degree ``terms`` - 1.
    The series leaves out less than 1e-10 of the kernel's peak a row with the defaults.
    """
    kept = df.select(known(x).alias("_x"), known(y).alias("_y")).dropna()
    s = Fixed(kept.agg(
        F.count(F.lit(1)).alias("n"), F.var_samp("_x").alias("xx"), F.var_samp("_y").alias("yy"), F.covar_samp("_x", "_y").alias("xy"),
        F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"),
    ))
    get = s.getField
    shrink = F.pow(F.nullif(get("n"), F.lit(0)).cast("double"), F.lit(-1.0 / 3.0))  # squared Scott factor for two dimensions
    a, b, c = F.nullif(get("xx") * shrink, F.lit(0.0)), get("xy") * shrink, get("yy") * shrink
    det = a * c - b * b
    det = F.when(det > 0, det)  # values on one line: null densities
    x_start, y_start = get("x0") - cut * F.sqrt(a), get("y0") - cut * F.sqrt(c)
    x_step = (get("x1") - get("x0") + 2 * cut * F.sqrt(a)) / F.lit(float(points - 1))
    y_step = (get("y1") - get("y0") + 2 * cut * F.sqrt(c)) / F.lit(float(points - 1))
    # u and v have the unit matrix as covariance: u from x alone, v from what x leaves of y
    to_u = lambda px: (px - get("x0")) / F.sqrt(a)
    to_v = lambda px, py: (py - get("y0") - b / a * (px - get("x0"))) / F.sqrt(det / a)
    rows = kept.select(to_u(F.col("_x")).alias("u"), to_v(F.col("_x"), F.col("_y")).alias("v"))
    rows = rows.select("u", "v", F.floor(F.col("u") * cells).alias("i"), F.floor(F.col("v") * cells).alias("j"))
    middle = lambda k: (F.col(k) + 0.5) / F.lit(float(cells))
    degrees = [(p, q) for p in range(terms) for q in range(terms - p)]
    power = lambda k, at, p: F.pow(F.col(k) - middle(at), F.lit(float(p)))
    moments = rows.groupBy("i", "j").agg(*[F.sum(power("u", "i", p) * power("v", "j", q)).alias(f"m{p}_{q}") for p, q in degrees])
    met = moments.withColumn("ix", F.explode(_reached(to_u(x_start), x_step / F.sqrt(a), middle("i"), points, REACH)))
    px = x_start + F.col("ix") * x_step
    met = met.withColumn("du", to_u(px) - middle("i"))
    met = met.withColumn("iy", F.explode(_reached(to_v(px, y_start), y_step / F.sqrt(det / a), middle("j"), points, REACH)))
    met = met.withColumn("dv", to_v(px, y_start + F.col("iy") * y_step) - middle("j"))
    met = _as_columns(_as_columns(met, "hu", "du", terms), "hv", "dv", terms)
    series = sum((F.col(f"hu{p}") * F.col(f"hv{q}") * F.col(f"m{p}_{q}") / F.lit(float(math.factorial(p) * math.factorial(q))) for p, q in degrees[1:]), F.col("m0_0"))
    weight = F.exp(-(F.col("du") * F.col("du") + F.col("dv") * F.col("dv")) / 2) * series
    summed = met.groupBy("ix", "iy").agg(F.sum(weight).alias("_w"))
    every = df.sparkSession.range(points * points).select(F.floor(F.col("id") / points).cast("int").alias("ix"), (F.col("id") % points).cast("int").alias("iy"))
    placed = every.join(F.broadcast(summed), ["ix", "iy"], "left").where(get("n") > 0)  # at most points x points rows
    scale = get("n") * F.lit(2 * math.pi) * F.sqrt(det)
    return placed.select("ix", "iy", (x_start + F.col("ix") * x_step).alias("x"), (y_start + F.col("iy") * y_step).alias("y"),
                         (F.coalesce("_w", F.lit(0.0)) / scale).alias("density"))


def linear_fit(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), pearson(x, y).alias("r"))


def normalise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min-max scale columns to 0..1 (constant columns become null)."""
    wide = df.agg(*[F.min(c).alias(f"{c}_lo") for c in columns], *[F.max(c).alias(f"{c}_hi") for c in columns])
    ends = Fixed(wide)
    return df.withColumns({
        c: minmax(F.col(c).cast("double"), ends.getField(f"{c}_lo"), ends.getField(f"{c}_hi")) for c in columns
    })


def adjusted_skew(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness per column."""
    base = _rows(df, {c: [F.count(known(c)).cast("double"), F.skewness(known(c))] for c in columns}, ["n", "g"])
    n = F.col("n")
    return base.select("column", F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("g")).alias("skew"))


def outlier_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the rows outside the quartile fences and beyond three sample deviations, with % of all rows."""
    wide = df.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_samp(c).alias(f"{c}_s") for c in columns])
    stats = Fixed(wide)
    fences = quantile_row(df, columns, {"q1": 0.25, "q3": 0.75})
    cells = {}
    for c in columns:
        q1, q3 = fences.getField(f"{c}_q1"), fences.getField(f"{c}_q3")
        z = F.try_divide(F.col(c) - stats.getField(f"{c}_m"), stats.getField(f"{c}_s"))
        cells[c] = [
            F.count(F.lit(1)),
            F.count_if((F.col(c) < q1 - 1.5 * (q3 - q1)) | (F.col(c) > q3 + 1.5 * (q3 - q1))),
            F.count_if(F.abs(z) > 3.0),
        ]
    out = _rows(df, cells, ["rows", "iqr_outliers", "z_outliers"])
    pct = lambda c: F.round(F.try_divide(F.col(c) * 100.0, F.col("rows")), 2)
    return out.select("column", "iqr_outliers", pct("iqr_outliers").alias("iqr_pct"), "z_outliers", pct("z_outliers").alias("z_pct"))


def month_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per 'year - month' of a timestamp (text that does not parse is left out)."""
    ts = F.try_to_timestamp(F.col(column).cast("string"))
    label = F.concat(F.year(ts).cast("string"), F.lit(" - "), F.month(ts).cast("string"))
    return df.select(label.alias("month")).where(F.col("month").isNotNull()).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def tier_profile(df: DataFrame, columns: Sequence[str] = ("price", "power", "kilometer", "yearOfRegistration"),
                 group: str = "price_tier") -> DataFrame:
    """Median of each column per group."""
    kept = df.where(F.col(group).isNotNull())
    medians = quantiles(kept, columns, {"median": 0.5}, by=[group])
    return medians.groupBy(group).agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"median_{c}") for c in columns])


def cardinalities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column; values are deduplicated before they are counted."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.dataType.typeName() in _NUMERIC) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, is_numeric boolean")


_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName().split("(")[0] in _NUMERIC]


def other_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def eda_tables(df: DataFrame, price: str = "price", tier: str = "price_tier", scatter: Sequence[str] = ("kilometer", "price"),
               bins: int = 50, sample: int = 1000, seed: int = 42) -> dict[str, DataFrame]:
    """The tables behind an overview: price histogram (empty bins included), tier counts with shares, and ``sample`` points
    of complete rows (all of them, if fewer)."""
    from lotmill.operators.sampling import sample_rows

    df = kept(df.select(*dict.fromkeys([price, tier, *scatter])), "overview")  # each table reads it several times
    points = df.select(*scatter, tier).dropna()
    return {"histogram": full_histogram(df, price, bins), "tiers": shares(df, tier), "scatter": sample_rows(points, sample, seed)}
