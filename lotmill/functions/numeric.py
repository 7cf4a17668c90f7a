"""Numeric coercion, banding and arithmetic features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.text import _col, fold, literal_map


def to_number(c: Column | str) -> Column:
    """Double, with null for text that is not a number."""
    return _col(c).try_cast("double")


def to_integer(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def known(c: Column | str) -> Column:
    """NaN and null are both 'missing'; returns a double with null for either."""
    value = _col(c).cast("double")
    return F.when(~F.isnan(value), value)


def tier(c: Column | str, bounds: Sequence[float] = rules.TIER_BOUNDS, labels: Sequence[str] = rules.TIERS) -> Column:
    """Band by exclusive upper bounds. Missing prices fall through to the last label."""
    value = _col(c)
    banded = F.when(value < bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:]):
        banded = banded.when(value < bound, label)
    return banded.otherwise(labels[len(bounds)])


def tier_code(c: Column | str, codes: Mapping[str, int] = rules.TIER_CODES) -> Column:
    """Label -> integer code; unmapped -> null."""
    return F.element_at(literal_map(codes), F.lower(_col(c).cast("string")))


def tier_label(c: Column | str, codes: Mapping[str, int] = rules.TIER_CODES, default: str = "unknown") -> Column:
    names = {code: label for label, code in codes.items()}
    return F.coalesce(F.element_at(literal_map(names), _col(c).cast("int")), F.lit(default))


def right_closed_band(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Interval ``(edges[i], edges[i+1]]`` -> ``labels[i]``; outside all intervals -> null."""
    value = _col(c)
    banded = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        inside = value > F.lit(float(lo))
        if hi != float("inf"):
            inside = inside & (value <= F.lit(float(hi)))
        banded = F.when(inside, label) if banded is None else banded.when(inside, label)
    return banded


def ordered_category(c: Column | str, order: Sequence[str], other: str | None = "Unknown") -> Column:
    """Folded category; values outside ``order`` become ``other`` (or null)."""
    value = fold(c)
    return F.when(value.isin(list(order)), value).otherwise(F.lit(other))


def category_rank(c: Column | str, order: Sequence[str]) -> Column:
    """Position in ``order``, for sorting; unlisted values sort last."""
    return F.coalesce(F.element_at(literal_map({v: i for i, v in enumerate(order)}), _col(c)), F.lit(len(order)))


def cpi_price(price: Column | str, year: Column | str, index: Mapping[int, float] = rules.CPI_USED_CARS,
              base_year: int = rules.CPI_BASE_YEAR) -> Column:
    """Restate a price in base-year money; a year outside the index is an error."""
    factors = {y: index[base_year] / level for y, level in index.items()}
    year = _col(year).cast("int")
    missing = F.raise_error(F.concat(F.lit("No CPI entry for year "), F.coalesce(year.cast("string"), F.lit("null"))))
    return _col(price) * F.coalesce(F.element_at(literal_map(factors), year), missing.cast("double"))


def vehicle_age(year: Column | str, current_year: int) -> Column:
    return F.lit(current_year) - to_integer(year)


def per_unit(amount: Column | str, units: Column) -> Column:
    """``amount / (units + 1)``; null instead of an error when the divisor is zero."""
    return F.try_divide(to_number(amount), units.cast("double") + F.lit(1.0))


def half_even(c: Column | str, digits: int) -> Column:
    return F.bround(_col(c), digits)


def minmax(c: Column, lo: Column, hi: Column, flat: float | None = None) -> Column:
    """Scale to 0..1; a constant column gives ``flat``."""
    return F.when(hi > lo, (c - lo) / (hi - lo)).otherwise(F.lit(flat).cast("double"))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation aggregate over pairs; null for a constant side, where ``corr`` divides by zero in ANSI mode."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(both_x, both_y), F.stddev_pop(both_x) * F.stddev_pop(both_y))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function in double precision.

    Rational approximation of Hart (1968) in the form published by West,
    "Better approximations to cumulative normal functions" (2005).
    """
    # Coefficients of the published approximation, highest power first.
    upper = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376]
    lower = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
             296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
    x = F.least(F.abs(z), F.lit(37.0))
    bell = F.exp(-x * x / 2)

    def horner(coefficients):
        total = F.lit(coefficients[0])
        for k in coefficients[1:]:
            total = total * x + F.lit(k)
        return total

    fraction = x + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        fraction = x + F.lit(k) / fraction
    tail = F.when(x < 7.07106781186547, bell * horner(upper) / horner(lower)).otherwise(bell / fraction / F.lit(2.506628274631))
    return F.when(z > 0, F.lit(1.0) - tail).otherwise(tail)
