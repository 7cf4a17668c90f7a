"""Quality checks (family A, first part) over the listing table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators import order_stats, quality
from lotmill.workload.listings import LISTING, listings, with_listings
from lotmill.workload.registry import query

_NUM = rules.NUMERIC_COLUMNS


def _each(template: str, columns=_NUM) -> str:
    """One SELECT per column, combined; {c} is the quoted column, {n} its name."""
    return " UNION ALL ".join(template.replace("{c}", f'"{c}"').replace("{n}", c) for c in columns)


def numbers(spark, sf):
    return listings(spark, sf, *_NUM)


@query("a1_schema_check", with_listings("""SELECT * FROM (VALUES ('missing', 'seller', 'string', CAST(NULL AS VARCHAR), true, CAST(NULL AS BIGINT)), ('extra', 'extra', NULL, 'int', false, NULL)) t(kind, "column", expected, actual, fails, bad_values)
UNION ALL SELECT 'type', 'power', 'double', 'string', true, count(*) FROM listings WHERE "fuelType" = 'building'"""))
def a1(spark, sf):
    """A table without the seller, with an extra column, and with power as text that is not always a number."""
    text = F.when(F.col("fuelType") == "building", "n/a").otherwise(F.col("power").cast("string"))
    return quality.schema_findings(listings(spark, sf).drop("seller").withColumns({"extra": F.lit(1), "power": text}))


@query("a2_completeness", with_listings(_each("""SELECT '{n}' AS "column", count(*) FILTER ({c} IS NULL) AS missing_count, round(count(*) FILTER ({c} IS NULL) * 1.0e0 / count(*) * 100, 4) AS missing_pct, ('{n}' <> 'brand' AND count(*) FILTER ({c} IS NULL) * 1.0e0 / count(*) > 0.05) AS failed FROM listings""", LISTING)))
def a2(spark, sf):
    return quality.completeness(listings(spark, sf))


@query("a3_completeness_score", with_listings("SELECT round((" + " + ".join(f'count("{c}")' for c in LISTING) + ") * 100.0e0 / (count(*) * 12), 2) AS completeness_score_pct FROM listings"))
def a3(spark, sf):
    return quality.completeness_score(listings(spark, sf))


_BOUNDS = rules.RANGE_RULES


@query("a5_range_checks", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count("{c}") AS values, count(*) FILTER ("{c}" < {lo}) AS below_min, count(*) FILTER ("{c}" > {hi}) AS above_max, round(count(*) FILTER ("{c}" BETWEEN {lo} AND {hi}) * 100.0e0 / count("{c}"), 2) AS accuracy_score_pct FROM listings""" for c, (lo, hi) in _BOUNDS.items())))
def a5(spark, sf):
    return quality.range_checks(numbers(spark, sf))


@query("a6_category_checks", with_listings(" UNION ".join(f"""SELECT '{c}' AS "column", lower("{c}") AS invalid_value FROM listings WHERE lower("{c}") NOT IN ({', '.join(repr(v) for v in allowed)})""" for c, allowed in rules.CATEGORY_RULES.items())))
def a6(spark, sf):
    return quality.category_checks(listings(spark, sf, *rules.CATEGORY_RULES))


@query("a7_zscore_outliers", with_listings(_each("""SELECT '{n}' AS "column", count(*) AS values, count(*) FILTER (abs(z) > 3) AS outlier_count, round(count(*) FILTER (abs(z) > 3) * 100.0e0 / count(*), 4) AS outlier_pct, round(100.0e0 - round(count(*) FILTER (abs(z) > 3) * 100.0e0 / count(*), 4), 2) AS quality_score_pct
FROM (SELECT ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z FROM listings)""")))
def a7(spark, sf):
    return quality.zscore_outliers(numbers(spark, sf))


@query("a8_iqr_outliers", with_listings(_each("""SELECT '{n}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(q1 - 1.5e0 * (q3 - q1), 4) AS lower_fence, round(q3 + 1.5e0 * (q3 - q1), 4) AS upper_fence, count(*) AS values,
 count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS outlier_count, round(count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) * 100.0e0 / count(*), 4) AS outlier_pct,
 round(100.0e0 - round(count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) * 100.0e0 / count(*), 4), 2) AS quality_score_pct
FROM listings, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM listings) GROUP BY q1, q3""")))
def a8(spark, sf):
    out = quality.iqr_outliers(numbers(spark, sf))
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "q3", "iqr", "lower_fence", "upper_fence")})


# moments in the biased form, written out because the SQL engine's own functions are bias-corrected
_MOMENTS = """(SELECT '{n}' AS "column", count({c}) AS values, avg({c}) AS mean, median({c}) AS median, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
 avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5e0) AS skew, avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3 AS kurt,
 (SELECT CAST({c} AS DOUBLE) FROM listings GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM listings, (SELECT avg({c}) AS m FROM listings))"""


@query("a10_distribution_profile", with_listings(_each("""SELECT "column", values, round(mean, 4) AS mean, round(median, 4) AS median, round(mode, 4) AS mode, round(std, 4) AS std, round(min, 4) AS min, round(max, 4) AS max, round(q1, 4) AS q1, round(q3, 4) AS q3 FROM """ + _MOMENTS)))
def a10(spark, sf):
    return quality.distribution(numbers(spark, sf)).select("column", "values", "mean", "median", "mode", "std", "min", "max", "q1", "q3")


@query("a11_shape", with_listings(_each("""SELECT "column", round(skew, 4) AS skewness, CASE WHEN abs(skew) < 0.5 THEN 'Symmetric' WHEN skew > 0 THEN 'Positive Skew (right tail)' ELSE 'Negative Skew (left tail)' END AS skewness_label, round(kurt, 4) AS kurtosis_excess,
 CASE WHEN abs(kurt) < 0.5 THEN 'Mesokurtic (normal)' WHEN kurt > 0 THEN 'Leptokurtic (heavy tails)' ELSE 'Platykurtic (light tails)' END AS kurtosis_label FROM """ + _MOMENTS)))
def a11(spark, sf):
    return quality.distribution(numbers(spark, sf)).select("column", "skewness", "skewness_label", "kurtosis_excess", "kurtosis_label")


@query("a12_mean_bounds", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS "column", avg("{c}") BETWEEN {lo} AND {hi} AS mean_in_bounds FROM listings""" for c, (lo, hi) in rules.MEAN_BOUNDS.items())))
def a12(spark, sf):
    return quality.distribution(numbers(spark, sf)).select("column", "mean_in_bounds")


def _cdf_sql(z: str) -> str:
    """The published approximation of functions.numeric.normal_cdf as SQL."""
    upper = ["3.52624965998911e-02", "0.700383064443688e0", "6.37396220353165e0", "33.912866078383e0", "112.079291497871e0", "221.213596169931e0", "220.206867912376e0"]
    lower = ["8.83883476483184e-02", "1.75566716318264e0", "16.064177579207e0", "86.7807322029461e0", "296.564248779674e0", "637.333633378831e0", "793.826512519948e0", "440.413735824752e0"]
    x = f"least(abs({z}), 37.0e0)"

    def poly(ks):
        return " + ".join(f"{k} * power({x}, {len(ks) - 1 - i})" for i, k in enumerate(ks))

    bell = f"exp(-{x} * {x} / 2)"
    fraction = f"({x} + 1.0e0 / ({x} + 2.0e0 / ({x} + 3.0e0 / ({x} + 4.0e0 / ({x} + 0.65e0)))))"
    tail = f"CASE WHEN {x} < 7.07106781186547e0 THEN {bell} * ({poly(upper)}) / ({poly(lower)}) ELSE {bell} / {fraction} / 2.506628274631e0 END"
    return f"CASE WHEN {z} > 0 THEN 1.0e0 - ({tail}) ELSE ({tail}) END"


@query("a13_normality_test", with_listings(_each(f"""SELECT '{{n}}' AS "column", round(d, 4) AS ks_statistic, round(p, 4) AS ks_pvalue, p < 0.05 AS rejects_normality FROM (SELECT d, least(1.0e0, greatest(0.0e0, 2 * list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0e0 * i * i * t * t))))) AS p
FROM (SELECT d, d * (sqrt(n) + 0.12e0 + 0.11e0 / sqrt(n)) AS t FROM (SELECT max(total) AS n, max(greatest(upto * 1.0e0 / total - cdf, cdf - (upto - k) * 1.0e0 / total)) AS d
FROM (SELECT upto, k, total, {_cdf_sql('z')} AS cdf FROM (SELECT v, count(*) AS k, sum(count(*)) OVER (ORDER BY v) AS upto, sum(count(*)) OVER () AS total, any_value((v - m) / s) AS z
FROM (SELECT {{c}} AS v FROM listings), (SELECT avg({{c}}) AS m, stddev_samp({{c}}) AS s FROM listings) GROUP BY v)))))""")))
def a13(spark, sf):
    return quality.distribution(numbers(spark, sf)).select("column", "ks_statistic", "ks_pvalue", "rejects_normality")


@query("a14_pearson_matrix", with_listings(" UNION ALL ".join(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr("{a}", "{b}"), 4) AS r FROM listings""" for a in _NUM for b in _NUM)))
def a14(spark, sf):
    return quality.pearson_matrix(numbers(spark, sf))


_RANKED = "ranked AS (SELECT " + ", ".join(f'rank() OVER (ORDER BY "{c}") + (count(*) OVER (PARTITION BY "{c}") - 1) / 2.0e0 AS "{c}"' for c in _NUM) + " FROM listings)"


@query("a15_spearman_matrix", with_listings(" UNION ALL ".join(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr("{a}", "{b}"), 4) AS r FROM ranked""" for a in _NUM for b in _NUM), _RANKED))
def a15(spark, sf):
    return quality.spearman_matrix(numbers(spark, sf))


@query("a16_correlation_bounds", with_listings(" UNION ALL ".join(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {lo}e0 AS min_r, {hi}e0 AS max_r, round(corr("{a}", "{b}"), 4) AS r, round(corr("{a}", "{b}"), 4) BETWEEN {lo} AND {hi} AS within_bounds FROM ranked""" for a, b, lo, hi in rules.EXPECTED_CORRELATIONS), _RANKED))
def a16(spark, sf):
    return quality.correlation_bounds(quality.spearman_matrix(numbers(spark, sf)))


@query("a17_report_roll_up", with_listings("""SELECT total, passed, total - passed AS failed, passed * 100.0e0 / total AS success_rate FROM (SELECT count(*) AS total, count(*) FILTER (ok) AS passed FROM (""" + " UNION ALL ".join(f"""SELECT count(*) FILTER ("{c}" NOT BETWEEN {lo} AND {hi}) = 0 AS ok FROM listings""" for c, (lo, hi) in _BOUNDS.items()) + "))"))
def a17(spark, sf):
    checks = quality.range_checks(numbers(spark, sf))
    return quality.roll_up(checks.select(((F.col("below_min") == 0) & (F.col("above_max") == 0)).alias("passed")))


@query("w3_average_ranks", with_listings("""SELECT DISTINCT 'power' AS "column", CAST(power AS DOUBLE) AS value, rank() OVER (ORDER BY power) + (count(*) OVER (PARTITION BY power) - 1) / 2.0e0 AS rank FROM listings
UNION ALL SELECT DISTINCT 'price', price, rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2.0e0 FROM listings"""))
def w3(spark, sf):
    return order_stats.average_ranks(listings(spark, sf, "power", "price"), ["power", "price"])


@query("a37_missing_summary", with_listings("""SELECT 'vehicleType' AS "column", count(*) AS missing_count, round(count(*) * 100.0e0 / (SELECT count(*) FROM listings), 2) AS missing_pct FROM listings WHERE "vehicleType" IS NULL"""))
def a37(spark, sf):
    return quality.missing_summary(listings(spark, sf))
