"""Descriptive tables (family A, second part), sorts and limits, shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators import lookups, profile
from lotmill.workload.cleaning import cleaned_ctes, cleaned_listings
from lotmill.workload.listings import listings, table, with_listings
from lotmill.workload.registry import query

_NUM = rules.NUMERIC_COLUMNS
_TIERS = list(rules.TIERS)


@query("a21_value_counts", with_listings('SELECT "vehicleType", count(*) AS n, round(count(*) * 100.0e0 / sum(count(*)) OVER (), 2) AS pct FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY 1'))
def a21(spark, sf):
    return profile.shares(listings(spark, sf, "vehicleType"), "vehicleType")


@query("a21_counts_per_brand", with_listings('SELECT brand, "vehicleType", count(*) AS n FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY 1, 2'))
def a21b(spark, sf):
    return profile.counts_within(listings(spark, sf, "brand", "vehicleType"), "brand", "vehicleType")


@query("a21_event_type_counts", "SELECT event_type, count(*) AS n, round(count(*) * 100.0e0 / sum(count(*)) OVER (), 2) AS pct FROM events GROUP BY 1")
def a21c(spark, sf):
    return profile.shares(table(spark, sf, "events"), "event_type")


@query("a22_group_mean", with_listings('SELECT "fuelType", round(avg(power), 6) AS mean FROM listings GROUP BY 1'))
def a22(spark, sf):
    return profile.group_mean(listings(spark, sf, "fuelType", "power"), "fuelType", "power").withColumn("mean", F.round("mean", 6))


@query("a24_crosstab", with_listings("""SELECT "vehicleType", count(*) FILTER (price_tier = 'budget') AS budget, count(*) FILTER (price_tier = 'mid-range') AS "mid-range", count(*) FILTER (price_tier = 'luxury') AS luxury FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY 1"""))
def a24(spark, sf):
    return profile.crosstab(listings(spark, sf, "vehicleType", "price_tier"), "vehicleType", "price_tier", _TIERS)


@query("a25_stacked_top_brands", with_listings("""SELECT brand, count(*) FILTER (price_tier = 'budget') AS budget, count(*) FILTER (price_tier = 'mid-range') AS "mid-range", count(*) FILTER (price_tier = 'luxury') AS luxury, count(*) AS total FROM listings GROUP BY 1 ORDER BY total DESC, brand LIMIT 15"""))
def a25(spark, sf):
    return profile.stacked_top(listings(spark, sf, "brand", "price_tier"), "brand", "price_tier", _TIERS, 15)


@query("a26_kpis", with_listings("""SELECT count(*) AS listings, round(avg(price), 4) AS mean_price, round(count(*) FILTER (price_tier = 'luxury') * 100.0e0 / count(*), 4) AS luxury_share_pct, round(avg(kilometer), 4) AS mean_km, round(median(price), 4) AS median_price FROM cleaned""", *cleaned_ctes()))
def a26(spark, sf):
    out = profile.kpis(cleaned_listings(spark, sf))
    return out.select("listings", *[F.round(c, 4).alias(c) for c in ("mean_price", "luxury_share_pct", "mean_km", "median_price")])


def _describe(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count("{c}") AS n, round(avg("{c}"), 4) AS mean, round(stddev_samp("{c}"), 4) AS std, CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max, round(quantile_cont("{c}", 0.25), 4) AS q1, round(median("{c}"), 4) AS median, round(quantile_cont("{c}", 0.75), 4) AS q3 FROM listings"""


@query("a27_describe", with_listings(" UNION ALL ".join(map(_describe, _NUM))))
def a27(spark, sf):
    out = profile.summary(listings(spark, sf, *_NUM), _NUM)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q1", "median", "q3")})


@query("a28_distinct_values", with_listings('SELECT DISTINCT model FROM listings'))
def a28(spark, sf):
    return listings(spark, sf, "model").distinct()


@query("a29_top_n_plus_other", with_listings("""SELECT CASE WHEN rn <= 10 THEN brand ELSE 'Other' END AS brand, CAST(sum(n) AS BIGINT) AS n FROM (SELECT brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, brand) AS rn FROM listings GROUP BY 1) GROUP BY 1"""))
def a29(spark, sf):
    return profile.top_n_plus_other(profile.counts(listings(spark, sf, "brand"), "brand"), "brand", 10)


_BIN = "CAST(least(floor(({c} - lo) / ((hi - lo) / {k}.0e0)), {k1}) AS INTEGER)"


@query("a30_histogram", with_listings("SELECT bin, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) LEFT JOIN (SELECT " + _BIN.format(c="price", k=50, k1=49) + " AS bin, count(*) AS n FROM listings, (SELECT min(price) AS lo, max(price) AS hi FROM listings) GROUP BY 1) USING (bin)"))
def a30(spark, sf):
    return profile.full_histogram(listings(spark, sf, "price"), "price", 50)


@query("a30_histogram_by_tier", with_listings("SELECT price_tier, " + _BIN.format(c="kilometer", k=40, k1=39) + " AS bin, count(*) AS n FROM listings, (SELECT min(kilometer) AS lo, max(kilometer) AS hi FROM listings) GROUP BY 1, 2"))
def a30b(spark, sf):
    return profile.histogram(listings(spark, sf, "kilometer", "price_tier"), "kilometer", 40, ["price_tier"]).select("price_tier", "bin", "n")


_BOX = """SELECT g AS "{g}", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, count(*) AS n, round(min(v) FILTER (v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)), 4) AS whisker_low,
 round(max(v) FILTER (v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)), 4) AS whisker_high, count(*) FILTER (v NOT BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
FROM (SELECT "{g}" AS g, {v} AS v FROM listings WHERE "{g}" IS NOT NULL) JOIN (SELECT "{g}" AS g, quantile_cont({v}, 0.25) AS q1, median({v}) AS median, quantile_cont({v}, 0.75) AS q3 FROM listings GROUP BY 1) USING (g) GROUP BY g, q1, median, q3"""


def _box(df, group, column):
    out = profile.box_stats(df, group, column)
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("a31_box_stats_by_vehicle", with_listings(_BOX.format(g="vehicleType", v="log10(price)")))
def a31(spark, sf):
    rows = listings(spark, sf, "vehicleType", "price").select("vehicleType", F.log10("price").alias("log_price"))
    return _box(rows, "vehicleType", "log_price")


@query("a31_box_stats_by_tier", with_listings(_BOX.format(g="price_tier", v="kilometer")))
def a31b(spark, sf):
    return _box(listings(spark, sf, "price_tier", "kilometer"), "price_tier", "kilometer")


@query("a32_density", """WITH d AS (SELECT value AS x FROM events), s AS (SELECT count(*) AS n, stddev_samp(x) * power(count(*), -0.2e0) AS h, min(x) AS lo, max(x) AS hi FROM d), g AS (SELECT CAST(range AS INTEGER) AS point FROM range(60))
SELECT point, round(lo - 3 * h + point * ((hi - lo + 6 * h) / 59.0e0), 6) AS x, round(sum(exp(-power((lo - 3 * h + point * ((hi - lo + 6 * h) / 59.0e0) - d.x) / h, 2) / 2) / sqrt(2 * pi())) / (n * h), 8) AS density FROM d, s, g GROUP BY point, lo, hi, h, n""")
def a32(spark, sf):
    out = profile.density(table(spark, sf, "events"), "value", points=60)
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("a32_density_2d", """WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS x, CAST(length(lang) + doc_id % 7 AS DOUBLE) AS y FROM documents),
s AS (SELECT *, a * c - b * b AS det FROM (SELECT count(*) AS n, var_samp(x) * power(count(*), -1.0e0 / 3) AS a, covar_samp(x, y) * power(count(*), -1.0e0 / 3) AS b, var_samp(y) * power(count(*), -1.0e0 / 3) AS c, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM d)),
g AS (SELECT CAST(i.range AS INTEGER) AS ix, CAST(j.range AS INTEGER) AS iy FROM range(12) i, range(12) j),
p AS (SELECT g.*, s.*, x0 - 3 * sqrt(a) + ix * ((x1 - x0 + 6 * sqrt(a)) / 11.0e0) AS gx, y0 - 3 * sqrt(c) + iy * ((y1 - y0 + 6 * sqrt(c)) / 11.0e0) AS gy FROM g, s)
SELECT ix, iy, round(sum(exp(-(c * power(gx - d.x, 2) - 2 * b * (gx - d.x) * (gy - d.y) + a * power(gy - d.y, 2)) / det / 2)) / any_value(n * 2 * pi() * sqrt(det)) * 1000, 8) AS density FROM p, d GROUP BY ix, iy""")
def a32b(spark, sf):
    docs = table(spark, sf, "documents").select("n_chars", (F.length("lang") + F.col("doc_id") % 7).alias("y"))
    return profile.density_2d(docs, "n_chars", "y", points=12).select("ix", "iy", F.round(F.col("density") * 1000, 8).alias("density"))


@query("a33_linear_fit", with_listings("SELECT round(regr_slope(power, ln(price)), 6) AS slope, round(regr_intercept(power, ln(price)), 5) AS intercept, round(corr(ln(price), power), 6) AS r FROM listings"))
def a33(spark, sf):
    fit = profile.linear_fit(listings(spark, sf, "price", "power"), F.log("price"), "power")
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("r", 6).alias("r"))


@query("a34_min_max_scaled", with_listings("SELECT l_orderkey, l_partkey, round((price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()), 6) AS price, round((power - min(power) OVER ()) / (max(power) OVER () - min(power) OVER ()), 6) AS power FROM listings"))
def a34(spark, sf):
    out = profile.normalise(listings(spark, sf, "l_orderkey", "l_partkey", "price", "power"), ["price", "power"])
    return out.withColumns({"price": F.round("price", 6), "power": F.round("power", 6)})


@query("a35_adjusted_skew", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS "column", round(skewness("{c}"), 6) AS skew FROM listings""" for c in _NUM)))
def a35(spark, sf):
    return profile.adjusted_skew(listings(spark, sf, *_NUM), _NUM).withColumn("skew", F.round("skew", 6))


@query("a36_outlier_summary", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS "column", i AS iqr_outliers, round(i * 100.0e0 / t, 2) AS iqr_pct, z AS z_outliers, round(z * 100.0e0 / t, 2) AS z_pct FROM (SELECT count(*) AS t, count(*) FILTER ("{c}" < q1 - 1.5e0 * (q3 - q1) OR "{c}" > q3 + 1.5e0 * (q3 - q1)) AS i, count(*) FILTER (abs(("{c}" - m) / s) > 3) AS z
FROM listings, (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.75) AS q3, avg("{c}") AS m, stddev_samp("{c}") AS s FROM listings))""" for c in _NUM)))
def a36(spark, sf):
    return profile.outlier_summary(listings(spark, sf, *_NUM), _NUM)


@query("a39_month_counts", with_listings("""SELECT CAST(year(ts) AS VARCHAR) || ' - ' || CAST(month(ts) AS VARCHAR) AS month, count(*) AS n FROM (SELECT TRY_CAST("dateCrawled" AS TIMESTAMP) AS ts FROM listings) GROUP BY 1"""))
def a39(spark, sf):
    return profile.month_counts(listings(spark, sf, "dateCrawled"), "dateCrawled")


@query("a40_timestamp_range", with_listings('SELECT min("dateCrawled") AS first, max("dateCrawled") AS last FROM listings'))
def a40(spark, sf):
    return listings(spark, sf, "dateCrawled").agg(F.min("dateCrawled").alias("first"), F.max("dateCrawled").alias("last"))


@query("a46_shape", with_listings("SELECT count(*) AS n_rows, CAST(12 AS INTEGER) AS n_columns FROM listings"))
def a46(spark, sf):
    return profile.table_shape(listings(spark, sf))


@query("w4_share_of_total", with_listings("SELECT brand, round(count(*) / sum(count(*)) OVER (), 8) AS freq FROM listings GROUP BY 1"))
def w4(spark, sf):
    return lookups.frequency_table(listings(spark, sf, "brand"), "brand").withColumn("freq", F.round("freq", 8))


# ---- sorts and limits ------------------------------------------------------------------------

@query("o1_sorted_groups", with_listings('SELECT brand, "fuelType", round(avg(price), 4) AS mean_price FROM listings GROUP BY 1, 2'))
def o1(spark, sf):
    means = listings(spark, sf, "brand", "fuelType", "price").groupBy("brand", "fuelType").agg(F.round(F.avg("price"), 4).alias("mean_price"))
    return means.orderBy(F.desc("mean_price"), "brand", "fuelType")


@query("o4_top_brands", with_listings("SELECT brand, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, brand LIMIT 6"))
def o4(spark, sf):
    return profile.top_values(listings(spark, sf, "brand"), "brand", 6)


@query("o6_preview", with_listings("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, price FROM listings ORDER BY price DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 10"))
def o6(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return listings(spark, sf, *keys, "price").orderBy(F.desc("price"), *keys).limit(10)


# ---- composites and documented extras --------------------------------------------------------

@query("d6_eda_tier_counts", with_listings("SELECT price_tier, count(*) AS n, round(count(*) * 100.0e0 / sum(count(*)) OVER (), 2) AS pct FROM cleaned GROUP BY 1", *cleaned_ctes()))
def d6(spark, sf):
    return profile.shares(cleaned_listings(spark, sf), "price_tier")


@query("d6_eda_price_histogram", with_listings("""SELECT CAST(b.range AS INTEGER) AS bin, count(price) AS n FROM range(50) b LEFT JOIN (SELECT price, least(CAST(floor((price - lo) / ((hi - lo) / 50.0e0)) AS BIGINT), 49) AS bin FROM cleaned, (SELECT min(price) AS lo, max(price) AS hi FROM cleaned)) ON bin = b.range GROUP BY 1""", *cleaned_ctes()))
def d6_histogram(spark, sf):
    return profile.eda_tables(cleaned_listings(spark, sf))["histogram"]


@query("tier_medians", with_listings("SELECT price_tier, round(median(price), 4) AS median_price, round(median(power), 4) AS median_power, round(median(kilometer), 4) AS median_kilometer, round(median(\"yearOfRegistration\"), 4) AS \"median_yearOfRegistration\" FROM listings GROUP BY 1"))
def tier_medians(spark, sf):
    out = profile.tier_profile(listings(spark, sf, "price_tier", *_NUM))
    return out.select("price_tier", *[F.round(c, 4).alias(c) for c in out.columns if c != "price_tier"])


@query("column_cardinalities", with_listings(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT "{c}") AS distinct_values FROM listings""" for c in rules.TEXT_COLUMNS)))
def cardinalities(spark, sf):
    return profile.cardinalities(listings(spark, sf, *rules.TEXT_COLUMNS), rules.TEXT_COLUMNS)


@query("power_percentiles", with_listings("SELECT round(quantile_cont(power, 0.5), 4) AS p50, round(quantile_cont(power, 0.9), 4) AS p90, round(quantile_cont(power, 0.99), 4) AS p99 FROM listings"))
def power_percentiles(spark, sf):
    from lotmill.operators.order_stats import quantiles

    return quantiles(listings(spark, sf, "power"), ["power"], {"p50": 0.5, "p90": 0.9, "p99": 0.99}).select(
        *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p99")])
