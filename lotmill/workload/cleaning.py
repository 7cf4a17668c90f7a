"""Filters, cleaning, duplicates (families F, D, W, part of A and C) over the listing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators import copies, filters, lookups, order_stats, quality
from lotmill.plans import clean as cleaning
from lotmill.plans import merge
from lotmill.workload.listings import (
    KEYS, LISTING, archive_source, coarse_listings, listings, scraped_source, table, with_listings,
)
from lotmill.workload.registry import query
from lotmill.workload.scalars import _CPI, _in, brand_sql, category_sql, model_sql

_VALID = """price BETWEEN 500 AND 3000000 AND "yearOfRegistration" BETWEEN 1900 AND 2026 AND kilometer BETWEEN 0 AND 300000 AND power BETWEEN 5 AND 3000"""
_FILLED = [c for c in rules.TEXT_COLUMNS if c != "brand"]


def q(name: str) -> str:
    return f'"{name}"'


def text_sql(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) NOT IN {_in(rules.MISSING_PLACEHOLDERS)} THEN lower(trim({column})) END"


def coerced_ctes(source: str = "listings", where: str = _VALID) -> list[str]:
    texts = ", ".join(f"{text_sql(q(c))} AS {q(c)}" for c in rules.TEXT_COLUMNS)
    return [
        f'coerced AS (SELECT {texts}, power, kilometer, "yearOfRegistration", price, price_tier FROM {source})',
        f"valid AS (SELECT * FROM coerced WHERE {where})",
    ]


def imputed_ctes() -> list[str]:
    normal = ", ".join([
        f"{brand_sql('brand')} AS brand", f"{model_sql('model')} AS model",
        f"{category_sql(q('vehicleType'), rules.VEHICLE_ALIASES)} AS {q('vehicleType')}",
        f"{category_sql(q('fuelType'), rules.FUEL_ALIASES)} AS {q('fuelType')}",
        f"{category_sql('seller', rules.SELLER_ALIASES)} AS seller", f"{category_sql('gearbox', rules.GEARBOX_ALIASES)} AS gearbox",
    ])
    out = [f'norm AS (SELECT {normal}, "dataSource", power, kilometer, "yearOfRegistration", price, price_tier FROM valid)']
    for c in _FILLED:
        out.append(f"m_{c} AS (SELECT brand, v FROM (SELECT brand, {q(c)} AS v, row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, {q(c)}) AS rn "
                   f"FROM norm WHERE brand IS NOT NULL AND {q(c)} IS NOT NULL GROUP BY brand, {q(c)}) WHERE rn = 1)")
    joins = " ".join(f"LEFT JOIN m_{c} ON norm.brand = m_{c}.brand" for c in _FILLED)
    fills = ", ".join(f"coalesce(norm.{q(c)}, m_{c}.v, CASE WHEN norm.brand IS NOT NULL THEN 'unknown' END) AS {q(c)}" for c in _FILLED)
    out.append(f'filled AS (SELECT norm.brand, {fills}, power, kilometer, "yearOfRegistration", price, price_tier FROM norm {joins})')
    finals = []
    for c in _FILLED:
        if c == "model":
            finals.append(f"coalesce({q(c)}, 'unknown') AS {q(c)}")
        else:
            finals.append(f"coalesce({q(c)}, (SELECT {q(c)} FROM filled WHERE {q(c)} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'unknown') AS {q(c)}")
    out.append(f'imputed AS (SELECT brand, {", ".join(finals)}, power, kilometer, "yearOfRegistration", price, price_tier FROM filled)')
    return out


def cleaned_ctes() -> list[str]:
    hi = lambda c: f"quantile_cont({c}, 0.75) + 1.5e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    texts = ", ".join(["brand", *map(q, _FILLED)])
    return [
        *coerced_ctes(), *imputed_ctes(),
        f'caps AS (SELECT {hi("power")} AS pw, {hi("kilometer")} AS km, CAST(ceil({hi(q("yearOfRegistration"))}) AS INTEGER) AS yr FROM valid)',
        f"""cleaned AS (SELECT DISTINCT {texts}, least(greatest(power, 5.0e0), pw) AS power, round(least(greatest(kilometer, 0.0e0), km), 6) AS kilometer,
  CAST(least(greatest("yearOfRegistration", 1900), yr) AS INTEGER) AS "yearOfRegistration", price, price_tier FROM imputed, caps WHERE brand IS NOT NULL)""",
    ]


def cleaned_listings(spark, sf):
    return cleaning.clean(listings(spark, sf)).withColumn("kilometer", F.round("kilometer", 6))


# ---- filters ---------------------------------------------------------------------------------

@query("f1_domain_bounds", with_listings(f'SELECT l_orderkey, l_partkey, price, power, kilometer, "yearOfRegistration" FROM listings WHERE {_VALID}'))
def f1(spark, sf):
    return filters.remove_invalid(listings(spark, sf, "l_orderkey", "l_partkey", "price", "power", "kilometer", "yearOfRegistration"))


@query("f2_drop_incomplete", with_listings('SELECT l_orderkey, l_partkey, "vehicleType" FROM listings WHERE "vehicleType" IS NOT NULL'))
def f2(spark, sf):
    return listings(spark, sf, "l_orderkey", "l_partkey", "vehicleType").dropna(how="any")


@query("f3_plausible_rows", with_listings('SELECT l_orderkey, l_partkey, power, kilometer, "yearOfRegistration" FROM listings WHERE power > 0 AND power < 5000 AND kilometer BETWEEN 0 AND 300000 AND "yearOfRegistration" BETWEEN 1950 AND 2023'))
def f3(spark, sf):
    return filters.plausible(listings(spark, sf, "l_orderkey", "l_partkey", "power", "kilometer", "yearOfRegistration"))


_FENCES = """f AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3, avg(price) AS m, stddev_samp(price) AS s FROM listings)"""
_IQR_OUT = "(price < q1 - 1.5e0 * (q3 - q1) OR price > q3 + 1.5e0 * (q3 - q1))"
_Z_OUT = "abs((price - m) / s) > 3"


@query("f4_remove_outliers", with_listings(f"SELECT l_orderkey, l_partkey, price FROM listings, f WHERE NOT ({_IQR_OUT} OR {_Z_OUT})", _FENCES))
def f4(spark, sf):
    return filters.remove_outliers(listings(spark, sf, "l_orderkey", "l_partkey", "price"), "price")


@query("f5_keep_inside_iqr", with_listings(f"SELECT l_orderkey, l_partkey, price FROM listings, f WHERE NOT {_IQR_OUT}", _FENCES))
def f5(spark, sf):
    return filters.keep_inside_iqr(listings(spark, sf, "l_orderkey", "l_partkey", "price"), "price")


@query("f6_equality", with_listings("SELECT l_orderkey, l_partkey, price FROM listings WHERE \"fuelType\" = 'building' AND brand = 'Brand#2'"))
def f6(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "price", "fuelType", "brand")
    return rows.where((F.col("fuelType") == "building") & (F.col("brand") == "Brand#2")).select("l_orderkey", "l_partkey", "price")


@query("f8_set_membership", with_listings("SELECT brand, \"fuelType\", count(*) AS n FROM listings WHERE \"fuelType\" IN ('building','machinery') AND brand NOT IN ('Brand#1',' N/A ') GROUP BY 1, 2"))
def f8(spark, sf):
    rows = listings(spark, sf, "brand", "fuelType")
    kept = rows.where(F.col("fuelType").isin("building", "machinery") & ~F.col("brand").isin("Brand#1", " N/A "))
    return kept.groupBy("brand", "fuelType").agg(F.count(F.lit(1)).alias("n"))


@query("f9_violation_counts", with_listings("""SELECT violation, n, round(n * 100.0e0 / total, 2) AS pct FROM (SELECT count(*) AS total, count(*) FILTER (power <= 0) AS a, count(*) FILTER (power >= 5000) AS b, count(*) FILTER (kilometer > 300000) AS c, count(*) FILTER ("yearOfRegistration" < 1980) AS d FROM listings)
 CROSS JOIN LATERAL (VALUES ('power_low', a), ('power_high', b), ('km_high', c), ('year_low', d)) v(violation, n)"""))
def f9(spark, sf):
    rows = listings(spark, sf, "power", "kilometer", "yearOfRegistration")
    return filters.violation_counts(rows, {
        "power_low": F.col("power") <= 0, "power_high": F.col("power") >= 5000,
        "km_high": F.col("kilometer") > 300_000, "year_low": F.col("yearOfRegistration") < 1980,
    })


@query("u3_union_of_flagged", with_listings(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM listings, f WHERE {_IQR_OUT} UNION SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM listings, f WHERE {_Z_OUT}""", _FENCES))
def u3(spark, sf):
    return filters.flagged_rows(listings(spark, sf, *KEYS, "price"), KEYS, "price")


# ---- duplicates ------------------------------------------------------------------------------

_COARSE = 'coarse AS (SELECT brand, gearbox, seller, "vehicleType", "yearOfRegistration" FROM listings)'
_COARSE_COLS = 'brand, gearbox, seller, "vehicleType", "yearOfRegistration"'


@query("w1_drop_duplicates", with_listings("SELECT DISTINCT * FROM coarse", _COARSE))
def w1(spark, sf):
    return copies.drop_copies(coarse_listings(spark, sf))


@query("w5_duplicate_flag", with_listings(f"SELECT *, row_number() OVER (PARTITION BY {_COARSE_COLS} ORDER BY brand) > 1 AS is_copy FROM coarse", _COARSE))
def w5(spark, sf):
    return copies.copy_flags(coarse_listings(spark, sf))


@query("a4_uniqueness", with_listings("""SELECT CAST(t AS BIGINT) AS rows, CAST(t - d AS BIGINT) AS duplicate_rows, round((t - d) * 100.0e0 / t, 4) AS duplicate_rows_pct, round(100.0e0 - (t - d) * 100.0e0 / t, 2) AS uniqueness_score_pct
FROM (SELECT (SELECT count(*) FROM coarse) AS t, (SELECT count(*) FROM (SELECT DISTINCT * FROM coarse)) AS d)""", _COARSE))
def a4(spark, sf):
    return copies.uniqueness(coarse_listings(spark, sf))


@query("a38_duplicate_members", with_listings(f"SELECT {_COARSE_COLS} FROM (SELECT *, count(*) OVER (PARTITION BY {_COARSE_COLS}) AS n FROM coarse) WHERE n > 1", _COARSE))
def a38(spark, sf):
    return copies.copied_rows(coarse_listings(spark, sf))


@query("a38_duplicate_brand_share", with_listings(f"""SELECT brand, round(count(*) * 100.0e0 / (SELECT count(*) FROM d), 6) AS pct FROM d GROUP BY 1""", _COARSE, f"d AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY {_COARSE_COLS}) AS n FROM coarse) WHERE n > 1)"))
def a38b(spark, sf):
    return copies.copy_share(coarse_listings(spark, sf), "brand").withColumn("pct", F.round("pct", 6))


@query("near_duplicates", with_listings("""SELECT brand, model, "yearOfRegistration", power, price, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY brand, model, "yearOfRegistration", power ORDER BY price, l_orderkey) AS rn FROM listings) WHERE rn = 1"""))
def near(spark, sf):
    rows = listings(spark, sf, "brand", "model", "yearOfRegistration", "power", "price", "l_orderkey")
    return copies.drop_near_copies(rows, ["brand", "model", "yearOfRegistration", "power"], ["price"])


# ---- capping, rules, modes -------------------------------------------------------------------

@query("c15_cap_outliers", with_listings("""SELECT l_orderkey, l_partkey, round(least(greatest(price, 500.0e0), c.p), 4) AS price, round(least(greatest(power, 5.0e0), c.w), 4) AS power, CAST(least(greatest("yearOfRegistration", 1900), c.y) AS INTEGER) AS "yearOfRegistration"
FROM listings, (SELECT quantile_cont(price, 0.75) + 1.5e0 * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) AS p, quantile_cont(power, 0.75) + 1.5e0 * (quantile_cont(power, 0.75) - quantile_cont(power, 0.25)) AS w,
 CAST(ceil(quantile_cont("yearOfRegistration", 0.75) + 1.5e0 * (quantile_cont("yearOfRegistration", 0.75) - quantile_cont("yearOfRegistration", 0.25))) AS INTEGER) AS y FROM listings) c"""))
def c15(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "price", "power", "yearOfRegistration")
    capped = filters.cap_outliers(rows, ["price", "power", "yearOfRegistration", "not_there"])
    return capped.withColumns({"price": F.round("price", 4), "power": F.round("power", 4)})


@query("a18_rule_violations", with_listings("""SELECT "column", rule, n FROM (SELECT count(*) FILTER (price < 500) AS a, count(*) FILTER (power < 5) AS b, count(*) FILTER (kilometer > 300000) AS c, count(*) FILTER (seller NOT IN ('privat')) AS d FROM listings)
 CROSS JOIN LATERAL (VALUES ('price', 'min', a), ('power', 'min', b), ('kilometer', 'max', c), ('seller', 'allowed', d)) v("column", rule, n) WHERE n > 0
 UNION ALL SELECT 'not_there', 'missing', CAST(0 AS BIGINT)"""))
def a18(spark, sf):
    rule_set = {**rules.CLEANING_RULES, "seller": {"nullable": True, "allowed": ["privat"]}, "not_there": {"nullable": True}}
    return quality.rule_violations(listings(spark, sf), rule_set)


@query("a19_group_mode", with_listings("""SELECT brand, "vehicleType" FROM (SELECT brand, "vehicleType", row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, "vehicleType") AS rn FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY 1, 2) WHERE rn = 1"""))
def a19(spark, sf):
    return lookups.group_mode(listings(spark, sf, "brand", "vehicleType"), ["brand"], "vehicleType")


@query("a20_global_mode_median", with_listings("""SELECT "column", median, mode FROM (SELECT 'power' AS "column", median(power) AS median, (SELECT CAST(power AS DOUBLE) FROM listings GROUP BY power ORDER BY count(*) DESC, power LIMIT 1) AS mode FROM listings
 UNION ALL SELECT 'yearOfRegistration', median("yearOfRegistration"), (SELECT CAST("yearOfRegistration" AS DOUBLE) FROM listings GROUP BY "yearOfRegistration" ORDER BY count(*) DESC, "yearOfRegistration" LIMIT 1) FROM listings)"""))
def a20(spark, sf):
    return order_stats.quantiles(listings(spark, sf, "power", "yearOfRegistration"), ["power", "yearOfRegistration"], {"median": 0.5}).select("column", "median", "mode")


# ---- composites ------------------------------------------------------------------------------

_ARCHIVE = f"""archive AS (SELECT brand, model, "vehicleType", power, gearbox, kilometer, "fuelType", "yearOfRegistration", seller, 'kaggle' AS "dataSource", price * {_CPI} AS price FROM listings)"""
_SCRAPED = r"""scraped AS (SELECT brand, model, "vehicleType", TRY_CAST(nullif(regexp_extract(power_text, '\((\d+)\s*hp\)', 1), '') AS DOUBLE) AS power, gearbox, kilometer, "fuelType", TRY_CAST(nullif(regexp_extract(registration, '(\d{4})', 1), '') AS INTEGER) AS "yearOfRegistration", seller, 'crawled' AS "dataSource", price FROM listings)"""
_TIER = "CASE WHEN price < 5000 THEN 'budget' WHEN price < 15000 THEN 'mid-range' ELSE 'luxury' END AS price_tier"
_COLS = "brand, model, \"vehicleType\", power, gearbox, kilometer, \"fuelType\", \"yearOfRegistration\", seller, \"dataSource\""


def _rounded(df):
    return df.withColumn("price", F.round("price", 5))


@query("d1_align_archive", with_listings(f"SELECT {_COLS}, round(price, 5) AS price, {_TIER} FROM archive", _ARCHIVE))
def d1(spark, sf):
    return _rounded(merge.align_archive(archive_source(spark, sf)).select(*LISTING))


@query("d2_align_scraped", with_listings(f"SELECT {_COLS}, round(price, 5) AS price, {_TIER} FROM scraped", _SCRAPED))
def d2(spark, sf):
    return _rounded(merge.align_scraped(scraped_source(spark, sf)).select(*LISTING))


@query("d3_merged_sources", with_listings(f"SELECT {_COLS}, round(price, 5) AS price, {_TIER} FROM (SELECT * FROM archive UNION ALL BY NAME SELECT * FROM scraped)", _ARCHIVE, _SCRAPED))
def d3(spark, sf):
    return _rounded(merge.union_sources(archive_source(spark, sf), scraped_source(spark, sf)))


@query("d4_impute", with_listings("""SELECT * REPLACE (coalesce(power, (SELECT median(power) FROM imputed)) AS power) FROM imputed""",
                                  *coerced_ctes("(SELECT * REPLACE (nullif(power, 8) AS power) FROM listings)", "true"), *imputed_ctes()))
def d4(spark, sf):
    rows = listings(spark, sf).withColumn("power", F.nullif(F.col("power"), F.lit(8.0)))
    return cleaning.impute(cleaning.coerce(rows))


@query("d5_cleaned_listings", with_listings("SELECT * FROM cleaned", *cleaned_ctes()))
def d5(spark, sf):
    return cleaned_listings(spark, sf)


@query("tier_distribution_of_clean_listings", with_listings("SELECT price_tier, count(*) AS n, round(avg(price), 4) AS mean_price FROM cleaned GROUP BY 1", *cleaned_ctes()))
def flagship(spark, sf):
    clean = cleaning.clean(listings(spark, sf))
    return clean.groupBy("price_tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean_price"))
