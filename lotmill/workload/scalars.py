"""Projections and scalar functions (families P, C) over the listing and event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions import numeric as num
from lotmill.functions import text as txt
from lotmill.operators import lookups, project
from lotmill.plans import merge
from lotmill.workload.listings import KEYS, archive_source, listings, scraped_source, spelled, spelled_sql, table, with_listings
from lotmill.workload.registry import query

_KEYS = ", ".join(KEYS)


def _row(expression: str, *names: str) -> str:
    return with_listings(f"SELECT {_KEYS}, {expression} FROM listings")


def _case(mapping, column: str, otherwise: str) -> str:
    whens = " ".join("WHEN {} THEN {}".format(_lit(k), _lit(v)) for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def _lit(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v) + ("e0" if isinstance(v, float) else "")


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


# ---- projections -----------------------------------------------------------------------------

@query("p1_required_columns", with_listings('SELECT brand, model, price FROM listings'))
def p1(spark, sf):
    return project.require_columns(listings(spark, sf, "price", "model", "brand"), ["brand", "model", "price"])


@query("p2_rename", with_listings('SELECT l_orderkey, l_partkey, power AS "powerPS", kilometer AS mileage FROM listings'))
def p2(spark, sf):
    return project.rename(listings(spark, sf, "l_orderkey", "l_partkey", "power", "kilometer"), {"power": "powerPS", "kilometer": "mileage"})


@query("p3_source_column", with_listings("SELECT brand, price, 'kaggle' AS \"dataSource\" FROM listings"))
def p3(spark, sf):
    return project.with_source(listings(spark, sf, "brand", "price"), "kaggle")


@query("p4_aligned_layout", with_listings("""SELECT brand, gearbox, kilometer, "yearOfRegistration", side AS "dataSource" FROM listings, (VALUES ('kaggle'), ('crawled')) s(side)"""))
def p4(spark, sf):
    columns = ["brand", "gearbox", "kilometer", "yearOfRegistration", "dataSource"]
    return merge.union_sources(archive_source(spark, sf), scraped_source(spark, sf), columns)


@query("p5_drop_columns", with_listings('SELECT price, price_tier FROM listings'))
def p5(spark, sf):
    return project.drop_columns(listings(spark, sf, "brand", "model", "price", "price_tier"), ["brand", "model", "not_there"])


@query("p6_reindex", with_listings('SELECT price, 0 AS "fuelType_diesel", power FROM listings'))
def p6(spark, sf):
    return project.reindex(listings(spark, sf, "power", "price", "gearbox"), ["price", "fuelType_diesel", "power"], fill=0)


@query("p7_numeric_coercion", _row("TRY_CAST(registration AS DOUBLE) AS from_text, TRY_CAST(substr(registration, 1, 2) AS DOUBLE) AS from_digits"))
def p7(spark, sf):
    return listings(spark, sf, *KEYS, "registration").select(
        *KEYS, num.to_number("registration").alias("from_text"), num.to_number(F.substring("registration", 1, 2)).alias("from_digits"))


@query("p8_integer_coercion", _row("TRY_CAST(split_part(registration, '/', 2) AS INTEGER) AS as_int, TRY_CAST(gearbox AS INTEGER) AS bad"))
def p8(spark, sf):
    return listings(spark, sf, *KEYS, "registration", "gearbox").select(
        *KEYS, num.to_integer(F.split_part("registration", F.lit("/"), F.lit(2))).alias("as_int"), num.to_integer("gearbox").alias("bad"))


@query("p9_price_tier", _row("CASE WHEN p < 5000 THEN 'budget' WHEN p < 15000 THEN 'mid-range' ELSE 'luxury' END AS tier, CASE WHEN p < 5000 THEN 'budget' WHEN p < 15000 THEN 'mid-range' ELSE 'premium' END AS variant").replace("FROM listings", "FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE price END AS p FROM listings)"))
def p9(spark, sf):
    price = F.when(F.col("l_linenumber") != 3, F.col("price"))
    return listings(spark, sf, *KEYS, "price").select(
        *KEYS, num.tier(price).alias("tier"), num.tier(price, labels=("budget", "mid-range", "premium")).alias("variant"))


@query("p10_label_codes", _row("CASE price_tier WHEN 'budget' THEN 0 WHEN 'mid-range' THEN 1 WHEN 'luxury' THEN 2 END AS code, CAST(NULL AS INTEGER) AS unmapped, CASE l_linenumber WHEN 0 THEN 'budget' WHEN 1 THEN 'mid-range' WHEN 2 THEN 'luxury' ELSE 'unknown' END AS decoded"))
def p10(spark, sf):
    return listings(spark, sf, *KEYS, "price_tier", "gearbox").select(
        *KEYS, num.tier_code("price_tier").alias("code"), num.tier_code("gearbox").alias("unmapped"), num.tier_label("l_linenumber").alias("decoded"))


@query("p11_right_closed_bands", _row("CASE WHEN price > 0 AND price <= 3500 THEN 'budget' WHEN price > 3500 AND price <= 12000 THEN 'mid-range' WHEN price > 12000 THEN 'luxury' END AS tier, CASE WHEN power > 0 AND power <= 100 THEN 'low' WHEN power > 100 AND power <= 200 THEN 'mid' WHEN power > 200 THEN 'high' END AS power_band"))
def p11(spark, sf):
    inf = float("inf")
    return listings(spark, sf, *KEYS, "price", "power").select(
        *KEYS, num.right_closed_band("price", [0, 3500, 12000, inf], rules.TIERS).alias("tier"),
        num.right_closed_band("power", [0, 100, 200, inf], ["low", "mid", "high"]).alias("power_band"))


@query("p12_fill_constant", _row("coalesce(\"vehicleType\", 'Unknown') AS \"vehicleType\""))
def p12(spark, sf):
    return project.fill_missing(listings(spark, sf, *KEYS, "vehicleType"), {"vehicleType": "Unknown"})


@query("p13_value_to_null", _row("nullif(model, 'unknown') AS model"))
def p13(spark, sf):
    return listings(spark, sf, *KEYS, "model").withColumn("model", F.nullif(F.col("model"), F.lit("unknown")))


_FEATURES = ["kilometer", "power", "vehicleType_suv", "brand_freq", "seller_dealer"]


@query("p14_display_names", with_listings(f"""SELECT feature, {_case(rules.DISPLAY_NAMES, 'feature', 'feature')} AS shown, count(*) AS n
FROM (SELECT CASE l_linenumber % 5 WHEN 0 THEN 'kilometer' WHEN 1 THEN 'power' WHEN 2 THEN 'vehicleType_suv' WHEN 3 THEN 'brand_freq' ELSE 'seller_dealer' END AS feature FROM listings) GROUP BY 1, 2"""))
def p14(spark, sf):
    named = F.element_at(F.array(*[F.lit(f) for f in _FEATURES]), (F.col("l_linenumber") % 5 + 1).cast("int")).alias("feature")
    return listings(spark, sf, "l_linenumber").select(named).groupBy("feature", txt.display_name("feature").alias("shown")).agg(F.count(F.lit(1)).alias("n"))


@query("p15_percent_text", with_listings("SELECT brand, printf('%.1f%%', 100.0 * n / (SELECT count(*) FROM listings)) AS share FROM (SELECT brand, count(*) AS n FROM listings GROUP BY 1)"))
def p15(spark, sf):
    freq = lookups.frequency_table(listings(spark, sf, "brand"), "brand")
    return freq.select("brand", txt.percent_text("freq").alias("share"))


@query("p16_run_label", with_listings("SELECT \"fuelType\" || ' (' || gearbox || ')' AS label, count(*) AS n FROM listings GROUP BY 1"))
def p16(spark, sf):
    return listings(spark, sf, "fuelType", "gearbox").groupBy(txt.run_label("fuelType", "gearbox").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("p17_numeric_columns", with_listings('SELECT power, kilometer, "yearOfRegistration", price FROM listings'))
def p17(spark, sf):
    from lotmill.operators.profile import numeric_columns

    df = listings(spark, sf)
    return df.select(*numeric_columns(df))


@query("p18_ordered_category", with_listings("""SELECT v AS vehicle, count(*) AS n, max(CASE v WHEN 'small' THEN 0 WHEN 'medium' THEN 1 WHEN 'large' THEN 2 ELSE 3 END) AS pos
FROM (SELECT CASE WHEN lower("vehicleType") IN ('small','medium','large') THEN lower("vehicleType") ELSE 'Unknown' END AS v FROM listings) GROUP BY 1"""))
def p18(spark, sf):
    order = ["small", "medium", "large"]
    shown = listings(spark, sf, "vehicleType").select(num.ordered_category("vehicleType", order).alias("vehicle"))
    rank = num.category_rank("vehicle", order)
    return shown.groupBy("vehicle").agg(F.count(F.lit(1)).alias("n")).withColumn("pos", rank).orderBy("pos")


# ---- scalar functions ------------------------------------------------------------------------

@query("c1_fold_text", _row("lower(trim(brand)) AS brand, lower(trim(model)) AS model"))
def c1(spark, sf):
    return listings(spark, sf, *KEYS, "brand", "model").select(*KEYS, txt.fold("brand").alias("brand"), txt.fold("model").alias("model"))


@query("c2_placeholders", _row(f"CASE WHEN trim(brand) NOT IN {_in(rules.MISSING_PLACEHOLDERS)} THEN trim(brand) END AS brand, CASE WHEN trim(model) NOT IN {_in(rules.MISSING_PLACEHOLDERS)} THEN trim(model) END AS model"))
def c2(spark, sf):
    return listings(spark, sf, *KEYS, "brand", "model").select(
        *KEYS, txt.blank_placeholders("brand").alias("brand"), txt.blank_placeholders("model").alias("model"))


def brand_sql(column: str) -> str:
    name = f"regexp_replace(replace(lower(trim({column})), '_', '-'), '[^\\p{{L}}\\p{{N}}_\\-]', '', 'g')"
    return f"CASE WHEN {name} IN {_in(rules.BRANDS_TO_DROP)} THEN NULL ELSE {_case(rules.BRAND_ALIASES, name, name)} END"


def model_sql(column: str) -> str:
    name = f"replace(lower(trim({column})), '_', '-')"
    kept = f"CASE WHEN {name} IN {_in(rules.MODELS_TO_DROP)} THEN NULL ELSE {_case(rules.MODEL_ALIASES, name, name)} END"
    return f"nullif(regexp_replace({kept}, '[^\\p{{L}}\\p{{N}}_\\-]', '', 'g'), '')"


def category_sql(column: str, aliases) -> str:
    name = f"replace(replace(lower(trim({column})), '_', '-'), ' ', '-')"
    return _case(aliases, name, name)


_BRANDS = [*rules.BRAND_ALIASES, *rules.BRANDS_TO_DROP, "BMW!", " Land_Rover "]
_MODELS = [*rules.MODEL_ALIASES, *rules.MODELS_TO_DROP, "A 4!"]
_VEHICLES = [*rules.VEHICLE_ALIASES, "Coupe", "station_wagon"]
_FUELS = [*rules.FUEL_ALIASES, "diesel"]


@query("c3_brand_name", _row(f"{brand_sql('brand')} AS brand, {brand_sql(spelled_sql(_BRANDS))} AS other"))
def c3(spark, sf):
    return listings(spark, sf, *KEYS, "brand").select(*KEYS, txt.brand_name("brand").alias("brand"), txt.brand_name(spelled(_BRANDS)).alias("other"))


@query("c4_model_name", _row(f"{model_sql('model')} AS model, {model_sql(spelled_sql(_MODELS))} AS other"))
def c4(spark, sf):
    return listings(spark, sf, *KEYS, "model").select(*KEYS, txt.model_name("model").alias("model"), txt.model_name(spelled(_MODELS)).alias("other"))


@query("c5_category", _row(f"""{category_sql('seller', rules.SELLER_ALIASES)} AS seller, {category_sql('gearbox', rules.GEARBOX_ALIASES)} AS gearbox, {category_sql('model', rules.VEHICLE_ALIASES)} AS words, {category_sql(spelled_sql(_VEHICLES), rules.VEHICLE_ALIASES)} AS vehicle"""))
def c5(spark, sf):
    return listings(spark, sf, *KEYS, "seller", "gearbox", "model").select(
        *KEYS, txt.category("seller", rules.SELLER_ALIASES).alias("seller"),
        txt.category("gearbox", rules.GEARBOX_ALIASES).alias("gearbox"), txt.category("model", rules.VEHICLE_ALIASES).alias("words"),
        txt.category(spelled(_VEHICLES), rules.VEHICLE_ALIASES).alias("vehicle"))


@query("c6_horsepower", _row(r"TRY_CAST(nullif(regexp_extract(power_text, '\((\d+)\s*hp\)', 1), '') AS DOUBLE) AS hp"))
def c6(spark, sf):
    return listings(spark, sf, *KEYS, "power_text").select(*KEYS, txt.horsepower("power_text").alias("hp"))


@query("c7_horsepower_fallback", _row(r"TRY_CAST(coalesce(nullif(regexp_extract(power_text, '\((\d+)\s*hp\)', 1), ''), nullif(regexp_extract(power_text, '(\d+)', 1), '')) AS INTEGER) AS hp"))
def c7(spark, sf):
    return listings(spark, sf, *KEYS, "power_text").select(*KEYS, txt.horsepower_or_digits("power_text").alias("hp"))


@query("c8_first_year", _row(r"TRY_CAST(nullif(regexp_extract(registration, '(\d{4})', 1), '') AS INTEGER) AS year, TRY_CAST(nullif(regexp_extract(registration, '(\d{4})', 1), '') AS INTEGER) AS checked"))
def c8(spark, sf):
    return listings(spark, sf, *KEYS, "registration").select(
        *KEYS, txt.first_year("registration").alias("year"), txt.year_of_registration("registration").alias("checked"))


@query("c9_year_after_slash", _row("TRY_CAST(split_part(registration, '/', 2) AS INTEGER) AS year"))
def c9(spark, sf):
    return listings(spark, sf, *KEYS, "registration").select(*KEYS, txt.year_after_slash("registration").alias("year"))


@query("c10_crawl_year", _row('CAST(substr("dateCrawled", 1, 4) AS INTEGER) AS year'))
def c10(spark, sf):
    return listings(spark, sf, *KEYS, "dateCrawled").select(*KEYS, txt.leading_year("dateCrawled").alias("year"))


@query("c11_timestamp_parts", _row('CAST(year(TRY_CAST("dateCrawled" AS TIMESTAMP)) AS INTEGER) AS year, CAST(month(TRY_CAST("dateCrawled" AS TIMESTAMP)) AS INTEGER) AS month, CAST(year(TRY_CAST(gearbox AS TIMESTAMP)) AS INTEGER) AS bad'))
def c11(spark, sf):
    ts, bad = F.try_to_timestamp("dateCrawled"), F.try_to_timestamp("gearbox")
    return listings(spark, sf, *KEYS, "dateCrawled", "gearbox").select(*KEYS, F.year(ts).alias("year"), F.month(ts).alias("month"), F.year(bad).alias("bad"))


@query("c12_digits_only", _row(r"regexp_replace(price_text, '\D', '', 'g') AS digits"))
def c12(spark, sf):
    return listings(spark, sf, *KEYS, "price_text").select(*KEYS, txt.digits_only("price_text").alias("digits"))


@query("c13_logarithms", _row("round(ln(1 + kilometer), 6) AS log_km, round(log10(price), 6) AS log10_price, round(ln(price), 6) AS ln_price"))
def c13(spark, sf):
    return listings(spark, sf, *KEYS, "kilometer", "price").select(
        *KEYS, F.round(F.log1p("kilometer"), 6).alias("log_km"), F.round(F.log10("price"), 6).alias("log10_price"), F.round(F.log("price"), 6).alias("ln_price"))


@query("c14_ratio_features", _row('2020 - "yearOfRegistration" AS age, kilometer / nullif(2020 - "yearOfRegistration" + 1, 0) AS km_per_year, kilometer / (power + 1) AS km_power_ratio'))
def c14(spark, sf):
    age = num.vehicle_age("yearOfRegistration", 2020)
    return listings(spark, sf, *KEYS, "yearOfRegistration", "kilometer", "power").select(
        *KEYS, age.alias("age"), num.per_unit("kilometer", age).alias("km_per_year"), num.per_unit("kilometer", F.col("power")).alias("km_power_ratio"))


@query("c16_half_even", _row("round_even(l_quantity / 8, 2) AS even2, round(l_quantity / 8, 2) AS up2"))
def c16(spark, sf):
    eighth = F.col("l_quantity") / 8
    return listings(spark, sf, *KEYS, "l_quantity").select(*KEYS, num.half_even(eighth, 2).alias("even2"), F.round(eighth, 2).alias("up2"))


@query("c17_abs_floor_ceil", _row("abs(2000 - \"yearOfRegistration\") AS dist, CAST(floor(price) AS BIGINT) AS lo, CAST(ceil(price) AS BIGINT) AS hi"))
def c17(spark, sf):
    return listings(spark, sf, *KEYS, "yearOfRegistration", "price").select(
        *KEYS, F.abs(2000 - F.col("yearOfRegistration")).alias("dist"), F.floor("price").alias("lo"), F.ceil("price").alias("hi"))


@query("c21_brand_model_tokens", _row(r"regexp_split_to_array(trim(model), '\s+')[1] AS first, array_to_string(regexp_split_to_array(trim(model), '\s+')[2:], ' ') AS others"))
def c21(spark, sf):
    return listings(spark, sf, *KEYS, "model").select(*KEYS, txt.first_word("model").alias("first"), txt.other_words("model").alias("others"))


@query("c22_fallback_field", _row("coalesce(nullif(CASE WHEN l_linenumber = 2 THEN '' ELSE registration END, ''), \"dateCrawled\") AS year"))
def c22(spark, sf):
    first = F.when(F.col("l_linenumber") == 2, "").otherwise(F.col("registration"))
    return listings(spark, sf, *KEYS, "registration", "dateCrawled").select(*KEYS, txt.first_filled(first, "dateCrawled").alias("year"))


@query("c23_title_and_thousands", _row("upper(substr(gearbox, 1, 1)) || substr(gearbox, 2) AS title, format('{:,}', CAST(floor(price) AS BIGINT)) AS shown"))
def c23(spark, sf):
    return listings(spark, sf, *KEYS, "gearbox", "price").select(*KEYS, txt.title_case("gearbox").alias("title"), txt.thousands(F.floor("price")).alias("shown"))


# ---- lookups (family J) ----------------------------------------------------------------------

_CPI = _case({y: rules.CPI_USED_CARS[rules.CPI_BASE_YEAR] / v for y, v in rules.CPI_USED_CARS.items()}, 'CAST(substr("dateCrawled", 1, 4) AS INTEGER)', "NULL")


@query("j1_cpi_price", _row(f"round(price * {_CPI}, 6) AS price"))
def j1(spark, sf):
    return listings(spark, sf, *KEYS, "price", "dateCrawled").select(
        *KEYS, F.round(num.cpi_price("price", txt.leading_year("dateCrawled")), 6).alias("price"))


@query("j2_alias_or_self", _row(_case(rules.GEARBOX_ALIASES, "gearbox", "gearbox") + " AS gearbox, " + _case(rules.FUEL_ALIASES, spelled_sql(_FUELS), spelled_sql(_FUELS)) + ' AS "fuelType"'))
def j2(spark, sf):
    return listings(spark, sf, *KEYS, "gearbox").withColumn("fuelType", spelled(_FUELS)).select(
        *KEYS, txt.lookup_or_self("gearbox", rules.GEARBOX_ALIASES).alias("gearbox"), txt.lookup_or_self("fuelType", rules.FUEL_ALIASES).alias("fuelType"))


_SERVED = [*rules.SERVING_MODEL_FREQUENCY, "rare-model"]


@query("j3_frequency_lookup", with_listings(f"""SELECT l.l_orderkey, l.l_partkey, round(coalesce(f.freq, 0.0), 8) AS model_freq, {_case(rules.SERVING_MODEL_FREQUENCY, spelled_sql(_SERVED), _lit(rules.UNSEEN_FREQUENCY))} AS serving_freq
FROM listings l LEFT JOIN (SELECT model, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM listings WHERE "dataSource" = 'kaggle') AS freq FROM listings WHERE "dataSource" = 'kaggle' GROUP BY 1) f ON l.model = f.model"""))
def j3(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "model", "dataSource")
    freq = lookups.frequency_table(rows.where(F.col("dataSource") == "kaggle"), "model")
    joined = lookups.attach(rows, freq, ["model"])
    return joined.select("l_orderkey", "l_partkey", F.round(F.coalesce("freq", F.lit(0.0)), 8).alias("model_freq"),
                         txt.lookup_or_default(spelled(_SERVED), rules.SERVING_MODEL_FREQUENCY, rules.UNSEEN_FREQUENCY).alias("serving_freq"))


@query("j4_group_mode_fill", with_listings("""SELECT l.l_orderkey, l.l_partkey, l.brand, l.power, coalesce(l.vt, m.vt, 'unknown') AS "vehicleType"
FROM (SELECT *, "vehicleType" AS vt FROM listings) l LEFT JOIN (
  SELECT brand, power, vt FROM (SELECT brand, power, "vehicleType" AS vt, row_number() OVER (PARTITION BY brand, power ORDER BY count(*) DESC, "vehicleType") AS rn
  FROM listings WHERE "vehicleType" IS NOT NULL GROUP BY brand, power, "vehicleType") WHERE rn = 1) m ON l.brand = m.brand AND l.power = m.power"""))
def j4(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "brand", "power", "vehicleType")
    return lookups.fill_from_group_mode(rows, ["brand", "power"], "vehicleType", fallback="unknown")


@query("j5_values_not_allowed", with_listings(f"SELECT DISTINCT lower(\"vehicleType\") AS \"vehicleType\" FROM listings WHERE lower(\"vehicleType\") NOT IN {_in(['small', 'large', *rules.CATEGORY_RULES['vehicleType']])}"))
def j5(spark, sf):
    return lookups.not_allowed(listings(spark, sf, "vehicleType"), "vehicleType", ["small", "large", *rules.CATEGORY_RULES["vehicleType"]])


@query("j6_remove_listed_rows", with_listings("SELECT l_orderkey, l_partkey, price FROM listings WHERE l_partkey NOT IN (SELECT l_partkey FROM listings GROUP BY 1 HAVING max(price) > 15000)"))
def j6(spark, sf):
    rows = listings(spark, sf, "l_orderkey", "l_partkey", "price")
    listed = rows.groupBy("l_partkey").agg(F.max("price").alias("top")).where(F.col("top") > 15000).select("l_partkey")
    return rows.join(listed, "l_partkey", "left_anti").select("l_orderkey", "l_partkey", "price")


_STRICT = [*rules.STRICT_FUEL, "steam"]


@query("j7_strict_lookup", _row(_case(rules.STRICT_GEARBOX, "gearbox", "NULL") + " AS gearbox, " + _case(rules.STRICT_FUEL, spelled_sql(_STRICT), "NULL") + ' AS "fuelType", ' + _case({"privat": "private"}, "seller", "NULL") + " AS seller"))
def j7(spark, sf):
    return listings(spark, sf, *KEYS, "gearbox", "seller").withColumn("fuelType", spelled(_STRICT)).select(
        *KEYS, txt.lookup_or_null("gearbox", rules.STRICT_GEARBOX).alias("gearbox"),
        txt.lookup_or_null("fuelType", rules.STRICT_FUEL).alias("fuelType"), txt.lookup_or_null("seller", {"privat": "private"}).alias("seller"))


# ---- set operations (family U) ---------------------------------------------------------------

@query("u1_union_all_sources", with_listings("""SELECT CASE WHEN side = 0 THEN 'kaggle' ELSE 'crawled' END AS "dataSource", brand, gearbox, count(*) AS n
FROM (SELECT 0 AS side, brand, gearbox FROM listings UNION ALL SELECT 1, brand, gearbox FROM listings) GROUP BY 1, 2, 3"""))
def u1(spark, sf):
    a = project.with_source(archive_source(spark, sf).select("brand", "gearbox"), "kaggle")
    b = project.with_source(scraped_source(spark, sf).select("gearbox", "brand"), "crawled")
    return a.unionByName(b).groupBy("dataSource", "brand", "gearbox").agg(F.count(F.lit(1)).alias("n"))


@query("u2_union_all_parts", "SELECT l_orderkey AS orderkey, 'line' AS part FROM lineitem UNION ALL SELECT o_orderkey, 'order' FROM orders")
def u2(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.lit("line").alias("part"))
    b = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.lit("order").alias("part"))
    return a.unionByName(b)


@query("u4_except", with_listings("""SELECT DISTINCT brand, gearbox FROM listings WHERE "dataSource" = 'kaggle' EXCEPT SELECT brand, gearbox FROM listings WHERE "dataSource" = 'crawled' AND seller = 'privat' """))
def u4(spark, sf):
    rows = listings(spark, sf, "brand", "gearbox", "dataSource", "seller")
    a = rows.where(F.col("dataSource") == "kaggle").select("brand", "gearbox")
    b = rows.where((F.col("dataSource") == "crawled") & (F.col("seller") == "privat")).select("brand", "gearbox")
    return a.subtract(b)
