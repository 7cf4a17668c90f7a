"""Listing tables derived from the driver tables, and the same derivation as SQL text.

The Spark side joins only the tables whose columns are asked for: every foreign key of the driver
tables finds its row, so leaving out a join does not change the row set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.functions.numeric import tier

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expressions():
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return {
        "brand": (F.when(order % 17 == 0, " N/A ").when(order % 13 == 0, F.upper(F.translate("p_brand", "#", "_"))).otherwise(F.col("p_brand")), {"part"}),
        "model": (F.when(part % 19 == 0, "unknown").otherwise(F.col("p_name")), {"part"}),
        "vehicleType": (F.when(part % 11 != 0, F.lower("p_type")), {"part"}),
        "power": (F.when(order % 23 == 0, 0.0).otherwise(F.col("l_quantity") * 8), set()),
        "gearbox": (F.when(F.col("l_linestatus") == "F", "manuell").otherwise("automatik"), set()),
        "kilometer": (F.col("o_totalprice") / 1.6, {"orders"}),
        "fuelType": (F.lower("c_mktsegment"), {"orders", "customer"}),
        "yearOfRegistration": (1971 + F.col("p_size"), {"part"}),
        "seller": (F.when(F.col("o_orderstatus") == "F", "privat").otherwise("gewerblich"), {"orders"}),
        "dataSource": (F.when(order % 5 == 0, "crawled").otherwise("kaggle"), set()),
        "price": (F.col("l_extendedprice") / 5, set()),
        "price_tier": (tier(F.col("l_extendedprice") / 5), set()),
        # an order date moved into the years covered by the price index
        "dateCrawled": (F.date_format(F.expr("o_orderdate + INTERVAL '20' YEAR"), "yyyy-MM-dd HH:mm:ss"), {"orders"}),
        "registration": (F.concat(F.lpad((F.col("l_linenumber") + 1).cast("string"), 2, "0"), F.lit("/"), (1971 + F.col("p_size")).cast("string")), {"part"}),
        "power_text": (F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" kW"), F.when(F.col("l_linenumber") != 1, F.concat(F.lit(" ("), (F.col("l_quantity") * 8).cast("int").cast("string"), F.lit(" hp)"))).otherwise("")), set()),
        "price_text": (F.concat(F.lit("€ "), F.format_number(F.floor(F.col("l_extendedprice") / 5), 0)), set()),
    }


LISTING = ["brand", "model", "vehicleType", "power", "gearbox", "kilometer", "fuelType", "yearOfRegistration",
           "seller", "dataSource", "price", "price_tier"]


def listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Listing rows with the asked columns (all twelve by default); key columns may be asked too."""
    columns = columns or tuple(LISTING)
    known = _expressions()
    needed = set().union(*[known[c][1] for c in columns if c in known])
    rows = table(spark, sf_dir, "lineitem")
    # the smaller tables meet first, and the part last: lines are shuffled twice, never with the texts of a part
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(*[known[c][0].alias(c) if c in known else F.col(c) for c in columns])


def complete(df: DataFrame) -> DataFrame:
    """``df.dropna()`` as one condition per column, so that each is tested where its table is read and unused columns end there."""
    for c, kind in df.dtypes:
        value = F.col(f"`{c}`")
        df = df.where(value.isNotNull() & ~F.isnan(value) if kind in ("double", "float") else value.isNotNull())
    return df


def coarse_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few coarse columns, so that whole-row copies occur naturally."""
    return listings(spark, sf_dir, "brand", "gearbox", "seller", "vehicleType", "yearOfRegistration")


def archive_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source A in its raw layout."""
    raw = listings(spark, sf_dir, "dateCrawled", "seller", "price", "vehicleType", "yearOfRegistration", "gearbox",
                   "power", "model", "kilometer", "fuelType", "brand")
    return raw.withColumnRenamed("power", "powerPS")


def scraped_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source B in its raw layout."""
    raw = listings(spark, sf_dir, "brand", "model", "fuelType", "kilometer", "registration", "vehicleType", "seller",
                   "gearbox", "power_text", "price")
    return raw.withColumnsRenamed({"kilometer": "mileage", "registration": "year", "power_text": "power"})


def spelled(values) -> Column:
    """One of the given spellings per row, by part key; :func:`spelled_sql` is the same in SQL."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("l_partkey") % len(values) + 1).cast("int"))


def spelled_sql(values) -> str:
    return "([" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"])[CAST(l_partkey % {len(values)} + 1 AS BIGINT)]"


def predictions(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Tier codes as truth and a deterministic pseudo-prediction that errs in a known pattern."""
    base = listings(spark, sf_dir, "price", "l_orderkey", "l_partkey", *extra)
    truth = F.when(F.col("price") < 5000, 0).when(F.col("price") < 15000, 1).otherwise(2)
    guess = F.when(F.col("l_partkey") % 7 == 0, (truth + 1) % 3).when(F.col("l_orderkey") % 11 == 0, (truth + 2) % 3).otherwise(truth)
    return base.select(truth.alias("y_true"), guess.alias("y_pred"), *extra)


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions labelled with a run: the vehicle type stands for the model, the segment for the dataset."""
    runs = predictions(spark, sf_dir, "vehicleType", "fuelType", "l_linenumber")
    return runs.where(F.col("vehicleType").isNotNull()).select(
        F.col("vehicleType").alias("model"), F.col("fuelType").alias("dataset"), "l_linenumber", "y_true", "y_pred"
    )


LISTINGS_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  CASE WHEN l_orderkey % 17 = 0 THEN ' N/A ' WHEN l_orderkey % 13 = 0 THEN upper(replace(p_brand,'#','_')) ELSE p_brand END AS brand,
  CASE WHEN l_partkey % 19 = 0 THEN 'unknown' ELSE p_name END AS model,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE lower(p_type) END AS "vehicleType",
  CASE WHEN l_orderkey % 23 = 0 THEN 0 ELSE l_quantity * 8 END AS power,
  CASE WHEN l_linestatus = 'F' THEN 'manuell' ELSE 'automatik' END AS gearbox,
  o_totalprice / 1.6 AS kilometer, lower(c_mktsegment) AS "fuelType", CAST(1971 + p_size AS INTEGER) AS "yearOfRegistration",
  CASE WHEN o_orderstatus = 'F' THEN 'privat' ELSE 'gewerblich' END AS seller,
  CASE WHEN l_orderkey % 5 = 0 THEN 'crawled' ELSE 'kaggle' END AS "dataSource",
  l_extendedprice / 5 AS price,
  CASE WHEN l_extendedprice / 5 < 5000 THEN 'budget' WHEN l_extendedprice / 5 < 15000 THEN 'mid-range' ELSE 'luxury' END AS price_tier,
  strftime(o_orderdate + INTERVAL 20 YEAR, '%Y-%m-%d %H:%M:%S') AS "dateCrawled",
  lpad(CAST(l_linenumber + 1 AS VARCHAR), 2, '0') || '/' || CAST(1971 + p_size AS VARCHAR) AS registration,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' kW' || CASE WHEN l_linenumber <> 1 THEN ' (' || CAST(CAST(l_quantity * 8 AS INTEGER) AS VARCHAR) || ' hp)' ELSE '' END AS power_text,
  '€ ' || format('{:,}', CAST(floor(l_extendedprice / 5) AS BIGINT)) AS price_text
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""


def with_listings(body: str, *ctes: str) -> str:
    """``body`` with ``listings`` (and further named CTEs) in scope."""
    return ",\n".join([f"WITH listings AS ({LISTINGS_SQL})", *ctes]) + "\n" + body


PREDICTIONS_CTE = """predictions AS (
  SELECT *, CAST(CASE WHEN l_partkey % 7 = 0 THEN (y_true + 1) % 3 WHEN l_orderkey % 11 = 0 THEN (y_true + 2) % 3 ELSE y_true END AS INTEGER) AS y_pred
  FROM (SELECT *, CAST(CASE WHEN price < 5000 THEN 0 WHEN price < 15000 THEN 1 ELSE 2 END AS INTEGER) AS y_true FROM listings))"""
