"""Alignment and union of the two listing sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.numeric import cpi_price, tier
from lotmill.functions.text import first_year, horsepower, leading_year
from lotmill.operators.project import rename, require_columns, with_source


def align_archive(df: DataFrame) -> DataFrame:
    """Source A: provenance, names, prices restated by the index of the crawl year, tier."""
    df = rename(with_source(df, "kaggle"), {"powerPS": "power"})
    priced = df.withColumn("price", cpi_price("price", leading_year("dateCrawled")))
    return priced.withColumn("price_tier", tier("price"))


def align_scraped(df: DataFrame) -> DataFrame:
    """Source B: provenance, names, numbers pulled out of text, tier (prices stay as they are)."""
    df = rename(with_source(df, "crawled"), {"mileage": "kilometer"})
    return df.withColumns({
        "power": horsepower("power"),
        "yearOfRegistration": first_year("year"),
        "price_tier": tier("price"),
    })


def union_sources(archive: DataFrame, scraped: DataFrame, columns=rules.LISTING_COLUMNS) -> DataFrame:
    a, b = align_archive(archive), align_scraped(scraped)
    return require_columns(a, columns).unionByName(require_columns(b, columns))


def merge_files(spark, archive_path: str, scraped_path: str, out_path: str, out_format: str = "parquet") -> DataFrame:
    """Read both CSV sources, align, union and write; returns the written table."""
    from lotmill.sources.tables import read_csv, read_table, write_table

    archive = read_csv(spark, archive_path, encoding="ISO-8859-1")
    scraped = read_csv(spark, scraped_path)
    archive = archive.withColumns({
        "price": F.col("price").try_cast("double"), "powerPS": F.col("powerPS").try_cast("double"),
        "kilometer": F.col("kilometer").try_cast("double"), "yearOfRegistration": F.col("yearOfRegistration").try_cast("int"),
    })
    scraped = scraped.withColumns({
        "price": F.col("price").try_cast("double"), "mileage": F.col("mileage").try_cast("double"),
    })
    write_table(union_sources(archive, scraped), out_path, out_format)
    return read_table(spark, out_path, out_format)
