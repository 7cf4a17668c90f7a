import math

import pytest
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions import html, numeric as num, text as txt


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make("v").alias("r")).first()["r"]


@pytest.mark.parametrize("price,expected", [(4999.99, "budget"), (5000.0, "mid-range"), (14999.99, "mid-range"), (15000.0, "luxury"), (None, "luxury")])
def test_tier_boundaries(spark, price, expected):
    assert one(spark, price, num.tier, "double") == expected


def test_cpi_price_and_unknown_year(spark):
    df = spark.createDataFrame([(10_000.0, 2020)], "p double, y int")
    assert df.select(num.cpi_price("p", "y").alias("r")).first()["r"] == pytest.approx(14790.0)
    bad = spark.createDataFrame([(1.0, 1999)], "p double, y int")
    with pytest.raises(Exception, match="No CPI entry for year 1999"):
        bad.select(num.cpi_price("p", "y").alias("r")).collect()


@pytest.mark.parametrize("raw,expected", [
    ("  VW ", "volkswagen"), ("alfa_romeo", "alfa-romeo"), ("sonstige-autos", None), ("keine_angabe", "keine-angabe"), ("Škoda!", "škoda"), ("\tBMW\n", "bmw"), (None, None),
])
def test_brand_name(spark, raw, expected):
    assert one(spark, raw, txt.brand_name) == expected


@pytest.mark.parametrize("raw,expected", [("Käfer", "beetle"), ("up!", "up"), ("3er", "3-series"), ("!!", None), ("sonstige", None), ("Golf", "golf")])
def test_model_name(spark, raw, expected):
    assert one(spark, raw, txt.model_name) == expected


def test_category_and_placeholders(spark):
    assert one(spark, " SUV/Off-Road/Pick-Up", lambda c: txt.category(c, rules.VEHICLE_ALIASES)) == "suv"
    assert one(spark, "Station Wagon", lambda c: txt.category(c, rules.VEHICLE_ALIASES)) == "station-wagon"
    assert one(spark, " N/A ", txt.blank_placeholders) is None
    assert one(spark, " golf ", txt.blank_placeholders) == "golf"


@pytest.mark.parametrize("raw,hp,fallback", [("85 kW (115 hp)", 115.0, 115), ("85 kW", None, 85), ("none", None, None)])
def test_horsepower(spark, raw, hp, fallback):
    assert one(spark, raw, txt.horsepower) == hp
    assert one(spark, raw, txt.horsepower_or_digits) == fallback


def test_years_and_digits(spark):
    assert one(spark, "02/2017", txt.first_year) == 2017
    assert one(spark, "02/2017", txt.year_after_slash) == 2017
    assert one(spark, "€ 35,950", txt.digits_only) == "35950"
    assert one(spark, None, txt.year_of_registration) is None
    with pytest.raises(Exception, match="no four-digit year"):
        one(spark, "soon", txt.year_of_registration)


def test_right_closed_band(spark):
    band = lambda c: num.right_closed_band(c, [0, 3500, 12000, math.inf], rules.TIERS)
    assert [one(spark, v, band, "double") for v in (0.0, 3500.0, 3500.01, 12000.0, 9e9)] == [None, "budget", "mid-range", "mid-range", "luxury"]


def test_normal_cdf(spark):
    for z in (-8.5, -3.0, -0.5, 0.0, 1.0, 2.5, 7.5):
        assert one(spark, z, lambda c: num.normal_cdf(F.col(c)), "double") == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-9)


PAYLOAD = '<script id="__NEXT_DATA__" type="x">{"props":{"pageProps":{"listings":[{"url":"/offers/a"},{"url":"http://x/b"},{"url":"/offers/a"}]}}}</script>'


def test_page_links(spark):
    links = lambda c: html.page_links(c, "http://base")
    assert one(spark, PAYLOAD, links) == ["http://base/offers/a", "http://x/b"]
    anchors = '<a class="k" href="/offers/1">x</a><a href="/other">y</a><a href="/offers/1">z</a><a href="http://q/offers/2">w</a>'
    assert one(spark, anchors, links) == ["http://base/offers/1", "http://q/offers/2"]
    assert one(spark, "<p>none</p>", links) == []


def test_labelled_values(spark):
    page = '<dl><dt class="t"> Body Type </dt><dd>Sedan </dd></dl><div><div class="X_itemTitle__1">Mileage</div><div></div><div class="X_itemText__2"> 30,140 km</div></div>'
    assert one(spark, page, lambda c: html.labelled_value(c, "body type")) == "Sedan"
    assert one(spark, page, lambda c: html.overview_value(c, "Mileage")) == "30,140 km"
    assert one(spark, page, lambda c: html.labelled_value(c, "Colour")) == ""
