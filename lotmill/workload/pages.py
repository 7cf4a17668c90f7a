"""Field extraction from saved pages (family C18-C20, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmill.functions import elements, html
from lotmill.sources.tables import read_pages
from lotmill.workload.listings import table
from lotmill.workload.registry import query


@query("s7_page_fields", r"""SELECT page_id, url, trim(regexp_extract(html, '(?is)<title\b[^>]*>([^<]*)', 1)) AS title, trim(regexp_extract(html, '(?is)<h1\b[^>]*>([^<]*)', 1)) AS heading FROM pages""")
def s7(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", "url", html.element_text("html", "title").alias("title"), html.element_text("html", "h1").alias("heading"))


@query("c18_event_property", "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def c18(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("c18_payload_links", "SELECT page_id, unnest([0, 1]) AS pos, unnest([url, '/offers/' || page_id]) AS link FROM pages WHERE page_id % 3 <> 0")
def c18_payload(spark, sf):
    """Pages get an embedded payload made of their own columns; every third page gets none."""
    payload = F.concat(F.lit('<script type="application/json" id="__NEXT_DATA__">{"props":{"pageProps":{"listings":[{"url":"'), "url",
                       F.lit('"},{"url":""},{"id":1},{"url":"/offers/'), F.col("page_id").cast("string"), F.lit('"}]}}}</script>'))
    pages = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 3 != 0, F.concat(payload, "html")).otherwise(F.col("html")).alias("html"))
    return pages.select("page_id", F.posexplode(html.payload_links("html")).alias("pos", "link"))


_BASE = "http://listings.example.com"


@query("c19_anchor_links", rf"""SELECT page_id, CAST(min(i) AS INTEGER) AS pos, CASE WHEN starts_with(u, 'http') THEN u ELSE '{_BASE}' || u END AS link FROM (
 SELECT page_id, unnest(l) AS u, unnest(range(len(l))) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a\b[^>]*?\bhref="([^"]*/[^"]*)"', 1) AS l FROM pages)) GROUP BY page_id, u""")
def c19(spark, sf):
    found = table(spark, sf, "pages").select("page_id", F.posexplode(html.anchor_links("html")).alias("pos", "href"))
    first = found.groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    return first.select("page_id", "pos", F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(_BASE), "href")).alias("link"))


@query("c19_page_links", rf"""SELECT DISTINCT page_id, CASE WHEN starts_with(u, 'http') THEN u ELSE '{_BASE}' || u END AS link FROM (
 SELECT page_id, unnest(regexp_extract_all(html, '<a\b[^>]*?\bhref="([^"]*/[^"]*)"', 1)) AS u FROM pages)""")
def c19b(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(html.page_links("html", _BASE, "/")).alias("link"))


@query("c20_labelled_values", """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN url ELSE '' END AS body_type, CASE WHEN page_id % 3 <> 0 THEN page_id || ' kW' ELSE '' END AS power FROM pages""")
def c20(spark, sf):
    """Pages get label markup made of their own columns; every third page gets none."""
    markup = F.concat(F.lit('<dl><dt>Doors</dt><dd>5</dd><dt class="k"> Body type </dt>\n<dd class="v"> '), "url",
                      F.lit(' </dd></dl><div class="itemTitle">Fuel</div><div class="itemText">gas</div><div class="c itemTitle"> Power</div> <div class="itemText c"> '),
                      F.col("page_id").cast("string"), F.lit(" kW </div>"))
    pages = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 3 != 0, F.concat(markup, "html")).otherwise(F.col("html")).alias("html"))
    return pages.select("page_id", html.labelled_value("html", "Body type").alias("body_type"), html.overview_value("html", "Power").alias("power"))


# ---- element trees of the pages as they are ----------------------------------------------------

_CUT = r"""cut AS (SELECT page_id, html, regexp_replace(html, '(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS rest FROM pages)"""


def _decoded(text: str) -> str:
    # HTML reads &amp without a semicolon, too
    return f"regexp_replace(replace(replace(replace({text}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g')"


def _trees(spark, sf):
    return table(spark, sf, "pages").select("page_id", elements.element_tree("html").alias("nodes"))


@query("c19_tree_links", rf"""WITH {_CUT} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, CASE WHEN starts_with(u, 'http') THEN u ELSE '{_BASE}' || u END AS link FROM (
 SELECT page_id, u, min(i) AS i FROM (SELECT page_id, {_decoded('unnest(l)')} AS u, unnest(range(len(l))) AS i FROM (SELECT page_id, regexp_extract_all(rest, '(?i)<a\b[^>]*?\bhref="([^"]*/[^"]*)"', 1) AS l FROM cut)) GROUP BY page_id, u)""")
def c19_tree(spark, sf):
    links = html.absolute_links(elements.tree_links(F.col("nodes")), _BASE)
    return _trees(spark, sf).select("page_id", F.posexplode(links).alias("pos", "link"))


@query("c18_tree_scripts", r"""SELECT page_id, regexp_extract(html, '(?s)<script\b[^>]*>(.*?)</script>', 1) AS script FROM pages""")
def c18_tree(spark, sf):
    first = F.get(elements.with_tag(F.col("nodes"), "script"), F.lit(0))
    return _trees(spark, sf).withColumn("first", first).select(
        "page_id", F.when(F.col("first").isNotNull(), elements.full_text(F.col("nodes"), F.col("first"))).otherwise("").alias("script"))


@query("c20_tree_headings", rf"""WITH {_CUT} SELECT page_id, {_decoded("trim(regexp_extract(rest, '(?is)<title[^>]*>(.*?)</title>', 1))")} AS title,
 {_decoded("trim(regexp_replace(regexp_extract(rest, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'))")} AS heading FROM cut""")
def c20_tree(spark, sf):
    nodes = F.col("nodes")
    return _trees(spark, sf).select("page_id", elements.first_text(nodes, "title").alias("title"), elements.first_text(nodes, "h1").alias("heading"))


@query("c20_tree_link_places", rf"""WITH {_CUT} SELECT page_id, 'li' AS above, 'ul' AS above_that, CAST(len(l) AS BIGINT) AS links, CAST(len(l) - 1 AS BIGINT) AS followed FROM (SELECT page_id, regexp_extract_all(rest, '<li><a\b') AS l FROM cut) WHERE len(l) > 0""")
def c20_places(spark, sf):
    """Where links stand: kinds of the two elements above, and how many of those above have one of their kind behind them."""
    nodes = F.col("nodes")
    links = _trees(spark, sf).select("page_id", "nodes", F.explode(elements.with_tag(nodes, "a")).alias("link"))
    placed = links.withColumn("up", elements.parent(nodes, F.col("link")))
    steps = placed.select("page_id", F.col("up.tag").alias("above"), elements.parent(nodes, F.col("up"))["tag"].alias("above_that"),
                          (elements.next_sibling(nodes, F.col("up"))["tag"] == F.col("up.tag")).alias("next"))
    return steps.groupBy("page_id", "above", "above_that").agg(F.count(F.lit(1)).alias("links"), F.count(F.when(F.col("next"), 1)).alias("followed"))
