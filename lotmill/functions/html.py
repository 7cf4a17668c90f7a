"""Field extraction from saved listing pages with regular expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotmill.functions.text import _col, strip

_PAYLOAD = "STRUCT<props: STRUCT<pageProps: STRUCT<listings: ARRAY<STRUCT<url: STRING>>>>>"


def payload_links(html: Column | str, script_id: str = "__NEXT_DATA__") -> Column:
    """Listing URLs of the embedded JSON payload, in order; null without a readable payload."""
    body = F.regexp_extract(_col(html), rf'(?is)<script[^>]*\bid="{script_id}"[^>]*>(.*?)</script>', 1)
    listings = F.from_json(F.nullif(body, F.lit("")), _PAYLOAD)["props"]["pageProps"]["listings"]
    urls = F.transform(listings, lambda item: item["url"])
    return F.filter(urls, lambda u: u.isNotNull() & (u != ""))


def anchor_links(html: Column | str, containing: str = "/") -> Column:
    """``href`` values of anchors that contain a fragment, in page order."""
    pattern = rf'<a\b[^>]*?\bhref="([^"]*{re.escape(containing)}[^"]*)"'
    return F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(1))


def page_links(html: Column | str, base_url: str, containing: str = "/offers/") -> Column:
    """Payload links, else anchors; first occurrence kept, made absolute."""
    from_payload = payload_links(html)
    found = F.when(F.size(F.coalesce(from_payload, F.array().cast("array<string>"))) > 0, from_payload)
    return absolute_links(F.coalesce(found, anchor_links(html, containing)), base_url)


def absolute_links(links: Column, base_url: str) -> Column:
    return F.transform(
        F.array_distinct(links),
        lambda u: F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base_url), u)),
    )


def labelled_value(html: Column | str, label: str) -> Column:
    """Text of the ``<dd>`` after the ``<dt>`` with this label ('' when absent)."""
    pattern = rf"(?is)<dt[^>]*>\s*{re.escape(label)}\s*</dt>\s*<dd[^>]*>([^<]*)"
    return strip(F.regexp_extract(_col(html), pattern, 1))


def overview_value(html: Column | str, label: str, title_class: str = "itemTitle", text_class: str = "itemText") -> Column:
    """Value block that follows the title block with this label ('' when absent)."""
    pattern = (
        rf'(?is)<div[^>]*class="[^"]*{title_class}[^"]*"[^>]*>\s*{re.escape(label)}\s*</div>'
        rf'(?:(?!{title_class}).)*?<div[^>]*class="[^"]*{text_class}[^"]*"[^>]*>([^<]*)'
    )
    return strip(F.regexp_extract(_col(html), pattern, 1))


def element_text(html: Column | str, tag: str, css_class: str | None = None) -> Column:
    """Leading text of the first element with this tag (and class fragment)."""
    attributes = rf'[^>]*class="[^"]*{re.escape(css_class)}[^"]*"[^>]*' if css_class else r"[^>]*"
    return strip(F.regexp_extract(_col(html), rf"(?is)<{tag}\b{attributes}>([^<]*)", 1))
