"""Element trees: real pages and odd markup against independent readings."""

import re
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from lotmill.functions import elements as el

ODD = [
    None,
    "",
    "plain text &lt; no markup",
    "<dl><dt>Body <b>type</b></dt><dd class='v'><span>Estate &amp; <i>van</i></span></dd><dt>Power<dd>90 kW<dt>Doors<dd>5</dl>",
    "<!-- <dt>Power</dt><dd>none</dd> --><script>var t='<dt>Power</dt><dd>1</dd>';</script><DL><DT>POWER</DT>\n<DD> 7 </DD></DL>",
    "<div class='itemTitle x'>Fuel</div> text <div class='y itemText'>gas <div>and more</div></div><div class=itemTitle>Fuel2</div>",
    "<ul><li><a href='/a?x=1&amp;y=2'>1<li><a HREF=/b>2</a><ul><li><a href=\"/c\">3</a></ul><li><a href='/b'>4</a></ul><a name=n>5</a>",
    "<p>one<p>two<div>three</div></p>four<br>five<img src=x>six</i>",
    "<script type='application/json' id='__NEXT_DATA__'>{\"a\": \"</b>\"}</script>",
]


def _trees(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return df.withColumn("t", el.element_tree("html"))


def test_odd_markup(spark):
    t = F.col("t")
    rows = _trees(spark, ODD).select(
        "i", F.size("t").alias("size"), el.tree_labelled_value(t, "body type").alias("body"), el.tree_labelled_value(t, "Power").alias("power"),
        el.tree_labelled_value(t, "Doors").alias("doors"), el.tree_overview_value(t, "fuel").alias("fuel"), el.tree_overview_value(t, "Fuel2").alias("none"),
        el.tree_links(t).alias("links"), el.tree_payload(t).alias("payload"), el.first_text(t, "p").alias("p"),
    ).orderBy("i").collect()
    assert rows[0]["links"] is None and rows[0]["body"] == ""
    assert rows[1]["size"] == 0 and rows[2]["size"] == 1
    assert (rows[3]["body"], rows[3]["power"], rows[3]["doors"]) == ("Estate & van", "90 kW", "5")
    assert rows[4]["power"] == "7"
    assert rows[5]["fuel"] == "gas and more" and rows[5]["none"] == ""
    assert rows[6]["links"] == ["/a?x=1&y=2", "/b", "/c"]
    assert rows[7]["p"] == "one"
    assert rows[8]["payload"] == '{"a": "</b>"}'


def test_steps(spark):
    page = "<div id=top><p class='a b'>x<b>y</b></p><section><p>z</p></section>tail</div>"
    t = F.col("t")
    top = F.get(t, F.lit(0))
    row = _trees(spark, [page]).select(
        F.transform(el.children(t, top), lambda e: e["tag"]).alias("below"),
        F.transform(el.with_tag(t, "b"), lambda e: el.parent(t, e)["tag"]).alias("above"),
        F.transform(el.with_tag(t, "p"), lambda e: el.next_sibling(t, e)["tag"]).alias("beside"),
        F.transform(el.with_tag(t, "p"), lambda e: el.has_class(e, "b")).alias("is_b"),
        el.full_text(t, top).alias("all"),
    ).first()
    assert row["below"] == ["p", "section"] and row["above"] == ["p"] and row["beside"] == ["section", None]
    assert row["is_b"] == [True, False] and row["all"] == "xyztail"


def _outline(node):
    return [node.tag, dict(node.attrib), "".join(node.itertext()), [_outline(c) for c in node]]


def _from_rows(rows, at):
    row = rows[at]
    text = "".join(r["text"] for r in rows[at + 1:row["last"] + 1] if r["tag"] == "#text")
    return [row["tag"], dict(row["attributes"]), text, [_from_rows(rows, r["id"]) for r in rows if r["parent"] == at and r["tag"] != "#text"]]


def test_equals_an_xml_parser_on_closed_markup():
    page = "<div a='1' b='x &amp; y'>t<ul><li>1<b>2</b>3</li><li/></ul><!-- c --><dl><dt>k</dt><dd>v <i>w</i></dd></dl>u &lt; v</div>"
    rows = el.nodes_of(page.replace("<li/>", "<li></li>"))
    assert _from_rows(rows, 0) == _outline(ET.fromstring(page))


def test_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    t = F.col("t")
    found = pages.withColumn("t", el.element_tree("html")).select("html", el.tree_links(t).alias("links"), el.first_text(t, "title").alias("title"), t)
    for row in found.collect():
        cut = re.sub(r"(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", "", row["html"])
        expected = [u.replace("&amp;", "&") for u in re.findall(r'<a\b[^>]*?href="([^"]*)"', cut)]
        assert row["links"] == list(dict.fromkeys(u for u in expected if "/" in u))
        assert all(r["parent"] < r["id"] <= r["last"] for r in row["t"])
        assert sum(r["tag"] not in ("#text", "script", "style") for r in row["t"]) == len(re.findall(r"<[a-zA-Z]", cut))


def test_a_batch_of_pages_is_cut_slice_by_slice(monkeypatch):
    import pyarrow as pa

    seen, whole = [], el._as_arrow
    monkeypatch.setattr(el, "_as_arrow", lambda pages, kind: seen.append(len(pages)) or whole(pages, kind))
    pages = [f"<p class='k'>{i}</p>" for i in range(el.PAGES_AT_ONCE * 2)] + [None, ""]
    found = el._trees.func(pa.array(pages)).to_pylist()
    assert max(seen) == el.PAGES_AT_ONCE and len(seen) == 3
    assert found[-2:] == [None, []] and [f[1]["text"] for f in found[:-2]] == [str(i) for i in range(len(pages) - 2)]
    assert found[0][0]["attributes"] == [("class", "k")]
    assert len(el._trees.func(pa.array([], pa.string()))) == 0
