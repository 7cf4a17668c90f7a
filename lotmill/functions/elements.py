"""Pages as element trees: one Arrow pass cuts the markup, selections are column expressions over the nodes.

A page becomes an array of nodes in document order: ``id`` (place in the array), ``parent`` (-1 for the top), ``last`` (largest
id below the node), ``tag`` (lower case; ``#text`` for text), ``attributes`` (names in lower case, first one wins, entities
decoded) and ``text`` (of text nodes only, entities decoded; script and style bodies as they stand). Comments, declarations
and end tags without a start leave no node. Elements without end tags follow HTML's rules: void elements hold nothing; a new
``p``, ``li``, ``dt``, ``dd``, ``tr``, ``td``, ``th`` or ``option`` ends an open one of its kind inside the same list, table or box.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lotmill.functions.text import _col, strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = T.ArrayType(T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("parent", T.IntegerType()), T.StructField("last", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())), T.StructField("text", T.StringType())]))

PAGES_AT_ONCE = 64

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "option": ("option",)}
BOXES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
         "thead": ("table",), "tbody": ("table",), "option": ("select",)}
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                           "section table ul".split())
BLOCKS = frozenset("body html table td th button caption".split())


class _Nodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []

    def _add(self, tag: str, attributes: dict | None, text: str | None) -> int:
        self.rows.append({"id": len(self.rows), "parent": self.open[-1] if self.open else -1, "last": len(self.rows),
                          "tag": tag, "attributes": attributes, "text": text})
        return len(self.rows) - 1

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.rows[node]["last"] = len(self.rows) - 1
        del self.open[depth:]

    def _end_open(self, tags, boxes) -> None:
        """Ends the outermost open element of these kinds inside the nearest box."""
        found = None
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.rows[self.open[depth]]["tag"]
            if tag in boxes:
                break
            if tag in tags:
                found = depth
        if found is not None:
            self._close(found)

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            self._end_open(ENDS[tag], BOXES[tag])
        if tag in ENDS_PARAGRAPH:
            self._end_open(("p",), BLOCKS)
        attributes: dict = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        node = self._add(tag, attributes, None)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]]["tag"] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        top = self.rows[-1] if self.rows else None
        if top and top["tag"] == "#text" and top["parent"] == (self.open[-1] if self.open else -1):
            top["text"] += data
        else:
            self._add("#text", None, data)


def nodes_of(page: str | None) -> list[dict] | None:
    if page is None:
        return None
    parser = _Nodes()
    parser.feed(page)
    parser.close()
    parser._close(0)
    return parser.rows


def _as_arrow(pages: list[str | None], kind: pa.DataType) -> pa.Array:
    trees = map(nodes_of, pages)
    return pa.array([t and [{**n, "attributes": None if n["attributes"] is None else list(n["attributes"].items())} for n in t] for t in trees], kind)


@F.arrow_udf(NODES)
def _trees(pages: pa.Array) -> pa.Array:
    """A batch holds thousands of pages: only those of one slice are Python objects at a time."""
    kind = to_arrow_type(NODES)
    slices = [_as_arrow(pages.slice(i, PAGES_AT_ONCE).to_pylist(), kind) for i in range(0, len(pages), PAGES_AT_ONCE)]
    return pa.concat_arrays(slices) if slices else pa.array([], kind)


def element_tree(html: Column | str) -> Column:
    """The nodes of a page; null for null, empty for ''. Keep it as a column of its own, so that it is built once."""
    return _trees(_col(html))


def with_tag(nodes: Column, *tags: str) -> Column:
    return F.filter(nodes, lambda e: e["tag"].isin(*tags))


def has_class(node: Column, name: str) -> Column:
    """Whether the blank-separated class list holds ``name``."""
    return F.coalesce(F.array_contains(F.split(node["attributes"]["class"], r"[\t\n\f\r ]+"), name), F.lit(False))


def children(nodes: Column, node: Column) -> Column:
    return F.filter(nodes, lambda e: (e["parent"] == node["id"]) & (e["tag"] != "#text"))


def parent(nodes: Column, node: Column) -> Column:
    """The element above, null at the top."""
    return F.get(nodes, node["parent"])


def next_sibling(nodes: Column, node: Column) -> Column:
    """The next element below the same parent, null for the last one."""
    return F.get(F.filter(nodes, lambda e: (e["id"] > node["last"]) & (e["parent"] == node["parent"]) & (e["tag"] != "#text")), F.lit(0))


def inside(nodes: Column, node: Column) -> Column:
    """All nodes below an element: a run of the array."""
    return F.slice(nodes, node["id"] + 2, node["last"] - node["id"])


def full_text(nodes: Column, node: Column) -> Column:
    """All text below an element, in document order."""
    return F.array_join(F.transform(F.filter(inside(nodes, node), lambda e: e["tag"] == "#text"), lambda e: e["text"]), "")


def first_text(nodes: Column, tag: str, css_class: str | None = None) -> Column:
    """Text of the first element of this kind ('' when absent)."""
    found = F.filter(nodes, lambda e: (e["tag"] == tag) & (has_class(e, css_class) if css_class else F.lit(True)))
    texts = F.transform(F.slice(found, 1, 1), lambda e: full_text(nodes, e))
    return F.coalesce(strip(F.get(texts, F.lit(0))), F.lit(""))


def tree_links(nodes: Column, containing: str = "/") -> Column:
    """``href`` of anchors that contain a fragment, in page order, first occurrence kept."""
    refs = F.transform(with_tag(nodes, "a"), lambda e: e["attributes"]["href"])
    return F.array_distinct(F.filter(refs, lambda u: F.coalesce(F.contains(u, F.lit(containing)), F.lit(False))))


def tree_payload(nodes: Column, script_id: str = "__NEXT_DATA__") -> Column:
    """Body of the first script with this id, null without one."""
    found = F.filter(nodes, lambda e: (e["tag"] == "script") & F.coalesce(e["attributes"]["id"] == script_id, F.lit(False)))
    return F.get(F.transform(F.slice(found, 1, 1), lambda e: full_text(nodes, e)), F.lit(0))


def _same(text: Column, label: str) -> Column:
    return F.lower(strip(text)) == label.strip().lower()


def tree_labelled_value(nodes: Column, label: str) -> Column:
    """Text of the ``dd`` right behind the first ``dt`` with this label, in any case and nesting ('' when absent)."""
    terms = F.filter(with_tag(nodes, "dt"), lambda e: _same(full_text(nodes, e), label))
    return _value_behind(nodes, terms, lambda e: e["tag"] == "dd")


def tree_overview_value(nodes: Column, label: str, title_class: str = "itemTitle", text_class: str = "itemText") -> Column:
    """Text of the value block that is the next sibling of the title block with this label ('' when absent)."""
    titles = F.filter(nodes, lambda e: has_class(e, title_class) & _same(full_text(nodes, e), label))
    return _value_behind(nodes, titles, lambda e: has_class(e, text_class))


def _value_behind(nodes: Column, found: Column, fits) -> Column:
    behind = F.filter(F.transform(found, lambda e: next_sibling(nodes, e)), lambda e: e.isNotNull() & fits(e))
    return F.coalesce(strip(F.get(F.transform(F.slice(behind, 1, 1), lambda e: full_text(nodes, e)), F.lit(0))), F.lit(""))
