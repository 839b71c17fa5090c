"""HTML tokenising inside tasks.

Spark has no HTML reader, so a small standard-library tokeniser runs over Arrow
batches. It only turns markup into text, table cells or a flat element list;
every decision about those pieces is made in Spark afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the tokenisers with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements whose text is not shown, and elements that have no end tag.
SILENT = ("script", "style", "template")
_SILENT = set(SILENT)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "div", "article", "section", "ul", "ol", "table"}


class _Text(HTMLParser):
    """Text nodes in document order, without scripts, styles and comments."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self._muted: str | None = None

    def handle_starttag(self, tag, attrs):
        if self._muted is None and tag in _SILENT:
            self._muted = tag

    def handle_endtag(self, tag):
        if tag == self._muted:
            self._muted = None

    def handle_data(self, data):
        if self._muted is None:
            self.nodes.append(data)


class _Nodes(HTMLParser):
    """Text nodes in document order, each with the names of the elements that are open around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self._open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            self._open[tag] = self._open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if self._open.get(tag, 0) > 1:
            self._open[tag] -= 1
        else:
            self._open.pop(tag, None)

    def handle_data(self, data):
        self.nodes.append({"within": list(self._open), "text": data})


class _Outline(_Text):
    """h1 headline, and the h2/p elements of the first article body."""

    def __init__(self) -> None:
        super().__init__()
        self.headline: list[str] | None = None
        self._h1_open = False
        self._body_depth = 0
        self._body_tag = ""
        self._items: dict[str, list[dict]] = {"article": [], "div": []}
        self.has_article = self.has_div = False
        self._open: dict | None = None
        self._inline: list[str] = []

    def _close_block(self) -> None:
        self._open, self._inline = None, []

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if tag == "h1" and self.headline is None:
            self.headline, self._h1_open = [], True
        classes = (dict(attrs).get("class") or "").split()
        kind = "article" if tag == "article" else "div" if tag == "div" and "article-body" in classes else ""
        first = (kind == "article" and not self.has_article) or (kind == "div" and not self.has_div)
        if self._body_depth:
            if tag == self._body_tag:
                self._body_depth += 1
        elif first:
            self._body_depth, self._body_tag, self._kind = 1, tag, kind
            self.has_article |= kind == "article"
            self.has_div |= kind == "div"
        if tag in _BLOCKS:
            self._close_block()
        if self._body_depth and tag in ("h2", "p"):
            self._open = {"tag": tag, "text": [], "strong": None, "em": None}
            self._items[self._kind].append(self._open)
        elif self._open is not None and tag in ("strong", "b", "em"):
            slot = "em" if tag == "em" else "strong"
            if self._open[slot] is None:
                self._open[slot] = []
                self._inline.append(tag)

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        if tag == "h1":
            self._h1_open = False
        if tag in self._inline:
            self._inline.remove(tag)
        if tag in _BLOCKS:
            self._close_block()
        if self._body_depth and tag == self._body_tag:
            self._body_depth -= 1

    def handle_data(self, data):
        if self._muted is not None:
            return
        if self._h1_open:
            self.headline.append(data.strip())
        if self._open is not None:
            piece = data.strip()
            if piece:
                self._open["text"].append(piece)
                for tag in self._inline:
                    self._open["em" if tag == "em" else "strong"].append(piece)

    def outline(self) -> dict:
        # An article element wins over an article-body division.
        kind = "article" if self.has_article else "div"
        return {
            "headline": "".join(self.headline or []),
            "has_body": self.has_article or self.has_div,
            "elements": [
                {
                    "tag": e["tag"],
                    "tight": "".join(e["text"]),
                    "spaced": " ".join(e["text"]),
                    "strong": None if e["strong"] is None else "".join(e["strong"]),
                    "em": None if e["em"] is None else "".join(e["em"]),
                }
                for e in self._items[kind]
            ],
        }


class _Table(_Text):
    """Cell texts of the table with a wanted id, else the first of a wanted class."""

    def __init__(self, table_id: str, table_class: str) -> None:
        super().__init__()
        self._want = (table_id, table_class)
        self.by_id: list[list[str]] | None = None
        self.by_class: list[list[str]] | None = None
        self._stack: list[list | None] = []
        self._row: list[str] | None = None
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if tag == "table":
            attrs = dict(attrs)
            rows: list | None = None
            if self.by_id is None and attrs.get("id") == self._want[0]:
                rows = self.by_id = []
            elif self.by_class is None and self._want[1] in (attrs.get("class") or "").split():
                rows = self.by_class = []
            self._stack.append(rows)
        elif tag == "tr" and self._stack and self._stack[-1] is not None:
            self._row, self._cell = [], None
            self._stack[-1].append(self._row)
        elif tag == "td" and self._row is not None:
            self._cell = []
            self._row.append(self._cell)
        elif tag == "th":
            self._cell = None

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        if tag == "table" and self._stack:
            self._stack.pop()
            self._row = self._cell = None
        elif tag == "td":
            self._cell = None
        elif tag == "tr":
            self._row = self._cell = None

    def handle_data(self, data):
        if self._muted is None and self._cell is not None:
            self._cell.append(data.strip())

    def rows(self) -> list[list[str]] | None:
        found = self.by_id if self.by_id is not None else self.by_class
        return None if found is None else [["".join(cell) for cell in row] for row in found]


def _fed(parser: HTMLParser, html: str) -> HTMLParser:
    parser.feed(html)
    parser.close()
    return parser


NODES_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("within", T.ArrayType(T.StringType())), T.StructField("text", T.StringType())]
    )
)


@F.pandas_udf(NODES_TYPE)
def _nodes_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for html in batches:
        yield html.map(lambda h: None if h is None else _fed(_Nodes(), h).nodes)


OUTLINE_TYPE = T.StructType(
    [
        T.StructField("headline", T.StringType()),
        T.StructField("has_body", T.BooleanType()),
        T.StructField(
            "elements",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(n, T.StringType())
                        for n in ("tag", "tight", "spaced", "strong", "em")
                    ]
                )
            ),
        ),
    ]
)


@F.pandas_udf(OUTLINE_TYPE)
def _outline_udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for html in batches:
        rows = [_fed(_Outline(), h or "").outline() for h in html]
        yield pd.DataFrame(rows, columns=["headline", "has_body", "elements"])


def html_nodes(html: Column | str) -> Column:
    """The text nodes of a page, each with the names of the open elements around it."""
    return _nodes_udf(html)


def html_to_text(html: Column | str, silent: Sequence[str] = SILENT, separator: str = "\n") -> Column:
    """Text nodes of a page joined by line feeds, without those inside ``silent`` elements."""
    muted = F.array(*[F.lit(t) for t in silent])
    shown = F.filter(html_nodes(html), lambda n: ~F.arrays_overlap(n["within"], muted))
    return F.array_join(F.transform(shown, lambda n: n["text"]), separator)


def html_outline(html: Column | str) -> Column:
    """Headline and body elements of an article page."""
    return _outline_udf(html)


def html_table(
    html: Column | str, table_id: str = "constituents", table_class: str = "wikitable"
) -> Column:
    """Rows of data-cell texts of one table of a page; NULL without such a table."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def rows_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(lambda h: _fed(_Table(table_id, table_class), h or "").rows())

    return rows_udf(html)
