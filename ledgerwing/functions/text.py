"""Text recognition on columns: tickers, headlines, filing sections, reports.

Everything here is a row-local JVM expression, so it adds no shuffle and a
document is always read whole.  The ``(?U)`` and ``(?d)`` flags give Java
regexes Unicode white space and word boundaries, and newline-only line starts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.once import once

# --- Fixed values: patterns and word lists --------------------------------------
CASHTAG = r"(?U)\$([A-Z]{1,5})\b"
BARE_TICKER = r"(?U)\b([A-Z]{2,5})\b"
# fmt: off
TICKER_BLOCKLIST: tuple[str, ...] = (
    "AI", "ALL", "ARE", "ATH", "ATM", "BUY", "CALL", "CEO", "CFO", "CPI", "DD", "EOD", "EPS",
    "ETF", "EV", "FAQ", "FD", "FED", "FOMO", "FOR", "FYI", "GDP", "HODL", "HOLD", "IMO", "IPO",
    "IRA", "ITM", "LLC", "LOL", "MOON", "NOT", "NOW", "NYSE", "OTM", "PE", "PUT", "SEC", "SELL",
    "THE", "TLDR", "USA", "USD", "WSB", "YOLO", "YTD",
)
# fmt: on
CALL_TITLE = (
    r"(?iU)^(.+?)\s*\((?:[A-Z]+:\s*)?([A-Z.]{1,6})\)\s+Q([1-4])\s+(\d{4})\s+Earnings\s+Call"
)
QA_HEADING = r"(?iU)questions?\s*(?:&|and)\s*answers?"
ITEM_HEADER = r"(?Uimd)^\s*item\s+(\d{1,2}A?)\s*[.:—-]?\s"
FOOTNOTES = (
    r"(?iU)notes\s+to\s+(?:the\s+)?(?:condensed\s+)?consolidated\s+financial\s+statements"
)
ITEM_SECTIONS: dict[str, dict[str, str]] = {
    "10-K": {"1": "business", "1A": "risk_factors", "7": "mdna", "8": "financial_statements"},
    "10-Q": {"1": "financial_statements", "1A": "risk_factors", "2": "mdna"},
}
SECTION_NAMES = ("business", "risk_factors", "mdna", "financial_statements", "footnotes")
MIN_SECTION_CHARS = 200
RUBRIC = ("factual_grounding", "internal_consistency", "honesty", "specificity")
VERDICT = r"(?s)## Verdict\s*\n+(.+?)(?:\n##|\z)"
# --------------------------------------------------------------------------------

#: What Python and most tools strip from the ends of a text.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(_c(text), F.lit(WHITESPACE))


def squash(text: Column | str) -> Column:
    """Lower case with every white-space run as one blank."""
    return F.trim(F.regexp_replace(F.lower(_c(text)), r"(?U)\s+", " "))


def extract_tickers(text: Column | str, blocklist: Iterable[str] = TICKER_BLOCKLIST) -> Column:
    """Distinct probable tickers: cashtags first, then bare capitals.

    Cashtags are always taken; bare tokens only when not in ``blocklist``.
    """
    text = F.coalesce(_c(text), F.lit(""))
    tagged = F.regexp_extract_all(text, F.lit(CASHTAG), F.lit(1))
    bare = F.regexp_extract_all(text, F.lit(BARE_TICKER), F.lit(1))
    words = list(blocklist)
    if words:
        bare = F.array_except(bare, F.array(*[F.lit(w) for w in words]))
    return F.array_distinct(F.concat(tagged, bare))


def parse_title(title: Column | str) -> Column:
    """Call headline to ``struct<company,ticker,quarter,fiscal_year>``.

    An unrecognised headline becomes the company name; an empty one is
    ``unknown``.
    """
    title = F.coalesce(_c(title), F.lit(""))

    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(title, CALL_TITLE, i), F.lit(""))

    company = F.coalesce(strip(group(1)), F.nullif(title, F.lit("")), F.lit("unknown"))
    return F.struct(
        company.alias("company"),
        F.upper(group(2)).alias("ticker"),
        group(3).cast("int").alias("quarter"),
        group(4).cast("int").alias("fiscal_year"),
    )


def _section_of(form: Column, item: Column) -> Column:
    """Canonical section of an item number under a form type, else NULL."""
    result: Column = F.lit(None).cast("string")
    for form_type, items in ITEM_SECTIONS.items():
        name: Column = F.lit(None).cast("string")
        for number, section in items.items():
            name = F.when(item == number, F.lit(section)).otherwise(name)
        result = F.when(form == form_type, name).otherwise(result)
    return result


def filing_sections(
    df: DataFrame,
    text: str = "raw_text",
    form: str = "form_type",
    min_chars: int = MIN_SECTION_CHARS,
) -> DataFrame:
    """Add one column per canonical section of a filing text.

    The text is cut at every item header; the header list and the cut pieces
    come from the same pattern, so piece ``i + 1`` belongs to header ``i`` and
    a section ends at the next header of any item. Pieces shorter than
    ``min_chars`` are table-of-contents lines. The first long piece of a
    section wins. Footnotes run from their heading to the end of the document.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    items = F.regexp_extract_all(body, F.lit(ITEM_HEADER), F.lit(1))
    # The text before the first header has no item. Both arrays are arguments of
    # the zip: inside the lambda they would be evaluated once per element.
    zipped = F.arrays_zip(
        F.array_prepend(items, F.lit(None).cast("string")).alias("item"),
        F.split(body, ITEM_HEADER, -1).alias("part"),
    )
    named = F.transform(
        zipped,
        lambda z: F.struct(
            _section_of(F.col(form), F.upper(z["item"])).alias("name"), z["part"].alias("part")
        ),
    )
    wanted = F.filter(named, lambda p: p["name"].isNotNull())
    pieces = F.transform(
        wanted, lambda p: F.struct(p["name"].alias("name"), strip(p["part"]).alias("body"))
    )
    cut = once(
        df,
        _pieces=F.filter(pieces, lambda p: F.length(p["body"]) >= min_chars),
        _at=F.regexp_instr(body, F.lit(FOOTNOTES)),
    )
    cut = once(cut, _notes=F.when(F.col("_at") > 0, strip(F.substr(body, F.col("_at")))))
    def first_piece(name: str) -> Column:
        return F.get(F.filter(F.col("_pieces"), lambda p: p["name"] == name), F.lit(0))["body"]

    columns = {name: first_piece(name) for name in SECTION_NAMES[:-1]}
    columns["footnotes"] = F.when(F.length("_notes") >= min_chars, F.col("_notes"))
    return cut.withColumns(columns).drop("_pieces", "_at", "_notes")


def sections_map(*names: str) -> Column:
    """Map of the section columns that were found; missing ones are left out."""
    names = names or SECTION_NAMES
    cells: list[Column] = []
    for n in names:
        cells += [F.lit(n), F.col(n)]
    return F.map_filter(F.create_map(*cells), lambda _, v: v.isNotNull())


def present_sections(sections: Column | str = "sections") -> Column:
    """Sorted names of the non-empty sections in a map."""
    kept = F.map_filter(_c(sections), lambda _, v: v.isNotNull() & (v != ""))
    return F.array_sort(F.map_keys(kept))


def parse_report(report: Column | str) -> dict[str, Column]:
    """Rubric scores (last mention wins) and the verdict paragraph of a report."""
    report = _c(report)
    out: dict[str, Column] = {}
    for dim in RUBRIC:
        hits = F.regexp_extract_all(report, F.lit(rf"(?U)\|\s*{dim}\s*\|\s*(\d+)/5\s*\|"), F.lit(1))
        out[dim] = F.try_element_at(hits, F.lit(-1)).cast("int")
    out["verdict"] = strip(F.regexp_extract(report, VERDICT, 1))
    return out
