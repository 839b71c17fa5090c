"""Landed documents to rows: facts, filing indexes, macro, options, posts, pages.

Each function takes a DataFrame with one document per row and only uses
row-local expressions and ``explode``; pages of one feed are simply more rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import EVENT_STREAMS
from ..functions.html import html_outline, html_table, html_to_text
from ..functions.scalars import exchange_ticker, pad_cik
from ..operators.dedup import top_per_key
from ..operators.once import once
from ..functions.text import QA_HEADING, extract_tickers, filing_sections, parse_title

# --- Fixed values ---------------------------------------------------------------
DEFAULT_FORMS = ("10-K", "10-Q", "8-K", "DEF 14A", "S-1")
TRACKED_SERIES = ("FEDFUNDS", "CPIAUCSL", "UNRATE", "GDP", "DGS10", "T10Y2Y")
ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data/"
FACTS_JSON = (
    "map<string, map<string, struct<units: map<string, array<struct<"
    "start: string, end: string, val: double, fy: int, fp: string, form: string, filed: string>>>>>>"
)
SUBMISSIONS_JSON = (
    "struct<name: string, sic: string, sicDescription: string, filings: struct<"
    "recent: struct<accessionNumber: array<string>, form: array<string>, "
    "filingDate: array<string>, primaryDocument: array<string>>, "
    "files: array<struct<name: string, filingFrom: string, filingTo: string>>>>"
)
INDEX_JSON = (
    "struct<accessionNumber: array<string>, form: array<string>, "
    "filingDate: array<string>, primaryDocument: array<string>>"
)
MACRO_JSON = "struct<observations: array<struct<date: string, value: string>>>"
CHAIN_JSON = (
    "struct<results: array<struct<details: struct<ticker: string, contract_type: string, "
    "strike_price: string, expiration_date: string>, day: struct<volume: double>, "
    "open_interest: double, implied_volatility: double>>>"
)
HITS_JSON = (
    "struct<hits: struct<hits: array<struct<_id: string, _source: struct<ciks: array<string>, "
    "file_type: string, file_date: string, display_names: array<string>>>>>>"
)
MAX_SPEAKER_CHARS = 120
# --------------------------------------------------------------------------------


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def explode_facts(df: DataFrame, payload: str = "payload", key: str = "cik") -> DataFrame:
    """Nested facts JSON (taxonomy, concept, unit, list) to one row per fact.

    ``pos`` is the place in the list, which decides among facts filed on one day.
    """
    # The parse is the generator's own input, so no filter repeats it.
    facts = F.coalesce(F.from_json(payload, FACTS_JSON), F.create_map().cast(FACTS_JSON))
    concepts = df.select(key, F.explode(facts).alias("taxonomy", "concepts"))
    units = concepts.select(key, "taxonomy", F.explode("concepts").alias("concept", "body"))
    lists = units.select(key, "taxonomy", "concept", F.explode("body.units").alias("unit", "items"))
    rows = lists.select(
        key, "taxonomy", "concept", "unit", F.posexplode("items").alias("pos", "f")
    )
    return rows.select(
        key,
        "taxonomy",
        "concept",
        "unit",
        F.col("pos").cast("long").alias("pos"),
        F.col("f.start").try_cast("date").alias("start"),
        F.col("f.end").try_cast("date").alias("end"),
        "f.val",
        "f.fy",
        "f.fp",
        "f.form",
        F.col("f.filed").try_cast("date").alias("filed"),
    )


def index_rows(df: DataFrame, block: Column | str, keep: Sequence[str] = ("cik",)) -> DataFrame:
    """Parallel filing arrays to filing rows; unequal lengths are an error.

    ``block`` is a struct of the four arrays. Builds the document address from
    the registry number without zeros and the accession number without dashes.
    """
    arrays = ("accessionNumber", "form", "filingDate", "primaryDocument")
    block = _c(block)
    sizes = [F.size(F.coalesce(block[a], F.array())) for a in arrays]
    uneven = (sizes[0] != sizes[1]) | (sizes[0] != sizes[2]) | (sizes[0] != sizes[3])
    zipped = F.arrays_zip(*[block[a].alias(a) for a in arrays])
    guarded = F.when(
        uneven, F.raise_error(F.lit("filing index arrays differ in length"))
    ).otherwise(zipped)
    rows = df.select(*keep, F.explode(guarded).alias("r"))
    return rows.select(
        *keep,
        F.col("r.accessionNumber").alias("accession_number"),
        F.col("r.form").alias("form_type"),
        F.col("r.filingDate").cast("date").alias("filing_date"),
        F.col("r.primaryDocument").alias("primary_document"),
        F.concat(
            F.lit(ARCHIVE_URL),
            F.col("cik").cast("long").cast("string"),
            F.lit("/"),
            F.replace(F.col("r.accessionNumber"), F.lit("-"), F.lit("")),
            F.lit("/"),
            F.col("r.primaryDocument"),
        ).alias("document_url"),
    )


def filing_index(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ("cik",)) -> DataFrame:
    """Filing rows of the recent block of submissions JSON documents."""
    parsed = df.select(*keep, F.from_json(payload, SUBMISSIONS_JSON).alias("s"))
    return index_rows(parsed, F.col("s.filings.recent"), keep)


def prune_archives(
    archives: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Archive pages whose date range may overlap the window; open ends pass.

    Without a start date no archive is needed.
    """
    if start is None:
        return archives.where(F.lit(False))
    to, frm = F.col("filing_to"), F.col("filing_from")
    keep = to.isNull() | (to >= F.lit(start))
    if end is not None:
        keep = keep & (frm.isNull() | (frm <= F.lit(end)))
    return archives.where(keep)


def list_filings(
    df: DataFrame,
    form_types: Sequence[str] = DEFAULT_FORMS,
    start: date | None = None,
    end: date | None = None,
    limit_per_ticker: int | None = None,
    key: str = "ticker",
) -> DataFrame:
    """Filings by form and inclusive date range; with a limit the newest of each ``key``."""
    keep = F.col("form_type").isin(*form_types)
    if start is not None:
        keep = keep & (F.col("filing_date") >= F.lit(start))
    if end is not None:
        keep = keep & (F.col("filing_date") <= F.lit(end))
    found = df.where(keep)
    if limit_per_ticker is None:
        return found
    newest = [F.col("filing_date").desc(), F.col("accession_number")]
    return top_per_key(found, [key], newest, limit_per_ticker)


def newest_filings(filings: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` newest filings of all companies; of one day those with the first accession numbers."""
    return filings.orderBy(F.col("filing_date").desc(), "accession_number").limit(n)


def filing_listing(
    submissions: DataFrame,
    archives: DataFrame,
    form_types: Sequence[str] = DEFAULT_FORMS,
    start: date | None = None,
    end: date | None = None,
    limit_per_company: int | None = None,
) -> DataFrame:
    """The complete index of each company: its recent block and its archive pages.

    ``submissions(cik, payload)`` holds the main documents, which name the archive
    pages of older filings with their date ranges; ``archives(cik, name, payload)``
    holds the pages. Only pages that may overlap the window are parsed. A filing
    that stands in both is one row. Newest first per company.
    """
    recent = filing_index(submissions)
    parsed = submissions.select("cik", F.from_json("payload", SUBMISSIONS_JSON).alias("s"))
    named = parsed.select("cik", F.explode("s.filings.files").alias("f")).select(
        "cik",
        "f.name",
        F.col("f.filingFrom").try_cast("date").alias("filing_from"),
        F.col("f.filingTo").try_cast("date").alias("filing_to"),
    )
    pages = archives.join(prune_archives(named, start, end).select("cik", "name"), ["cik", "name"], "left_semi")
    blocks = pages.select("cik", F.from_json("payload", INDEX_JSON).alias("block"))
    both = recent.unionByName(index_rows(blocks, "block")).dropDuplicates(["cik", "accession_number"])
    found = list_filings(both, form_types, start, end, limit_per_company, key="cik")
    return found.orderBy("cik", F.col("filing_date").desc(), "accession_number")


def parse_macro(
    df: DataFrame,
    payload: str = "payload",
    series: Sequence[str] | None = TRACKED_SERIES,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Macro observation documents to rows; ``.`` means missing and is skipped."""
    rows = df.select(
        "series_id", F.explode(F.from_json(payload, MACRO_JSON)["observations"]).alias("o")
    ).select(
        "series_id",
        F.col("o.date").try_cast("date").alias("observation_date"),
        F.coalesce(F.col("o.value"), F.lit(".")).alias("raw_value"),
    )
    keep = F.col("raw_value") != "."
    if series is not None:
        keep = keep & F.col("series_id").isin(*series)
    if start is not None:
        keep = keep & (F.col("observation_date") >= F.lit(start))
    if end is not None:
        keep = keep & (F.col("observation_date") <= F.lit(end))
    return rows.where(keep).select(
        "series_id", "observation_date", F.col("raw_value").try_cast("double").alias("value")
    )


def macro_skips(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Missing observations per series."""
    rows = df.select(
        "series_id", F.explode(F.from_json(payload, MACRO_JSON)["observations"]).alias("o")
    )
    return rows.groupBy("series_id").agg(
        F.count_if(F.coalesce(F.col("o.value"), F.lit(".")) == ".").alias("skipped")
    )


def parse_chain(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Option chain pages to contracts.

    A contract without ticker, type, strike or expiry (or with an unreadable
    one) is skipped; missing volume or open interest counts as zero.
    """
    rows = df.select(
        F.upper("underlying").alias("underlying"),
        F.explode(F.from_json(payload, CHAIN_JSON)["results"]).alias("r"),
    ).select(
        "underlying",
        F.col("r.details.ticker").alias("contract_ticker"),
        F.col("r.details.contract_type").alias("contract_type"),
        F.col("r.details.strike_price").try_cast("double").alias("strike"),
        F.col("r.details.expiration_date").try_cast("date").alias("expiration"),
        F.coalesce(F.col("r.day.volume"), F.lit(0.0)).cast("long").alias("day_volume"),
        F.coalesce(F.col("r.open_interest"), F.lit(0.0)).cast("long").alias("open_interest"),
        F.col("r.implied_volatility").alias("implied_volatility"),
    )
    return rows.dropna(subset=["contract_ticker", "contract_type", "strike", "expiration"])


def unusual_activity(
    contracts: DataFrame, min_volume: int = 100, threshold: float = 3.0
) -> DataFrame:
    """Contracts whose volume is large against open interest.

    With no open interest the volume itself is the ratio.
    """
    volume, interest = F.col("day_volume"), F.col("open_interest")
    ratio = F.when(interest > 0, volume.cast("double") / interest).otherwise(volume.cast("double"))
    return contracts.withColumn("volume_oi_ratio", ratio).where(
        (volume >= min_volume) & (F.col("volume_oi_ratio") >= threshold)
    )


def shape_posts(df: DataFrame) -> DataFrame:
    """Forum submissions to posts with UTC time and extracted tickers."""
    text = F.concat_ws(
        "\n", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))
    )
    return df.select(
        "post_id",
        "subreddit",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("body", F.lit("")).alias("body"),
        F.coalesce(F.col("score").cast("int"), F.lit(0)).alias("score"),
        F.coalesce(F.col("num_comments").cast("int"), F.lit(0)).alias("num_comments"),
        F.timestamp_seconds("created_utc").alias("created_at"),
        extract_tickers(text).alias("tickers"),
    )


def explode_mentions(posts: DataFrame) -> DataFrame:
    """One row per post and mentioned ticker."""
    rest = [c for c in posts.columns if c not in ("tickers", "body")]
    # The outer form keeps Catalyst from repeating the extraction in a filter.
    rows = posts.select(*rest, F.explode_outer("tickers").alias("ticker"))
    return rows.where(F.col("ticker").isNotNull())


def explode_segments(transcripts: DataFrame) -> DataFrame:
    """One row per speaker turn, numbered from 1."""
    rest = [c for c in transcripts.columns if c != "segments"]
    # The outer form keeps Catalyst from repeating the parse in a filter.
    rows = transcripts.select(*rest, F.posexplode_outer("segments").alias("_pos", "s"))
    return rows.where(F.col("_pos").isNotNull()).select(
        *rest, (F.col("_pos") + 1).alias("segment_index"), "s.*"
    )


def search_hits(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Full-text search result documents to hits."""
    rows = df.select(F.explode(F.from_json(payload, HITS_JSON)["hits"]["hits"]).alias("h"))
    source = F.col("h._source")
    return rows.select(
        F.get(F.split(F.coalesce(F.col("h._id"), F.lit("")), ":"), F.lit(0)).alias("accession_number"),
        pad_cik(F.coalesce(F.get(source["ciks"], F.lit(0)), F.lit(""))).alias("cik"),
        source["file_type"].alias("form_type"),
        source["file_date"].try_cast("date").alias("filing_date"),
        F.coalesce(source["display_names"], F.array().cast("array<string>")).alias("display_names"),
    )


def doc_search(
    filings: DataFrame,
    phrase: str,
    text: str,
    form_types: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Filings whose text contains a phrase, ignoring case."""
    keep = F.contains(F.lower(F.col(text)), F.lit(phrase.lower()))
    if form_types:
        keep = keep & F.col("form_type").isin(*form_types)
    if start is not None:
        keep = keep & (F.col("filing_date") >= F.lit(start))
    if end is not None:
        keep = keep & (F.col("filing_date") <= F.lit(end))
    return filings.where(keep)


def ticker_map(df: DataFrame) -> DataFrame:
    """Registry entries to upper-case ticker, padded number and title."""
    return df.select(
        F.upper("ticker").alias("ticker"), pad_cik("cik_str").alias("cik"), F.col("title")
    )


def company_info(submissions: DataFrame, tickers: DataFrame) -> DataFrame:
    """Identity and industry code; the name falls back to the registry title."""
    s = submissions.select(
        F.upper("ticker").alias("ticker"), F.from_json("payload", SUBMISSIONS_JSON).alias("s")
    )
    blank = F.lit("")
    return s.join(tickers, "ticker").select(
        "ticker",
        "cik",
        F.coalesce(F.nullif(F.col("s.name"), blank), F.col("title")).alias("company_name"),
        F.nullif(F.col("s.sic"), blank).alias("sic"),
        F.nullif(F.col("s.sicDescription"), blank).alias("sic_description"),
    )


def resolve_universe(constituents: DataFrame, tickers: DataFrame) -> DataFrame:
    """Constituents with their registry number, or a reason why there is none."""
    named = constituents.withColumn("registry_ticker", exchange_ticker("ticker"))
    known = tickers.select(F.col("ticker").alias("registry_ticker"), "cik")
    return named.join(known, "registry_ticker", "left").withColumn(
        "reason", F.when(F.col("cik").isNull(), F.lit("not in the ticker map"))
    )


def constituent_rows(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Member rows of the constituents table of each page.

    The first table row is the header. Rows with fewer than three cells or a
    blank first cell are skipped; a blank sector is NULL.
    """
    cells = pages.select(*keep, html_table(F.col(html)).alias("_rows"))
    body = F.filter(
        F.col("_rows"), lambda r, i: (i > 0) & (F.size(r) >= 3) & (F.get(r, F.lit(0)) != "")
    )
    return cells.select(*keep, F.explode(body).alias("r")).select(
        *keep,
        F.get("r", F.lit(0)).alias("ticker"),
        F.get("r", F.lit(1)).alias("company_name"),
        F.nullif(F.get("r", F.lit(2)), F.lit("")).alias("gics_sector"),
    )


def parse_transcripts(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """Article pages to transcripts with an array of speaker turns.

    Columns: key, company_name, ticker, quarter, fiscal_year, segments, reason.
    ``reason`` is set, and segments empty, for a page without an article body
    or without any speaker. All steps after tokenising are array expressions
    inside the row, so pages are never shuffled.
    """
    e = once(pages.select(key, html), o=html_outline(F.col(html))).select(
        key, "o.headline", "o.has_body", F.coalesce("o.elements", F.array()).alias("els")
    )

    def kind(x: Column) -> Column:
        speaks = x["strong"].isNotNull() & (F.length(x["tight"]) < MAX_SPEAKER_CHARS)
        return (
            F.when((x["tag"] == "h2") & x["tight"].rlike(QA_HEADING), "qa")
            .when(x["tag"] == "h2", "other")
            .when(speaks, "speaker")
            .otherwise("text")
        )

    kinds = F.transform(
        "raw",
        lambda x: F.struct(
            kind(x).alias("kind"),
            x["spaced"].alias("text"),
            x["strong"].alias("strong"),
            x["em"].alias("em"),
        ),
    )
    e = once(e.withColumnRenamed("els", "raw"), els=kinds).drop("raw")

    def places(*wanted: str) -> Column:
        return F.array_compact(
            F.transform("els", lambda x, i: F.when(x["kind"].isin(*wanted), i + 1))
        )

    e = once(e, breaks=places("speaker", "qa"), first_qa=F.array_min(places("qa")))

    # Everything that is fixed per page is zipped in, not computed per turn.
    starts = F.arrays_zip(
        F.col("breaks").alias("at"),
        F.array_append(F.slice("breaks", 2, F.size("breaks")), F.size("els") + 1).alias("stop"),
        F.array_repeat(F.col("first_qa"), F.size("breaks")).alias("first_qa"),
    )

    def turn(start: Column) -> Column:
        at, stop = start["at"], start["stop"]
        head = F.get(F.col("els"), at - 1)
        said = F.filter(
            F.slice(F.col("els"), at + 1, stop - at - 1),
            lambda x: (x["kind"] == "text") & (x["text"] != ""),
        )
        return F.struct(
            F.when(head["kind"] == "speaker", F.rtrim(head["strong"], F.lit(":"))).alias("speaker"),
            head["em"].alias("role"),
            F.when(at > start["first_qa"], "qa").otherwise("prepared_remarks").alias("section"),
            F.array_join(F.transform(said, lambda x: x["text"]), " ").alias("text"),
        )

    turns = F.filter(
        F.transform(F.filter(starts, lambda x: x["at"].isNotNull()), turn),
        lambda t: t["speaker"].isNotNull() & (t["speaker"] != "") & (t["text"] != ""),
    )
    e = once(e, segments=turns, title=parse_title("headline"))
    reason = F.when(~F.col("has_body"), F.lit("no article body")).when(
        F.size("segments") == 0, F.lit("no speaker segments")
    )
    return e.select(
        key,
        F.col("title.company").alias("company_name"),
        F.col("title.ticker").alias("ticker"),
        F.col("title.quarter").alias("quarter"),
        F.col("title.fiscal_year").alias("fiscal_year"),
        F.col("segments").cast(EVENT_STREAMS["transcript"]["segments"].dataType).alias("segments"),
        reason.alias("reason"),
    )


def fetch_sections(documents: DataFrame, body: str = "body", document: str = "primary_document") -> DataFrame:
    """Landed filing documents to plain text and section columns.

    Only HTML documents are tokenised; plain text passes through.
    """
    is_html = F.lower(F.col(document)).rlike(r"\.html?$")
    text = F.when(is_html, html_to_text(F.when(is_html, F.col(body)))).otherwise(F.col(body))
    return filing_sections(once(documents, raw_text=text))
