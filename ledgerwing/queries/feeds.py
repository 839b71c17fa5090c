"""Document feeds, facts and text recognition on the whole driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import html_to_text
from ..functions.text import (
    SECTION_NAMES,
    TICKER_BLOCKLIST,
    extract_tickers,
    filing_sections,
    parse_title,
    present_sections,
    sections_map,
)
from ..operators.dedup import top_per_key
from ..operators.facts import (
    DEFAULT_RULES,
    fundamentals_history,
    latest_fundamentals,
    qualify_facts,
    resolve_concepts,
)
from ..sources import feeds
from ..plans.memo_checks import judge_scores
from . import standins as s
from .registry import query

FACT_COLUMNS = ("cik", "taxonomy", "concept", "unit", "pos", "start", "end", "val", "fp", "form", "filed")


@query("qualify_facts", f"""SELECT {', '.join(f'"{c}"' for c in FACT_COLUMNS)} FROM annual""")
def _qualify(spark: SparkSession, sf: str) -> DataFrame:
    return qualify_facts(s.facts(spark, sf)).select(*FACT_COLUMNS)


@query(
    "resolve_concepts_priority",
    """SELECT cik, field, "end", val, filed, concept FROM resolved
        WHERE field NOT IN ('revenue', 'cover_shares', 'balance_shares')""",
)
def _resolve_priority(spark: SparkSession, sf: str) -> DataFrame:
    rules = {k: r for k, r in DEFAULT_RULES.items() if r.prefer == "priority" and r.unit == "USD"}
    return resolve_concepts(s.facts(spark, sf), rules)


@query(
    "resolve_concepts_max",
    """SELECT cik, field, "end", val, filed, concept FROM resolved WHERE field = 'revenue'""",
)
def _resolve_max(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_concepts(s.facts(spark, sf), {"revenue": DEFAULT_RULES["revenue"]})


_HISTORY = """
    SELECT p.*, CASE WHEN h.cik IS NOT NULL THEN c.val ELSE b.val END AS shares_outstanding
    FROM (SELECT r.cik, CAST(year(r."end") AS INTEGER) AS fiscal_year, max(r."end") AS period_end_date
          FROM resolved r WHERE field = 'revenue' GROUP BY ALL) k
    JOIN (SELECT cik, "end" AS period_end_date,
                 max(val) FILTER (field = 'revenue') AS revenue,
                 max(val) FILTER (field = 'cost_of_revenue') AS cost_of_revenue,
                 max(val) FILTER (field = 'net_income') AS net_income,
                 max(val) FILTER (field = 'total_assets') AS total_assets,
                 max(val) FILTER (field = 'total_liabilities') AS total_liabilities,
                 max(val) FILTER (field = 'total_equity') AS total_equity,
                 max(val) FILTER (field = 'total_debt') AS total_debt
          FROM resolved GROUP BY cik, "end") p USING (cik, period_end_date)
    LEFT JOIN (SELECT DISTINCT cik FROM resolved WHERE field = 'cover_shares') h USING (cik)
    LEFT JOIN (SELECT cik, year("end") AS y, arg_max(val, "end") AS val FROM resolved
               WHERE field = 'cover_shares' GROUP BY ALL) c ON c.cik = k.cik AND c.y = k.fiscal_year
    LEFT JOIN (SELECT cik, year("end") AS y, arg_max(val, "end") AS val FROM resolved
               WHERE field = 'balance_shares' GROUP BY ALL) b ON b.cik = k.cik AND b.y = k.fiscal_year
"""
_HISTORY_COLUMNS = (
    "cik, CAST(year(period_end_date) AS INTEGER) AS fiscal_year, period_end_date, revenue, cost_of_revenue,"
    " net_income, total_assets, total_liabilities, total_equity, total_debt, shares_outstanding"
)
_DROP = ("fiscal_quarter", "close_price")


@query("fundamentals_history", f"SELECT {_HISTORY_COLUMNS} FROM ({_HISTORY})")
def _history(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals_history(s.facts(spark, sf)).drop(*_DROP)


@query(
    "latest_fundamentals",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT {_HISTORY_COLUMNS},
        row_number() OVER (PARTITION BY cik ORDER BY period_end_date DESC) AS rn FROM ({_HISTORY})) WHERE rn = 1""",
)
def _latest_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return latest_fundamentals(fundamentals_history(s.facts(spark, sf))).drop(*_DROP)


@query(
    "explode_facts",
    """SELECT cik, taxonomy, concept, unit, CAST(i AS BIGINT) AS pos, start, "end",
        CASE WHEN i = 0 THEN val ELSE val + 1 END AS val, fp, form, CASE WHEN i = 0 THEN filed ELSE filed + 1 END AS filed
        FROM facts CROSS JOIN (VALUES (0), (1)) c(i)""",
)
def _explode_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Each fact as a nested document with a restated second entry."""
    def entry(i: int):
        return F.struct(
            F.col("start").cast("string").alias("start"),
            F.col("end").cast("string").alias("end"),
            (F.col("val") + i).alias("val"),
            F.year("end").alias("fy"),
            "fp",
            "form",
            F.date_add("filed", i).cast("string").alias("filed"),
        )

    units = F.struct(F.create_map("unit", F.array(entry(0), entry(1))).alias("units"))
    nested = F.create_map("taxonomy", F.create_map("concept", units))
    docs = s.facts(spark, sf).select("cik", F.to_json(nested).alias("payload"))
    return feeds.explode_facts(docs).drop("fy")


@query(
    "filing_index",
    """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'F-' || o_orderkey || '-' || i AS accession_number,
        CASE i WHEN 0 THEN '10-K' ELSE '8-K' END AS form_type,
        CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS filing_date, 'doc' || i || '.htm' AS primary_document,
        'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/F' || o_orderkey || i || '/doc' || i || '.htm' AS document_url
        FROM orders CROSS JOIN (VALUES (0), (1), (2)) c(i)""",
)
def _filing_index(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as a submissions document whose recent block has three filings."""
    three = range(3)
    recent = F.struct(
        F.array(*[s.text_of("F-", F.col("o_orderkey"), f"-{i}") for i in three]).alias("accessionNumber"),
        F.array(*[F.lit("10-K" if i == 0 else "8-K") for i in three]).alias("form"),
        F.array(*[F.date_add(F.to_date("o_orderdate"), i).cast("string") for i in three]).alias("filingDate"),
        F.array(*[F.lit(f"doc{i}.htm") for i in three]).alias("primaryDocument"),
    )
    docs = s.table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("payload"),
    )
    return feeds.filing_index(docs)


@query(
    "prune_archives",
    """SELECT o_orderkey, filing_from, filing_to FROM (
        SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS filing_from,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_orderdate AS DATE) + 365 END AS filing_to FROM orders)
        WHERE (filing_to IS NULL OR filing_to >= DATE '1997-03-01') AND (filing_from IS NULL OR filing_from <= DATE '1999-06-30')""",
)
def _prune(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    pages = s.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", day).alias("filing_from"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.date_add(day, 365)).alias("filing_to"),
    )
    return feeds.prune_archives(pages, date(1997, 3, 1), date(1999, 6, 30))


@query(
    "list_filings",
    """SELECT accession_number, ticker, form_type, filing_date FROM filings
        WHERE form_type IN ('10-K', '10-Q') AND filing_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
)
def _list(spark: SparkSession, sf: str) -> DataFrame:
    found = feeds.list_filings(
        s.filing_facts(spark, sf), ("10-K", "10-Q"), date(1996, 1, 1), date(2000, 12, 31)
    )
    return found.select("accession_number", "ticker", "form_type", "filing_date")


def submissions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers' orders as filings: those from 1997 on are recent, a page per year has the rest."""
    order = F.struct(
        s.text_of("F-", F.col("o_orderkey")).alias("accessionNumber"),
        F.when(F.col("o_orderkey") % 3 == 0, "10-K").otherwise("4").alias("form"),
        F.to_date("o_orderdate").cast("string").alias("filingDate"),
        F.lit("main.htm").alias("primaryDocument"),
    )
    rows = s.table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.year("o_orderdate").alias("year"),
        order.alias("o"),
    )
    fields = ("accessionNumber", "form", "filingDate", "primaryDocument")
    lists = rows.groupBy("cik", F.when(F.col("year") < 1997, F.col("year")).alias("year")).agg(
        F.collect_list("o").alias("list")
    )
    blocks = lists.select(
        "cik", "year", F.struct(*[F.col(f"list.{f}").alias(f) for f in fields]).alias("block")
    )
    files = F.struct(
        s.text_of("page-", F.col("year")).alias("name"),
        F.make_date("year", F.lit(1), F.lit(1)).cast("string").alias("filingFrom"),
        F.make_date("year", F.lit(12), F.lit(31)).cast("string").alias("filingTo"),
    )
    main = blocks.groupBy("cik").agg(
        F.first(F.when(F.col("year").isNull(), F.col("block")), ignorenulls=True).alias("recent"),
        F.collect_list(F.when(F.col("year").isNotNull(), files)).alias("files"),
    )
    payload = F.to_json(F.struct(F.struct("recent", "files").alias("filings")))
    pages = blocks.where("year IS NOT NULL").select(
        "cik", s.text_of("page-", F.col("year")).alias("name"), F.to_json("block").alias("payload")
    )
    return main.select("cik", payload.alias("payload")), pages


@query(
    "filing_listing",
    """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'F-' || o_orderkey AS accession_number,
        '10-K' AS form_type, CAST(o_orderdate AS DATE) AS filing_date FROM orders
        WHERE o_orderkey % 3 = 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1994-05-01' AND DATE '1998-03-31'""",
)
def _listing(spark: SparkSession, sf: str) -> DataFrame:
    main, pages = submissions(spark, sf)
    found = feeds.filing_listing(main, pages, ("10-K",), date(1994, 5, 1), date(1998, 3, 31))
    return found.select("cik", "accession_number", "form_type", "filing_date")


@query(
    "latest_n_filings",
    """SELECT accession_number, ticker, filing_date FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY filing_date DESC, accession_number) AS rn
        FROM filings WHERE form_type = '10-K') WHERE rn <= 2""",
)
def _latest_n(spark: SparkSession, sf: str) -> DataFrame:
    found = feeds.list_filings(s.filing_facts(spark, sf), ("10-K",), limit_per_ticker=2)
    return found.select("accession_number", "ticker", "filing_date")


@query(
    "newest_filings_report",
    """SELECT accession_number, filing_date FROM filings ORDER BY filing_date DESC, accession_number LIMIT 25""",
)
def _newest(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.filing_facts(spark, sf).select("accession_number", "filing_date")
    return feeds.newest_filings(rows)


@query(
    "parse_macro",
    """SELECT CASE event_type WHEN 'error' THEN 'FEDFUNDS' WHEN 'click' THEN 'T10Y2Y' WHEN 'view' THEN 'UNRATE'
            WHEN 'purchase' THEN 'CPIAUCSL' END AS series_id, CAST(ts AS DATE) AS observation_date, value
        FROM events WHERE event_type <> 'signup' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'""",
)
def _parse_macro(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.parse_macro(
        macro_documents(spark, sf),
        series=("FEDFUNDS", "T10Y2Y", "UNRATE", "CPIAUCSL"),
        start=date(2024, 1, 3),
        end=date(2024, 1, 27),
    )


def macro_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as an observations document with a missing second entry."""
    def cell(value):
        return F.struct(F.to_date("ts").cast("string").alias("date"), value.alias("value"))

    observations = F.array(cell(F.col("value").cast("string")), cell(F.lit(".")))
    return s.table(spark, sf, "events").select(
        s.case_of("event_type", s.SERIES_OF_EVENT).alias("series_id"),
        F.to_json(F.struct(observations.alias("observations"))).alias("payload"),
    )


@query(
    "macro_skips",
    """SELECT CASE event_type WHEN 'error' THEN 'FEDFUNDS' WHEN 'click' THEN 'T10Y2Y' WHEN 'view' THEN 'UNRATE'
            WHEN 'purchase' THEN 'CPIAUCSL' ELSE 'GDP' END AS series_id, count(*) AS skipped FROM events GROUP BY ALL""",
)
def _macro_skips(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.macro_skips(macro_documents(spark, sf))


def chain_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Each contract as a chain page; every page also holds a contract without strike."""
    def contract(strike):
        return F.struct(
            F.struct(
                F.col("contract_ticker").alias("ticker"),
                "contract_type",
                strike.alias("strike_price"),
                F.col("expiration").cast("string").alias("expiration_date"),
            ).alias("details"),
            F.struct(
                F.when(F.col("contract_type") == "call", F.col("day_volume")).alias("volume")
            ).alias("day"),
            F.nullif(F.col("open_interest"), F.lit(0)).alias("open_interest"),
            "implied_volatility",
        )

    results = F.array(contract(F.col("strike").cast("string")), contract(F.lit(None).cast("string")))
    return s.contracts(spark, sf).select(
        F.lower("underlying").alias("underlying"),
        F.to_json(F.struct(results.alias("results"))).alias("payload"),
    )


_CHAIN = """SELECT underlying, contract_ticker, contract_type, strike, expiration,
    CASE WHEN contract_type = 'call' THEN day_volume ELSE 0 END AS day_volume, open_interest, implied_volatility
    FROM contracts"""


@query("parse_chain", _CHAIN)
def _parse_chain(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.parse_chain(chain_documents(spark, sf))


@query(
    "unusual_activity",
    f"""SELECT * FROM (SELECT *, CASE WHEN open_interest > 0 THEN CAST(day_volume AS DOUBLE) / open_interest
            ELSE CAST(day_volume AS DOUBLE) END AS volume_oi_ratio FROM ({_CHAIN}))
        WHERE day_volume >= 100 AND volume_oi_ratio >= 3.0""",
)
def _unusual(spark: SparkSession, sf: str) -> DataFrame:
    flagged = feeds.unusual_activity(feeds.parse_chain(chain_documents(spark, sf)))
    return flagged.orderBy(F.col("volume_oi_ratio").desc())


@query(
    "extract_tickers",
    r"""SELECT 'p' || doc_id AS post_id, array_to_string(list_distinct_ordered, ',') AS tickers FROM (
        SELECT doc_id, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS list_distinct_ordered FROM (
            SELECT doc_id, list_filter(regexp_extract_all(source || chr(10) || text,
                '(?:^|[^\pL\pN\pM_])([A-Z]{2,5})(?:$|[^\pL\pN\pM_])', 1), lambda x: x NOT IN (BLOCKLIST)) AS hits
            FROM (SELECT doc_id, source, regexp_replace(text, '([^\pL\pN\pM_])', '\1\1', 'g') AS text FROM documents)))""".replace(
        "BLOCKLIST", ", ".join(f"'{w}'" for w in TICKER_BLOCKLIST)
    ),
)
def _tickers(spark: SparkSession, sf: str) -> DataFrame:
    posts = feeds.shape_posts(s.posts(spark, sf))
    return posts.select("post_id", F.array_join("tickers", ",").alias("tickers"))


@query(
    "cashtags",
    r"""SELECT event_id, 'T' || chr(CAST(65 + user_id % 26 AS INTEGER)) || ',Q' || ',' ||
        CASE event_type WHEN 'error' THEN 'GME' WHEN 'click' THEN 'DD' ELSE 'AMC' END AS tickers FROM events""",
)
def _cashtags(spark: SparkSession, sf: str) -> DataFrame:
    """Cashtags come first and may be blocked words; bare blocked words are dropped."""
    pick = F.when(F.col("event_type") == "error", "GME on the CEO").when(
        F.col("event_type") == "click", "$DD not DD"
    ).otherwise("AMC FOMO AMC")
    text = F.concat(F.lit("buy $T"), F.chr(F.lit(65) + F.col("user_id") % 26), F.lit(" and $Q, "), pick)
    return s.table(spark, sf, "events").select(
        "event_id", F.array_join(extract_tickers(text), ",").alias("tickers")
    )


@query(
    "explode_mentions",
    """SELECT 'e' || event_id AS post_id, t AS ticker, CAST(floor(value) AS INTEGER) AS score,
        TIMESTAMP '1970-01-01 00:00:00' + to_hours(CAST(event_id AS INTEGER)) AS created_at
        FROM events CROSS JOIN (VALUES ('AAA'), ('BBB')) v(t)""",
)
def _explode_mentions(spark: SparkSession, sf: str) -> DataFrame:
    submissions = s.table(spark, sf, "events").select(
        s.text_of("e", F.col("event_id")).alias("post_id"),
        F.lit("stocks").alias("subreddit"),
        F.lit("$AAA to the MOON").alias("title"),
        F.lit("BBB and AAA").alias("body"),
        F.floor("value").alias("score"),
        F.lit(None).cast("int").alias("num_comments"),
        (F.col("event_id") * 3600).alias("created_utc"),
    )
    rows = feeds.explode_mentions(feeds.shape_posts(submissions))
    return rows.select("post_id", "ticker", "score", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    "parse_title",
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_name ELSE p_name || ' Inc.' END AS company,
        CASE WHEN p_size % 5 <> 0 THEN 'PT.' || chr(65 + p_size % 26) END AS ticker,
        CASE WHEN p_size % 5 <> 0 THEN 1 + p_size % 4 END AS quarter,
        CASE WHEN p_size % 5 <> 0 THEN 2000 + p_size END AS fiscal_year FROM part""",
)
def _parse_title(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    headline = s.text_of(
        F.col("p_name"), " Inc. (NYSE: pt.", F.lower(F.chr(F.lit(65) + size % 26)), ") q",
        F.lit(1) + size % 4, " ", F.lit(2000) + size, " earnings  call transcript",
    )
    title = F.when(size % 5 == 0, F.col("p_name")).otherwise(headline)
    return s.table(spark, sf, "part").select("p_partkey", parse_title(title).alias("t")).select(
        "p_partkey", "t.*"
    )


@query(
    "parse_judge_reports",
    """SELECT doc_id, 1 + CAST(doc_id % 5 AS INTEGER) AS factual_grounding, 5 AS internal_consistency,
        quality AS honesty, CAST(NULL AS INTEGER) AS specificity,
        'Sound on ' || doc_id || '.' || chr(10) || 'Second line.' AS verdict FROM labels""",
)
def _judge(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("doc_id")
    report = s.text_of(
        "# Report\n| dimension | score |\n|---|---|\n| factual_grounding | ", F.lit(1) + key % 5,
        "/5 |\n| internal_consistency | 2/5 |\n| internal_consistency |5/5|\n| honesty | ", F.col("quality"),
        "/5 |\n\n## Verdict\n\nSound on ", key, ".\nSecond line.\n## Defects\nnone",
    )
    reports = s.table(spark, sf, "labels").select("doc_id", report.alias("report"))
    return judge_scores(reports).drop("report")


def annual_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents inside an annual report with a table of contents."""
    body = F.regexp_replace("text", r"(?im)^\s*item", "entry")
    text = s.text_of(
        "CONTENTS\nItem 1. Business\nItem 1A. Risk Factors\nItem 7. Discussion\nItem 8. Statements\n\n",
        "ITEM 1. Business\n", body, "\n  Item 1a: Risk Factors\n", body, "\n", F.col("source"),
        "\nItem 2. Properties\nnone\nItem 7 - Discussion ", body,
        "\nItem 8. Statements\nNotes to the Consolidated Financial Statements\n", body, "\n",
    )
    form = F.when(F.col("lang") == "en", "10-K").when(F.col("lang") == "de", "10-Q").otherwise("8-K")
    return s.table(spark, sf, "documents").select("doc_id", form.alias("form_type"), text.alias("raw_text"))


_WS = r"' ' || chr(9) || chr(10) || chr(13) || chr(160)"
_BODY = r"regexp_replace(text, '(?im)^\s*item', 'entry', 'g')"
_SECTIONS = f"""
    SELECT doc_id,
        CASE WHEN form = '10-K' THEN b END AS business,
        CASE WHEN form IN ('10-K', '10-Q') THEN r END AS risk_factors,
        CASE WHEN form = '10-K' THEN m END AS mdna,
        CASE WHEN form = '10-K' THEN f WHEN form = '10-Q' THEN b END AS financial_statements,
        n AS footnotes
    FROM (SELECT doc_id, CASE lang WHEN 'en' THEN '10-K' WHEN 'de' THEN '10-Q' ELSE '8-K' END AS form,
            CASE WHEN length(b) >= 200 THEN b END AS b, CASE WHEN length(r) >= 200 THEN r END AS r,
            CASE WHEN length(m) >= 200 THEN m END AS m, CASE WHEN length(f) >= 200 THEN f END AS f,
            CASE WHEN length(n) >= 200 THEN n END AS n
        FROM (SELECT doc_id, lang, trim('Business' || chr(10) || t, {_WS}) AS b,
                trim('Risk Factors' || chr(10) || t || chr(10) || source, {_WS}) AS r,
                trim('Discussion ' || t, {_WS}) AS m,
                trim('Statements' || chr(10) || 'Notes to the Consolidated Financial Statements' || chr(10) || t, {_WS}) AS f,
                trim('Notes to the Consolidated Financial Statements' || chr(10) || t, {_WS}) AS n
            FROM (SELECT *, {_BODY} AS t FROM documents)))"""


@query("filing_sections", _SECTIONS)
def _sections(spark: SparkSession, sf: str) -> DataFrame:
    return filing_sections(annual_texts(spark, sf)).select("doc_id", *SECTION_NAMES)


@query(
    "present_sections",
    f"""SELECT doc_id, array_to_string(list_filter([
            CASE WHEN business IS NOT NULL THEN 'business' END,
            CASE WHEN financial_statements IS NOT NULL THEN 'financial_statements' END,
            CASE WHEN footnotes IS NOT NULL THEN 'footnotes' END,
            CASE WHEN mdna IS NOT NULL THEN 'mdna' END,
            CASE WHEN risk_factors IS NOT NULL THEN 'risk_factors' END], lambda x: x IS NOT NULL), ',') AS present,
        length(mdna) AS mdna_chars FROM ({_SECTIONS})""",
)
def _present(spark: SparkSession, sf: str) -> DataFrame:
    found = filing_sections(annual_texts(spark, sf)).select("doc_id", sections_map().alias("sections"))
    return found.select(
        "doc_id",
        F.array_join(present_sections("sections"), ",").alias("present"),
        F.length(F.col("sections")["mdna"]).alias("mdna_chars"),
    )


#: The text nodes of a crawled page, as SQL.
PAGE_TEXT = """list_reduce(list_prepend(array_to_string(list_filter(string_split(regexp_replace(html,
        '<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', chr(1), 'gs'), chr(1)), lambda x: x <> ''), chr(10)),
        ['&quot;', '&copy;', '&middot;', '&amp;']),
        lambda t, e: replace(t, e, CASE e WHEN '&quot;' THEN '"' WHEN '&copy;' THEN chr(169) WHEN '&middot;' THEN chr(183) ELSE '&' END))"""


@query("html_to_text", f"SELECT page_id, CASE WHEN html IS NOT NULL THEN {PAGE_TEXT} END AS text FROM pages")
def _html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return s.table(spark, sf, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


@query(
    "html_round_trip",
    """SELECT conv_id, turn, 'Call' || chr(10) || 'Title & more' || chr(10) || text || chr(10) || role AS text
        FROM conversations""",
)
def _html_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Turns inside markup: scripts, styles and comments must vanish, entities decode."""
    page = s.text_of(
        "<html><head><title>Call</title><style>p{}</style><script>x('</p>')</script></head><body>",
        "<!-- note --><h1>Title &amp; more</h1><p>", F.col("text"), "</p><b>", F.col("role"), "</b></body></html>",
    )
    turns = s.table(spark, sf, "conversations").select("conv_id", "turn", page.alias("html"))
    return turns.select("conv_id", "turn", html_to_text(F.col("html")).alias("text"))


@query(
    "html_table_rows",
    """SELECT c_custkey, 'C' || c_custkey AS ticker, c_name AS company_name,
        CASE i WHEN 0 THEN c_mktsegment END AS gics_sector FROM customer CROSS JOIN (VALUES (0), (1)) v(i)""",
)
def _table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer as a constituents page with one short and one blank row."""
    ticker, name = s.text_of("C", F.col("c_custkey")), F.col("c_name")
    html = s.text_of(
        "<table class='other'><tr><td>x</td><td>y</td><td>z</td></tr></table>"
        "<table class='sortable wikitable'><tr><td>Symbol</td><td>Name</td><td>Sector</td></tr><tr><td> ",
        ticker, " </td><td><a>", name, "</a></td><td>", F.col("c_mktsegment"), "</td></tr>",
        "<tr><td>short</td><td>row</td></tr><tr><td> </td><td>blank</td><td>ticker</td></tr><tr><td>",
        ticker, "</td><td>", name, "</td><td></td></tr></table>",
    )
    # Dealt out before the pages are made of them: a small file of customers is a large one of pages.
    customers = s.spread(s.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    pages = customers.select("c_custkey", html.alias("html"))
    return feeds.constituent_rows(pages, keep=["c_custkey"])


def call_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation turn as the article page of one earnings call."""
    page = s.text_of(
        "<html><body><h1>Firm ", F.col("conv_id"), " (ABC) Q2 2024 Earnings Call Transcript</h1><article>"
        "<h2>Prepared Remarks</h2><p>Operator intro without speaker.</p><p><strong>", F.col("role"),
        ":</strong> <em>Chief</em></p><p>", F.col("text"), "</p><p>Second part.</p><p><b>Silent</b></p>"
        "<h2>Questions &amp; Answers</h2><p>Lost text.</p><p><b>Analyst</b></p><p>One <i>more</i> thing.</p>"
        "</article></body></html>",
    )
    url = s.text_of("call/", F.col("conv_id"), "/", F.col("turn"))
    return s.table(spark, sf, "conversations").select(url.alias("url"), page.alias("html"))


@query(
    "transcript_segments",
    r"""SELECT 'call/' || conv_id || '/' || turn AS url, 'Firm ' || conv_id AS company_name, 'ABC' AS ticker,
        2 AS quarter, 2024 AS fiscal_year, i AS segment_index,
        CASE i WHEN 1 THEN role ELSE 'Analyst' END AS speaker, CASE i WHEN 1 THEN 'Chief' END AS role,
        CASE i WHEN 1 THEN 'prepared_remarks' ELSE 'qa' END AS section,
        CASE i WHEN 1 THEN trim(text, ' ' || chr(10)) || ' Second part.' ELSE 'One more thing.' END AS text
        FROM conversations CROSS JOIN (VALUES (1), (2)) v(i)""",
)
def _transcripts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = feeds.parse_transcripts(call_pages(spark, sf)).drop("reason")
    return feeds.explode_segments(parsed)


def _unescaped(text: str) -> str:
    for entity, char in (("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{entity}', {char})"
    return text


def _plain(markup: str) -> str:
    return "trim(" + _unescaped(f"regexp_replace({markup}, '<[^>]*>', '', 'g')") + ", ' ' || chr(9) || chr(10) || chr(13))"


@query(
    "transcript_page_outcomes",
    f"""SELECT page_id AS url, coalesce(nullif(headline, ''), 'unknown') AS company_name, CAST(n AS INTEGER) AS n_segments,
            CASE WHEN NOT has_body THEN 'no article body' WHEN n = 0 THEN 'no speaker segments' END AS reason
        FROM (SELECT *, len(list_filter(heads, lambda i: rtrim(t[i], ':') <> '' AND len(list_filter(
                range(i + 1, coalesce(list_min(list_filter(heads, lambda j: j > i)), len(t) + 1)), lambda k: t[k] <> '')) > 0)) AS n
            FROM (SELECT *, list_filter(range(1, len(q) + 1), lambda i: starts_with(q[i], '<b>') AND length(t[i]) < 120) AS heads
                FROM (SELECT page_id, has_body, {_plain("h1")} AS headline, q, list_transform(q, lambda x: {_plain("x")}) AS t
                    FROM (SELECT page_id, html LIKE '%<article>%' AS has_body, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS h1,
                            string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>')[2:] AS q FROM pages))))""",
)
def _page_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The crawled pages as transcripts: how many turns, or why none."""
    pages = s.table(spark, sf, "pages").select(F.col("page_id").alias("url"), "html")
    parsed = feeds.parse_transcripts(pages)
    return parsed.select("url", "company_name", F.size("segments").alias("n_segments"), "reason")


@query(
    "explode_segments",
    """SELECT conv_id, turn, i AS segment_index, CASE i WHEN 1 THEN role ELSE 'echo' END AS speaker, text
        FROM conversations CROSS JOIN (VALUES (1), (2)) v(i)""",
)
def _segments(spark: SparkSession, sf: str) -> DataFrame:
    segments = F.array(
        F.struct(F.col("role").alias("speaker"), "text"), F.struct(F.lit("echo").alias("speaker"), "text")
    )
    rows = s.table(spark, sf, "conversations").select("conv_id", "turn", segments.alias("segments"))
    return feeds.explode_segments(rows)


@query(
    "search_hits",
    """SELECT 'A-' || o_orderkey AS accession_number, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
        '8-K' AS form_type, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS filing_date FROM orders""",
)
def _hits(spark: SparkSession, sf: str) -> DataFrame:
    source = F.struct(
        F.array(F.col("o_custkey").cast("string")).alias("ciks"),
        F.lit("8-K").alias("file_type"),
        F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate").cast("string")).alias("file_date"),
    )
    hit = F.struct(s.text_of("A-", F.col("o_orderkey"), ":main.htm").alias("_id"), source.alias("_source"))
    payload = F.to_json(F.struct(F.struct(F.array(hit).alias("hits")).alias("hits")))
    docs = s.table(spark, sf, "orders").select(payload.alias("payload"))
    return feeds.search_hits(docs).drop("display_names")


@query(
    "doc_search",
    """SELECT accession_number, form_type, filing_date FROM filings WHERE contains(lower(mdna_text), 'license')
        AND form_type IN ('10-K', '8-K') AND filing_date BETWEEN DATE '1995-06-01' AND DATE '2001-06-01'""",
)
def _search(spark: SparkSession, sf: str) -> DataFrame:
    # Copies of a filing share their text, so search first and deduplicate the hits.
    found = feeds.doc_search(
        s.raw_filings(spark, sf), "License", "mdna_text", ("10-K", "8-K"), date(1995, 6, 1), date(2001, 6, 1)
    ).select("accession_number", "form_type", "filing_date", "ingested_at")
    newest = top_per_key(found, ["accession_number"], [F.col("ingested_at").desc()])
    return newest.drop("ingested_at")


@query(
    "ticker_map",
    """SELECT 'C' || c_custkey AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS title FROM customer""",
)
def registry(spark: SparkSession, sf: str) -> DataFrame:
    entries = s.table(spark, sf, "customer").select(
        s.text_of("c", F.col("c_custkey")).alias("ticker"),
        F.col("c_custkey").alias("cik_str"),
        F.col("c_name").alias("title"),
    )
    return feeds.ticker_map(entries)


@query(
    "resolve_universe",
    """SELECT 'C.' || p_partkey AS ticker, 'C-' || p_partkey AS registry_ticker, p_name AS company_name,
        CASE WHEN c_custkey IS NOT NULL THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik,
        CASE WHEN c_custkey IS NULL THEN 'not in the ticker map' END AS reason
        FROM part LEFT JOIN customer ON c_custkey = p_partkey""",
)
def _universe(spark: SparkSession, sf: str) -> DataFrame:
    members = s.table(spark, sf, "part").select(
        s.text_of("C.", F.col("p_partkey")).alias("ticker"), F.col("p_name").alias("company_name")
    )
    dashed = registry(spark, sf).withColumn("ticker", F.regexp_replace("ticker", "^C", "C-"))
    return feeds.resolve_universe(members, dashed)


@query(
    "company_info",
    """SELECT 'C' || c_custkey AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
        CASE WHEN c_nationkey < 5 THEN c_name ELSE 'Firm ' || c_custkey END AS company_name,
        CASE WHEN c_nationkey < 20 THEN CAST(c_nationkey * 100 AS VARCHAR) END AS sic,
        CASE WHEN c_nationkey >= 5 THEN c_mktsegment END AS sic_description FROM customer""",
)
def _company_info(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("c_nationkey")
    payload = F.to_json(
        F.struct(
            F.when(nation < 5, "").otherwise(s.text_of("Firm ", F.col("c_custkey"))).alias("name"),
            F.when(nation < 20, (nation * 100).cast("string")).otherwise("").alias("sic"),
            F.when(nation >= 5, F.col("c_mktsegment")).alias("sicDescription"),
        )
    )
    submissions = s.table(spark, sf, "customer").select(
        s.text_of("c", F.col("c_custkey")).alias("ticker"), payload.alias("payload")
    )
    return feeds.company_info(submissions, registry(spark, sf))
