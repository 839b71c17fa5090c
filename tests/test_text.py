"""Recognition goldens."""

from pyspark.sql import functions as F

from ledgerwing.functions import scalars as sc
from ledgerwing.functions import text as tx
from ledgerwing.functions.html import html_to_text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def tickers(spark, text):
    return one(spark, tx.extract_tickers(F.lit(text)))


def test_tickers(spark):
    assert tickers(spark, "Long $TSLA and $NVDA here") == ["TSLA", "NVDA"]
    assert tickers(spark, "YOLO DD on the CEO of GME, IMO") == ["GME"]
    assert tickers(spark, "$DD is a stock") == ["DD"]
    assert tickers(spark, "$GME GME $AMC GME") == ["GME", "AMC"]
    assert tickers(spark, "nothing in lower case") == []
    assert tickers(spark, "ÉAB ABÉ aAB A") == []
    assert tickers(spark, "AAA then $BBB") == ["BBB", "AAA"]


def test_sic(spark):
    codes = {"3571": "Manufacturing", "5961": "Retail Trade", "6022": "Financials",
             "7372": "Services", None: "Unknown", "abc": "Unknown", "": "Unknown", "9000": "Unknown"}
    for code, sector in codes.items():
        assert one(spark, sc.sector_from_sic(F.lit(code).cast("string"))) == sector


def test_titles(spark):
    t = one(spark, tx.parse_title(F.lit("Apple (NASDAQ: aapl) Q1 2026 Earnings Call Transcript")))
    assert t.asDict() == {"company": "Apple", "ticker": "AAPL", "quarter": 1, "fiscal_year": 2026}
    t = one(spark, tx.parse_title(F.lit("Some headline")))
    assert (t.company, t.ticker, t.quarter) == ("Some headline", None, None)
    assert one(spark, tx.parse_title(F.lit(""))).company == "unknown"


def test_sections(spark):
    pad = "word " * 60
    toc = "Item 1. Business\nItem 1A. Risk Factors\nItem 7. Discussion\nItem 8. Statements\n"
    text = (
        toc + f"\nITEM 1. Business\n{pad}alpha\n\n  Item 1A. Risk\n{pad}beta\nItem 3. Legal\nskip {pad}\n"
        f"Item 7. Discussion\n{pad}gamma\nItem 8. Statements\n{pad}delta\n"
        f"Notes to Condensed Consolidated Financial Statements\n{pad}end\n"
    )
    df = spark.createDataFrame([(1, "10-K", text), (2, "10-Q", text), (3, "8-K", text), (4, "10-K", toc)],
                               "id int, form_type string, raw_text string")
    rows = {r.id: r for r in tx.filing_sections(df).collect()}
    assert rows[1].business.endswith("alpha") and rows[1].risk_factors.endswith("beta")
    assert rows[1].mdna.endswith("gamma") and "delta" in rows[1].financial_statements
    assert rows[1].footnotes.startswith("Notes to Condensed") and rows[1].footnotes.endswith("end")
    assert rows[2].financial_statements.endswith("alpha") and rows[2].mdna is None
    assert rows[3].business is None and rows[3].footnotes is not None
    assert all(rows[4][n] is None for n in tx.SECTION_NAMES)


def test_counts_follow_the_length_rule(spark):
    assert one(spark, sc.word_count(F.lit(""))) == 1
    assert one(spark, sc.word_count(F.lit("a  b"))) == 3
    assert one(spark, sc.needle_count(F.lit("declined decline declin"), "decline")) == 2
    assert one(spark, sc.needle_count(F.lit("ééé decline é"), "decline")) == 1


def test_html_text(spark):
    html = "<p>a &amp; b</p><script>x</script><style>y</style><!-- c --><b>d</b>"
    assert one(spark, html_to_text(F.lit(html))) == "a & b\nd"


def test_closeness(spark):
    assert one(spark, sc.is_close(F.lit(1000.0), F.lit(1000.9)))
    assert not one(spark, sc.is_close(F.lit(1000.0), F.lit(1002.0)))
    assert one(spark, sc.is_close(F.lit(0.0), F.lit(1e-7)))


def test_scores_are_bounded(spark):
    assert one(spark, sc.attention_score(F.lit(50.0), F.lit(3), F.lit(1))) == 100.0
    assert one(spark, sc.attention_score(F.lit(None).cast("double"), F.lit(3), F.lit(1))) == 25.0
