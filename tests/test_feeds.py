"""Feed goldens: macro, options, filing index, transcripts, constituents."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerwing.sources import feeds


def docs(spark, *payloads, **extra):
    rows = [(json.dumps(p), *extra.values()) for p in payloads]
    return spark.createDataFrame(rows, ", ".join(["payload string", *[f"{k} string" for k in extra]]))


def test_macro_dot_is_missing(spark):
    body = {"observations": [{"date": "2026-01-01", "value": "4.3"}, {"date": "2026-02-01", "value": "."},
                             {"date": "2026-03-01", "value": "0"}]}
    df = docs(spark, body, series_id="FEDFUNDS")
    rows = feeds.parse_macro(df).orderBy("observation_date").collect()
    assert [(r.observation_date, r.value) for r in rows] == [(date(2026, 1, 1), 4.3), (date(2026, 3, 1), 0.0)]
    assert feeds.macro_skips(df).first()["skipped"] == 1


def contract(ticker, volume, interest, **details):
    full = {"ticker": ticker, "contract_type": "call", "strike_price": 10, "expiration_date": "2026-07-17"}
    return {"details": {**full, **details}, "day": {"volume": volume}, "open_interest": interest}


def test_unusual_options(spark):
    body = {"results": [contract("A", 5000, 1000), contract("B", 500, 1000), contract("C", 50, 1),
                        contract("D", 400, 0), contract("E", 300, 100), contract("F", 900, 1, expiration_date="bad"),
                        {"details": {"ticker": "G"}}, contract("H", None, None)]}
    parsed = feeds.parse_chain(docs(spark, body, underlying="aapl"))
    assert {r.contract_ticker for r in parsed.collect()} == set("ABCDEH")
    flagged = feeds.unusual_activity(parsed).orderBy(F.col("volume_oi_ratio").desc()).collect()
    assert [(r.contract_ticker, r.volume_oi_ratio) for r in flagged] == [("D", 400.0), ("A", 5.0), ("E", 3.0)]
    assert flagged[0].underlying == "AAPL"


def submissions(forms, dates):
    n = len(forms)
    recent = {"accessionNumber": [f"0-{i}" for i in range(n)], "form": forms, "filingDate": dates,
              "primaryDocument": ["d.htm"] * n}
    return {"name": "X", "filings": {"recent": recent}}


def test_filing_index(spark):
    df = docs(spark, submissions(["10-K", "8-K"], ["2026-01-01", "2026-02-01"]), cik="0000000012")
    rows = feeds.filing_index(df).orderBy("accession_number").collect()
    assert rows[0].document_url.endswith("/data/12/00/d.htm")
    assert [r.filing_date for r in rows] == [date(2026, 1, 1), date(2026, 2, 1)]


def test_uneven_index_is_an_error(spark):
    bad = docs(spark, submissions(["10-K", "8-K"], ["2026-01-01"]), cik="1")
    with pytest.raises(Exception, match="differ in length"):
        feeds.filing_index(bad).collect()


def test_archive_pruning(spark):
    pages = spark.createDataFrame(
        [("old", date(2000, 1, 1), date(2005, 1, 1)), ("mid", date(2005, 1, 2), date(2015, 1, 1)),
         ("open", None, None), ("new", date(2024, 1, 1), date(2025, 1, 1))],
        "name string, filing_from date, filing_to date")
    kept = feeds.prune_archives(pages, date(2010, 1, 1), date(2020, 1, 1))
    assert {r.name for r in kept.collect()} == {"mid", "open"}
    assert feeds.prune_archives(pages).count() == 0


PAGE = """<html><body><h1>Apple (AAPL) Q1 2026 Earnings Call Transcript</h1><article>
<h2>Prepared Remarks:</h2><p><strong>Tim:</strong><em> CEO</em></p><p>First part.</p><p>Second <b>bold</b> part with
enough text to stay a paragraph even though it has a bold word in it, because it is longer than a speaker line.</p>
<h2>Other</h2><p>Third.</p><h2>Questions &amp; Answers:</h2><p>nobody</p><p><b>Ann</b></p><p>Why?</p></article></body></html>"""


def test_transcripts(spark):
    pages = spark.createDataFrame(
        [("u1", PAGE), ("u2", "<h1>T</h1><p>no body</p>"), ("u3", "<h1>T</h1><article><p>none</p></article>"), ("u4", None)],
        "url string, html string")
    parsed = feeds.parse_transcripts(pages)
    rows = {r.url: r for r in parsed.collect()}
    assert (rows["u1"].company_name, rows["u1"].ticker, rows["u1"].fiscal_year) == ("Apple", "AAPL", 2026)
    tim, ann = rows["u1"].segments
    assert (tim.speaker, tim.role, tim.section) == ("Tim", "CEO", "prepared_remarks")
    assert tim.text.startswith("First part. Second bold part") and tim.text.endswith("Third.")
    assert (ann.speaker, ann.role, ann.section, ann.text) == ("Ann", None, "qa", "Why?")
    assert rows["u2"].reason == "no article body" and rows["u3"].reason == "no speaker segments"
    assert rows["u4"].reason == "no article body"
    segments = feeds.explode_segments(parsed).orderBy("segment_index").collect()
    assert [s.segment_index for s in segments] == [1, 2]


def test_constituents(spark):
    html = ("<table id='constituents'><tr><th>a</th></tr><tr><td>BRK.B</td><td>Berkshire</td><td> Financials</td><td>x</td></tr>"
            "<tr><td></td><td>b</td><td>c</td></tr><tr><td>only</td></tr><tr><td>ZZ</td><td>Z</td><td></td></tr></table>")
    rows = feeds.constituent_rows(spark.createDataFrame([(html,), ("<p>none</p>",)], "html string")).collect()
    assert [tuple(r) for r in rows] == [("BRK.B", "Berkshire", "Financials"), ("ZZ", "Z", None)]
    tickers = spark.createDataFrame([("BRK-B", "0001")], "ticker string, cik string")
    got = {r.ticker: r for r in feeds.resolve_universe(
        feeds.constituent_rows(spark.createDataFrame([(html,)], "html string")), tickers).collect()}
    assert got["BRK.B"].cik == "0001" and got["ZZ"].reason == "not in the ticker map"


def test_search_hits(spark):
    body = {"hits": {"hits": [{"_id": "0001-1:doc.htm", "_source": {"ciks": ["12"], "file_type": "8-K"}},
                              {"_id": "0002", "_source": {"file_date": "2026-01-02", "display_names": ["A"]}}]}}
    a, b = feeds.search_hits(docs(spark, body)).orderBy("accession_number").collect()
    assert (a.accession_number, a.cik, a.filing_date, a.display_names) == ("0001-1", "0000000012", None, [])
    assert (b.cik, b.filing_date, b.display_names) == ("0000000000", date(2026, 1, 2), ["A"])
