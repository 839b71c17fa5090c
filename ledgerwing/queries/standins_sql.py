"""The stand-in relations as SQL, for checking results with an independent engine."""

from __future__ import annotations

import re

from .standins import EXCLUDED, FACT_TAGS, KEYWORDS, SERIES_OF_EVENT, TRAIN_THROUGH


def _needle(word: str) -> str:
    both = "lower(coalesce(mdna_text, '') || ' ' || coalesce(risk_factors_text, ''))"
    return f"CAST((length({both}) - length(replace({both}, '{word}', ''))) // {len(word)} AS INTEGER)"


_MENTIONS = ", ".join(f"{_needle(w)} AS {stem}_mentions" for stem, w in KEYWORDS.items())
_TOTAL = " + ".join(f"{stem}_mentions" for stem in KEYWORDS)
_STEMS = ", ".join(f"{stem}_mentions" for stem in KEYWORDS)
LANGUAGE = f"mdna_word_count, {_STEMS}, risk_word_total, risk_words_per_1000"
_SERIES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERIES_OF_EVENT.items())
_TAGS = "[" + ", ".join(f"'{t}'" for t in FACT_TAGS) + "]"


def _macro_join(series: str, alias: str) -> str:
    return (
        f"LEFT JOIN macro_ranges {alias} ON {alias}.series_id = '{series}' "
        f"AND anchor_date >= {alias}.observation_date "
        f"AND ({alias}.next_date IS NULL OR anchor_date < {alias}.next_date)"
    )


RELATIONS: dict[str, str] = {
    "companies": """
        SELECT 'C' || c_custkey AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
               c_name AS company_name, c_mktsegment AS sector, n_name AS industry
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "fundamentals": """
        SELECT 'C' || c_custkey || '|' || y || 'Q4' AS fundamental_id, 'C' || c_custkey AS ticker,
               CAST(y AS INTEGER) AS fiscal_year, 4 AS fiscal_quarter, period_end_date,
               revenue, cost_of_revenue, net_income, total_assets, total_liabilities,
               c_acctbal AS total_equity, total_debt, shares_outstanding, close_price
        FROM (
            SELECT o_custkey, year(o_orderdate) AS y, max(CAST(o_orderdate AS DATE)) AS period_end_date,
                   round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
                   round(sum(l_extendedprice * 0.6::DOUBLE), 4) AS cost_of_revenue,
                   round(sum(l_extendedprice * (l_tax - l_discount + 0.02::DOUBLE)), 4) AS net_income,
                   round(sum(l_extendedprice), 4) AS total_assets,
                   round(sum(l_extendedprice * 0.4::DOUBLE), 4) AS total_liabilities,
                   round(sum(l_extendedprice * l_tax), 4) AS total_debt,
                   round(sum(l_quantity), 4) AS shares_outstanding,
                   max(l_extendedprice) AS close_price
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL) s
        JOIN customer ON o_custkey = c_custkey""",
    "raw_filings": """
        SELECT 'A' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS accession_number,
               lpad(CAST((doc_id // 3) * 7 AS VARCHAR), 10, '0') AS cik,
               'C' || (doc_id // 3) * 7 AS ticker, source AS company_name,
               CASE WHEN doc_id % 7 < 5 THEN '10-K' WHEN doc_id % 7 = 5 THEN '10-Q' ELSE '8-K' END AS form_type,
               DATE '1995-01-01' + CAST((doc_id * 397) % 2400 AS INTEGER) AS filing_date,
               'doc/' || doc_id || '/v' || copy AS document_url, text AS mdna_text,
               CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN lang || ' ' || text ELSE source END AS risk_factors_text,
               CAST(DATE '1995-01-01' + CAST((doc_id * 397) % 2400 AS INTEGER) AS TIMESTAMP) + to_hours(copy) AS ingested_at
        FROM documents CROSS JOIN (VALUES (0), (1)) c(copy)""",
    "filings": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY ingested_at DESC) AS rn
            FROM raw_filings) WHERE rn = 1""",
    "language": f"""
        SELECT *, {_TOTAL} AS risk_word_total,
               ({_TOTAL}) * 1000.0::DOUBLE / nullif(mdna_word_count, 0) AS risk_words_per_1000
        FROM (SELECT accession_number, ticker, form_type, filing_date,
                     length(coalesce(mdna_text, '')) AS mdna_chars,
                     length(coalesce(risk_factors_text, '')) AS risk_factors_chars,
                     CAST(length(coalesce(mdna_text, '')) - length(replace(coalesce(mdna_text, ''), ' ', '')) AS INTEGER) + 1
                         AS mdna_word_count,
                     {_MENTIONS}
              FROM filings)""",
    "raw_macro": f"""
        SELECT series_id, observation_date, mean - (1 - copy) AS value,
               CAST(day AS TIMESTAMP) + to_hours(copy) AS ingested_at
        FROM (SELECT CASE event_type {_SERIES} END AS series_id, CAST(ts AS DATE) AS day,
                     DATE '1995-01-01' + CAST((CAST(ts AS DATE) - DATE '2024-01-01') * 80 AS INTEGER) AS observation_date,
                     round(avg(value), 6) AS mean
              FROM events GROUP BY ALL) m CROSS JOIN (VALUES (0), (1)) c(copy)""",
    "macro": """
        SELECT series_id || '|' || observation_date AS macro_observation_id, * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id, observation_date ORDER BY ingested_at DESC) AS rn
            FROM raw_macro) WHERE rn = 1""",
    "contracts": """
        SELECT 'C' || l_partkey AS underlying,
               'O' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS contract_ticker,
               CASE WHEN l_returnflag = 'R' THEN 'put' ELSE 'call' END AS contract_type,
               l_extendedprice AS strike, CAST(l_shipdate AS DATE) + 90 AS expiration,
               CAST(l_quantity * 20 AS BIGINT) AS day_volume,
               CAST(l_linenumber - 1 AS BIGINT) AS open_interest,
               CASE WHEN l_tax > 0 THEN l_discount END AS implied_volatility,
               l_shipdate AS detected_at, CAST(l_shipdate AS DATE) AS activity_date
        FROM lineitem""",
    "options": """
        SELECT * FROM (
            SELECT *, CASE WHEN open_interest > 0 THEN CAST(day_volume AS DOUBLE) / open_interest
                           ELSE CAST(day_volume AS DOUBLE) END AS volume_oi_ratio
            FROM contracts) WHERE day_volume >= 100 AND volume_oi_ratio >= 3.0""",
    "mentions": """
        SELECT post_id || '|' || ticker AS mention_id, * FROM (
            SELECT 'e' || event_id AS post_id,
                   CASE event_type WHEN 'error' THEN 'stocks' WHEN 'click' THEN 'investing' ELSE 'wallstreetbets' END AS subreddit,
                   'C' || user_id AS ticker, event_type AS title, CAST(floor(value) AS INTEGER) AS score,
                   CAST(event_id % 50 AS INTEGER) AS num_comments,
                   ts - to_hours(8766 * 24) AS created_at,
                   CAST(ts - to_hours(8766 * 24) AS DATE) AS mention_date,
                   ts - to_hours(8766 * 24 - 1) AS ingested_at
            FROM events)""",
    "facts": f"""
        SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
               CASE WHEN kind = 10 THEN 'dei' ELSE 'us-gaap' END AS taxonomy,
               {_TAGS}[CAST(kind + 1 AS INTEGER)] AS concept,
               CASE WHEN kind IN (10, 11) THEN 'shares' ELSE 'USD' END AS unit,
               l_orderkey * 1000000 + l_partkey AS pos,
               CASE WHEN kind <= 4 THEN "end" - CAST(l_quantity * 15 AS INTEGER) END AS start, "end",
               CASE WHEN l_discount > 0.085 THEN -l_extendedprice ELSE l_extendedprice END AS val,
               CASE WHEN l_suppkey % 5 = 0 THEN 'Q3' ELSE 'FY' END AS fp,
               CASE WHEN l_returnflag = 'R' THEN '10-Q' ELSE '10-K' END AS form,
               CAST(l_shipdate AS DATE) AS filed
        FROM (SELECT *, l_partkey % {len(FACT_TAGS)} AS kind,
                     CASE WHEN l_linenumber = 7 THEN make_date(year(o_orderdate), 6, 30)
                          ELSE make_date(year(o_orderdate), 12, 31) END AS "end"
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "annual": """
        SELECT * FROM facts WHERE form = '10-K' AND fp = 'FY' AND val IS NOT NULL AND "end" IS NOT NULL
            AND (start IS NULL OR "end" - start >= 300)""",
    "ranked_facts": """
        SELECT cik, field, rank, "end", val, filed, concept FROM (
            SELECT *, row_number() OVER (PARTITION BY cik, field, rank, "end" ORDER BY filed DESC, pos) AS rn FROM (
                SELECT *, CASE concept
                        WHEN 'RevenueFromContractWithCustomerExcludingAssessedTax' THEN 0 WHEN 'Revenues' THEN 1
                        WHEN 'SalesRevenueNet' THEN 2 WHEN 'CostOfRevenue' THEN 1
                        WHEN 'LongTermDebtNoncurrent' THEN 1 ELSE 0 END AS rank,
                    CASE WHEN concept IN ('RevenueFromContractWithCustomerExcludingAssessedTax', 'Revenues', 'SalesRevenueNet')
                            THEN 'revenue'
                        WHEN concept = 'CostOfRevenue' THEN 'cost_of_revenue' WHEN concept = 'NetIncomeLoss' THEN 'net_income'
                        WHEN concept = 'Assets' THEN 'total_assets' WHEN concept = 'Liabilities' THEN 'total_liabilities'
                        WHEN concept = 'StockholdersEquity' THEN 'total_equity'
                        WHEN concept IN ('LongTermDebt', 'LongTermDebtNoncurrent') THEN 'total_debt'
                        WHEN concept = 'EntityCommonStockSharesOutstanding' THEN 'cover_shares'
                        WHEN concept = 'CommonStockSharesOutstanding' THEN 'balance_shares' END AS field
                FROM annual)
            WHERE field IS NOT NULL AND (val >= 0 OR field IN ('net_income', 'total_equity')))
        WHERE rn = 1""",
    "resolved": """
        SELECT cik, field, "end", val, filed, concept FROM (
            SELECT *, row_number() OVER (PARTITION BY cik, field, "end" ORDER BY
                CASE WHEN field = 'revenue' THEN val ELSE -rank END DESC, filed DESC, rank) AS rn
            FROM ranked_facts) WHERE rn = 1""",
    "macro_ranges": """
        SELECT series_id, observation_date, value,
               lead(observation_date) OVER (PARTITION BY series_id ORDER BY observation_date) AS next_date,
               value / nullif(lag(value, 12) OVER (PARTITION BY series_id ORDER BY observation_date), 0) - 1 AS yoy
        FROM macro""",
    "ratios": """
        SELECT fundamental_id, ticker, sector, fiscal_year, fiscal_quarter, period_end_date,
               close_price * shares_outstanding AS market_cap,
               (revenue - cost_of_revenue) / nullif(revenue, 0) AS gross_margin,
               net_income / nullif(revenue, 0) AS net_margin,
               CASE WHEN total_equity > 0 THEN total_debt / total_equity END AS debt_to_equity,
               total_liabilities / nullif(total_assets, 0) AS liabilities_to_assets,
               close_price * shares_outstanding / nullif(net_income * 4, 0) AS pe_ratio,
               CASE WHEN total_equity > 0 THEN net_income * 4 / total_equity END AS roe_annualised
        FROM fundamentals LEFT JOIN companies USING (ticker)""",
    "labelled": """
        SELECT c.fundamental_id, c.ticker, c.fiscal_year, c.period_end_date, c.revenue,
               CASE WHEN p.revenue IS NOT NULL AND p.revenue <> 0 THEN c.revenue / p.revenue - 1 END AS revenue_growth_1y,
               CAST(CASE WHEN n.revenue IS NULL THEN NULL WHEN n.revenue > c.revenue THEN 1 ELSE 0 END AS INTEGER) AS label
        FROM fundamentals c
        LEFT JOIN fundamentals n ON c.ticker = n.ticker AND n.fiscal_year = c.fiscal_year + 1
        LEFT JOIN fundamentals p ON c.ticker = p.ticker AND p.fiscal_year = c.fiscal_year - 1""",
    "matched": """
        SELECT fundamental_id, accession_number, filing_date FROM (
            SELECT l.fundamental_id, f.accession_number, f.filing_date,
                   row_number() OVER (PARTITION BY l.fundamental_id ORDER BY f.filing_date, f.accession_number) AS rn
            FROM labelled l JOIN filings f ON f.ticker = l.ticker AND f.form_type = '10-K'
                AND f.filing_date > l.period_end_date AND f.filing_date <= l.period_end_date + 180)
        WHERE rn = 1""",
    "panel": f"""
        SELECT a.ticker || '|' || a.fiscal_year AS ml_row_id, a.ticker, a.fiscal_year, a.period_end_date,
               a.accession_number, a.filing_date, a.label, c.sector, a.revenue, a.revenue_growth_1y,
               r.gross_margin, r.net_margin, r.debt_to_equity, r.liabilities_to_assets, r.roe_annualised,
               {LANGUAGE}, ff.value AS fed_funds_rate, yc.value AS yield_curve_spread,
               un.value AS unemployment_rate, cp.yoy AS cpi_yoy
        FROM (SELECT l.*, m.accession_number, m.filing_date,
                     coalesce(m.filing_date, l.period_end_date + 90) AS anchor_date
              FROM labelled l LEFT JOIN matched m USING (fundamental_id)) a
        JOIN companies c ON c.ticker = a.ticker AND c.sector <> '{EXCLUDED}'
        LEFT JOIN ratios r ON r.fundamental_id = a.fundamental_id
        LEFT JOIN language g ON g.accession_number = a.accession_number
        {_macro_join("FEDFUNDS", "ff")} {_macro_join("T10Y2Y", "yc")}
        {_macro_join("UNRATE", "un")} {_macro_join("CPIAUCSL", "cp")}""",
    "predictions": """
        SELECT DISTINCT 'C' || o_custkey AS ticker, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
               ((o_custkey * 7919 + year(o_orderdate) * 31) % 1000) / 1000.0::DOUBLE AS predicted_score,
               CAST(((o_custkey * 7919 + year(o_orderdate) * 31) % 1000) / 1000.0::DOUBLE >= 0.5 AS INTEGER) AS predicted_direction,
               'stand-in' AS model_artifact, TIMESTAMP '2002-01-01 00:00:00' AS scored_at
        FROM orders""",
    "panel_outcomes": f"""
        SELECT p.ticker || '|' || p.fiscal_year AS prediction_id, p.ticker, p.fiscal_year, f.sector,
               p.predicted_score, p.predicted_direction, f.label AS actual_direction,
               p.predicted_direction = f.label AS correct,
               CASE WHEN f.label IS NULL THEN 'pending' ELSE 'scored' END AS status,
               CASE WHEN f.label IS NULL THEN 'pending' WHEN p.fiscal_year <= {TRAIN_THROUGH} THEN 'train'
                    ELSE 'test' END AS data_split,
               p.model_artifact, p.scored_at
        FROM predictions p JOIN panel f USING (ticker, fiscal_year)""",
    "options_flow": """
        SELECT underlying, activity_date, count(*) AS flagged_contracts,
               CAST(sum(day_volume) AS BIGINT) AS total_volume,
               CAST(sum(CASE WHEN contract_type = 'call' THEN day_volume ELSE 0 END) AS DOUBLE)
                   / nullif(sum(CASE WHEN contract_type = 'put' THEN day_volume ELSE 0 END), 0) AS call_put_volume_ratio,
               max(volume_oi_ratio) AS max_volume_oi_ratio,
               round(avg(implied_volatility), 8) AS avg_implied_volatility
        FROM options GROUP BY underlying, activity_date""",
    "sentiment": """
        SELECT ticker, mention_date, count(*) AS mention_count, CAST(sum(score) AS BIGINT) AS total_score,
               CAST(sum(num_comments) AS BIGINT) AS total_comments, round(avg(score), 8) AS avg_score
        FROM mentions GROUP BY ticker, mention_date""",
    "filing_days": """
        SELECT ticker, filing_date, count(*) AS filings_filed FROM filings GROUP BY ticker, filing_date""",
    "signals": """
        SELECT s.ticker || '|' || s.d AS signal_id, s.ticker, s.d AS signal_date,
               coalesce(o.flagged_contracts, 0) AS flagged_contracts, coalesce(o.total_volume, 0) AS options_volume,
               o.call_put_volume_ratio, o.max_volume_oi_ratio, coalesce(m.mention_count, 0) AS mention_count,
               coalesce(m.total_score, 0) AS sentiment_score, coalesce(f.filings_filed, 0) AS filings_filed,
               least(100.0::DOUBLE, coalesce(o.max_volume_oi_ratio, 0) * 8 + coalesce(m.mention_count, 0) * 5
                   + coalesce(f.filings_filed, 0) * 10) AS composite_signal_score
        FROM (SELECT underlying AS ticker, activity_date AS d FROM options_flow
              UNION SELECT ticker, mention_date FROM sentiment
              UNION SELECT ticker, filing_date FROM filing_days) s
        LEFT JOIN options_flow o ON o.underlying = s.ticker AND o.activity_date = s.d
        LEFT JOIN sentiment m ON m.ticker = s.ticker AND m.mention_date = s.d
        LEFT JOIN filing_days f ON f.ticker = s.ticker AND f.filing_date = s.d
        JOIN companies c ON c.ticker = s.ticker""",
    "profiles": """
        SELECT c.ticker, c.cik, c.company_name, c.sector, c.industry,
               r.period_end_date AS latest_fundamentals_date, r.market_cap, r.pe_ratio, r.gross_margin,
               r.net_margin, r.debt_to_equity, r.roe_annualised,
               coalesce(f.n, 0) AS total_filings, f.last_filing_date
        FROM companies c
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY period_end_date DESC) AS rn FROM ratios) r
            ON r.ticker = c.ticker AND r.rn = 1
        LEFT JOIN (SELECT ticker, count(*) AS n, max(filing_date) AS last_filing_date FROM filings GROUP BY ticker) f
            ON f.ticker = c.ticker""",
    "outcomes": """
        SELECT 'D' || d.doc_id AS ticker, CAST(2020 + d.doc_id % 6 AS INTEGER) AS fiscal_year, lang AS sector,
               ((d.doc_id * 7919) % 1000) / 1000.0::DOUBLE AS predicted_score,
               CAST(((d.doc_id * 7919) % 1000) / 1000.0::DOUBLE >= 0.5 AS INTEGER) AS predicted_direction,
               quality AS actual_direction,
               CAST(((d.doc_id * 7919) % 1000) / 1000.0::DOUBLE >= 0.5 AS INTEGER) = quality AS correct,
               CASE WHEN quality IS NULL THEN 'pending' ELSE 'scored' END AS status,
               CASE WHEN quality IS NULL THEN 'pending' WHEN 2020 + d.doc_id % 6 <= 2023 THEN 'train' ELSE 'test' END AS data_split
        FROM documents d LEFT JOIN labels USING (doc_id)""",
    "test_rows": "SELECT * FROM outcomes WHERE data_split = 'test'",
    "ledger": """
        SELECT conv_id AS run_id, turn AS seq, CASE WHEN role = 'assistant' THEN 'large' ELSE 'small' END AS model,
               role AS agent_name, 'C' || conv_id AS ticker, length(text) // 4 AS input_tokens,
               length(text) // 8 AS output_tokens, turn * 10 AS cache_creation_input_tokens,
               turn * 100 AS cache_read_input_tokens
        FROM conversations""",
    "costed": """
        SELECT *, input_tokens * p / 1e6 + cache_creation_input_tokens * p / 1e6 * 1.25
                  + cache_read_input_tokens * p / 1e6 * 0.1 + output_tokens * 5 * p / 1e6 AS cost_usd
        FROM (SELECT *, CASE model WHEN 'large' THEN 10.0::DOUBLE ELSE 5.0::DOUBLE END AS p FROM ledger)""",
}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", sql)))
    return [name for name in RELATIONS if name in words]


def with_relations(sql: str) -> str:
    """Prefix ``sql`` with the stand-in relations it uses, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in _needs(RELATIONS[name]):
            if other != name:
                visit(other)
        ordered.append(name)

    for name in _needs(sql):
        visit(name)
    if not ordered:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in ordered) + "\n" + sql.strip()
