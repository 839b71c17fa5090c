"""Loads of a company universe: a small one in one swap, a large one in resumable batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import conform
from ..functions.scalars import sector_from_sic
from ..operators.facts import fundamentals_history, latest_fundamentals
from ..operators.loads import replace_keys
from ..operators.versions import VersionedTables, folder_exists
from ..session import written
from ..sources.feeds import (
    company_info,
    explode_facts,
    fetch_sections,
    filing_listing,
    parse_macro,
    ticker_map,
)

# --- Fixed values ---------------------------------------------------------------
FILINGS_PER_COMPANY = 2
MACRO_LOOKBACK_DAYS = 730
ANNUAL_FORMS = ("10-K",)
# --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sources:
    """Documents of a universe, one row each.

    ``tickers(ticker, cik_str, title)``, ``submissions(ticker, cik, payload)``, ``archives(cik,
    name, payload)``, ``bodies(document_url, body)``, ``facts(cik, payload)``, ``macro(series_id, payload)``.
    """

    tickers: DataFrame
    submissions: DataFrame
    archives: DataFrame
    bodies: DataFrame
    facts: DataFrame
    macro: DataFrame


def universe_tables(
    sources: Sources,
    as_of: date,
    ingested_at: datetime,
    universe: Sequence[str] | None = None,
    filings_per_company: int = FILINGS_PER_COMPANY,
    lookback_days: int = MACRO_LOOKBACK_DAYS,
) -> dict[str, DataFrame]:
    """Landing tables of a universe (all companies if none is named).

    Per company its identity, its newest annual filings with their sections and its
    latest fundamental year; and the macro observations of the look-back window. A
    company without usable facts has no fundamentals row, a filing without a
    landed document no sections.
    """
    stamp = F.lit(ingested_at).cast("timestamp")
    companies = company_info(sources.submissions, ticker_map(sources.tickers).hint("merge"))
    if universe is not None:
        companies = companies.where(F.col("ticker").isin([t.upper() for t in universe]))
    companies = written(
        companies.select(
            "ticker",
            "cik",
            "company_name",
            sector_from_sic("sic").alias("sector"),
            F.coalesce("sic_description", F.lit("Unknown")).alias("industry"),
        ),
        "universe",
    )
    known = companies.select("cik", "ticker", "company_name")
    listed = sources.submissions.join(known.select("cik"), "cik", "left_semi")
    newest = filing_listing(
        listed, sources.archives, ANNUAL_FORMS, limit_per_company=filings_per_company
    )
    # Only the bodies of the chosen filings are read further. Documents are far larger than
    # their files or columns tell, so they are never sent to the driver to be broadcast.
    documents = newest.join(sources.bodies.hint("merge"), "document_url", "left")
    filings = fetch_sections(documents).join(known, "cik").select(
        "accession_number",
        "cik",
        "ticker",
        "company_name",
        "form_type",
        "filing_date",
        "document_url",
        F.col("mdna").alias("mdna_text"),
        F.col("risk_factors").alias("risk_factors_text"),
        stamp.alias("ingested_at"),
    )
    facts = explode_facts(sources.facts.join(known.select("cik"), "cik", "left_semi"))
    years = latest_fundamentals(fundamentals_history(facts)).join(known.select("cik", "ticker"), "cik")
    macro = parse_macro(sources.macro, start=as_of - timedelta(days=lookback_days), end=as_of)
    return {
        "raw_companies": conform(companies, "raw_companies"),
        "raw_filings": conform(filings, "raw_filings"),
        "raw_fundamentals": conform(years.drop("cik"), "raw_fundamentals"),
        "raw_macro_observations": conform(
            macro.withColumn("ingested_at", stamp), "raw_macro_observations"
        ),
    }


def load_universe(sources: Sources, target: VersionedTables, database: str | None = None, **options) -> int:
    """Load a universe and swap it in as one version; returns the version's number."""
    return target.publish(universe_tables(sources, **options), database)


# --- resumable batches ----------------------------------------------------------
CLAIMED, DONE, DROPPED = "claimed", "done", "dropped"
_LEDGER = "member string, state string, counts map<string,bigint>, reason string, entry bigint"


class RunLedger:
    """States of the members of a run, appended batch by batch.

    A batch first writes ``claimed`` rows and, after its tables are loaded, ``done`` and
    ``dropped`` ones; each append is one job, so a batch's final states appear together.
    ``entry`` counts the appends and tells which state of a member is the latest.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        """Append ``rows(member, state, counts, reason)`` as the next entry."""
        entry = (self.rows().agg(F.max("entry")).first()[0] or 0) + 1
        rows.select("member", "state", "counts", "reason", F.lit(entry).cast("long").alias("entry")).write.mode(
            "append"
        ).parquet(self.path)

    def status(self) -> DataFrame:
        """The latest state of every member that was ever claimed."""
        latest = F.max_by(F.struct("state", "counts", "reason"), F.col("entry")).alias("s")
        return self.rows().groupBy("member").agg(latest).select("member", "s.*")

    def pending(self, members: DataFrame, key: str) -> DataFrame:
        """Members that are neither done nor dropped; claimed ones were interrupted and count as pending."""
        ended = self.status().where(F.col("state") != CLAIMED).select(F.col("member").alias(key))
        return members.join(ended, key, "left_anti")


@dataclass(frozen=True)
class Loaded:
    """What a batch gives: rows per table, each with the member's key, and the members to drop."""

    tables: Mapping[str, DataFrame]
    dropped: DataFrame


def run_batches(
    members: DataFrame,
    key: str,
    ledger: RunLedger,
    load: Callable[[DataFrame], Loaded],
    paths: Mapping[str, str],
    batch_size: int,
    max_batches: int | None = None,
) -> int:
    """Load all pending members batch by batch; returns the number of batches that ended.

    Batches are hash classes of the pending members, about ``batch_size`` each, and every
    batch is a few distributed jobs. Tables are replaced by key, so a batch that was
    interrupted after some of its writes is simply loaded again, and members that are
    done or dropped are never touched twice. ``load(batch)`` returns :class:`Loaded`;
    dropped members get their reason and no rows. ``max_batches`` ends a run early.
    """
    pending = written(ledger.pending(members, key), "pending")
    n = math.ceil(pending.count() / batch_size)
    part = F.pmod(F.xxhash64(key), F.lit(max(n, 1)))
    ended = 0
    for i in range(n if max_batches is None else min(n, max_batches)):
        batch = pending.where(part == i)
        nothing = F.lit(None).cast("map<string,bigint>")
        ledger.append(
            batch.select(
                F.col(key).alias("member"), F.lit(CLAIMED).alias("state"), nothing.alias("counts"),
                F.lit(None).cast("string").alias("reason"),
            )
        )
        found = load(batch)
        reason = F.coalesce("reason", F.lit("no reason given")).alias("reason")
        dropped = written(found.dropped.select(key, reason).dropDuplicates([key]), "dropped-members")
        counts = []
        for name, rows in found.tables.items():
            rows = written(rows.join(dropped.select(key), key, "left_anti"), f"batch-{name}")
            replace_keys(rows, paths[name], key)
            counts.append(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit(name).alias("name"), "n"))
        ledger.append(_ended(batch.select(key), dropped, counts, key))
        ended += 1
    return ended


def _ended(batch: DataFrame, dropped: DataFrame, counts: Sequence[DataFrame], key: str) -> DataFrame:
    """Final states of a batch: rows per table of the loaded members, reasons of the others."""
    states = batch.join(dropped, key, "left").withColumn(
        "state", F.when(F.col("reason").isNull(), DONE).otherwise(DROPPED)
    )
    per_member = None
    for one in counts:
        per_member = one if per_member is None else per_member.unionByName(one)
    if per_member is None:
        states = states.withColumn("counts", F.create_map().cast("map<string,bigint>"))
    else:
        maps = per_member.groupBy(key).agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "n")))).alias("counts")
        )
        states = states.join(maps, key, "left")
    return states.select(F.col(key).cast("string").alias("member"), "state", "counts", "reason")
