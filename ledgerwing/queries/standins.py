"""The engine's relations derived from the driver tables.

The driver tables hold orders, events and documents, not filings. Each function
maps them to one landing contract with plain arithmetic over whole tables, so
the library functions run unchanged. ``standins_sql`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import intermediate, marts, staging
from ..session import file_stamp, scratch_dir
from ..sources.feeds import unusual_activity

#: The corpus does not contain the risk vocabulary, so other needles stand in.
KEYWORDS = {
    "litigation": "tion",
    "impairment": "ent",
    "decline": "de ",
    "uncertain": "un",
    "recession": "re",
}
EXCLUDED = "BUILDING"
TRAIN_THROUGH = 1998
SERIES_OF_EVENT = {
    "error": "FEDFUNDS",
    "click": "T10Y2Y",
    "view": "UNRATE",
    "purchase": "CPIAUCSL",
    "signup": "GDP",
}
FORUM_OF_EVENT = {"error": "stocks", "click": "investing"}
FACT_TAGS = (
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "Revenues",
    "SalesRevenueNet",
    "CostOfRevenue",
    "NetIncomeLoss",
    "Assets",
    "Liabilities",
    "StockholdersEquity",
    "LongTermDebt",
    "LongTermDebtNoncurrent",
    "EntityCommonStockSharesOutstanding",
    "CommonStockSharesOutstanding",
    "UnrelatedTag",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table, as it lies."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the cluster, where so few files hold them that most cores would idle.

    For rows that take long each: the bytes of a file say nothing of the work on it.
    """
    wanted = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def text_of(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def copies(df: DataFrame) -> DataFrame:
    """Every row delivered twice: ``copy`` 0 first, 1 later."""
    return df.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))


def case_of(column: str, mapping: dict[str, str], default: str | None = None) -> Column:
    out: Column = F.lit(default)
    for key, value in mapping.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def shift_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + hours.cast("long") * 3_600_000_000)


def raw_companies(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            text_of("C", F.col("c_custkey")).alias("ticker"),
            F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("industry"),
        )
    )


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return staging.companies(raw_companies(spark, sf))


def raw_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    """The fundamentals landing table, written once per session and table folder."""
    return _written(spark, sf, "raw_fundamentals", build_fundamentals)


def build_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    """Customer-years; line items are summed per order before the join.

    Lines of an order lie far apart, so partial sums would merge little: the four columns
    of the lines are shuffled by order instead of their eight sums. What is a multiple
    of the price sum is derived last.
    """
    price = F.col("l_extendedprice")
    sums = {
        "revenue": price * (1 - F.col("l_discount")),
        "net_income": price * (F.col("l_tax") - F.col("l_discount") + F.lit(0.02)),
        "total_assets": price,
        "total_debt": price * F.col("l_tax"),
        "shares_outstanding": F.col("l_quantity"),
    }
    per_order = (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
        .where(F.col("l_orderkey").isNotNull())
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(*[F.sum(e).alias(n) for n, e in sums.items()], F.max(price).alias("close_price"))
    )
    day = F.to_date("o_orderdate")
    per_year = (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_custkey", day.alias("day"))
        .where(F.col("o_custkey").isNotNull())
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", F.year("day").alias("fiscal_year"))
        .agg(
            F.max("day").alias("period_end_date"),
            *[F.sum(n).alias(n) for n in sums],
            F.max("close_price").alias("close_price"),
        )
    )
    balance = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    years = per_year.join(balance, F.col("o_custkey") == F.col("c_custkey"))
    assets = F.col("total_assets")
    return years.select(
        text_of("C", F.col("c_custkey")).alias("ticker"),
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.lit(4).alias("fiscal_quarter"),
        "period_end_date",
        F.round("revenue", 4).alias("revenue"),
        F.round(assets * F.lit(0.6), 4).alias("cost_of_revenue"),
        F.round("net_income", 4).alias("net_income"),
        F.round(assets, 4).alias("total_assets"),
        F.round(assets * F.lit(0.4), 4).alias("total_liabilities"),
        F.col("c_acctbal").alias("total_equity"),
        F.round("total_debt", 4).alias("total_debt"),
        F.round("shares_outstanding", 4).alias("shares_outstanding"),
        "close_price",
    )


def fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return staging.fundamentals(raw_fundamentals(spark, sf))


def raw_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as filings, each delivered twice with a newer address."""
    doc = F.col("doc_id")
    filed = F.date_add(F.lit("1995-01-01").cast("date"), ((doc * 397) % 2400).cast("int"))
    form = F.when(doc % 7 < 5, "10-K").when(doc % 7 == 5, "10-Q").otherwise("8-K")
    risk = (
        F.when(doc % 3 == 0, None)
        .when(doc % 3 == 1, F.concat_ws(" ", "lang", "text"))
        .otherwise(F.col("source"))
    )
    base = table(spark, sf, "documents").select(
        text_of("A", F.lpad(doc.cast("string"), 8, "0")).alias("accession_number"),
        F.lpad((F.floor(doc / 3) * 7).cast("string"), 10, "0").alias("cik"),
        text_of("C", (F.floor(doc / 3) * 7)).alias("ticker"),
        F.col("source").alias("company_name"),
        form.alias("form_type"),
        filed.alias("filing_date"),
        F.col("text").alias("mdna_text"),
        risk.alias("risk_factors_text"),
        "doc_id",
    )
    return copies(base).select(
        "accession_number",
        "cik",
        "ticker",
        "company_name",
        "form_type",
        "filing_date",
        text_of("doc/", doc, "/v", F.col("copy")).alias("document_url"),
        "mdna_text",
        "risk_factors_text",
        shift_hours(F.col("filing_date").cast("timestamp"), F.col("copy")).alias("ingested_at"),
    )


def filings(spark: SparkSession, sf: str) -> DataFrame:
    return staging.filings(raw_filings(spark, sf))


def narrow_filings(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.narrow_filings(raw_filings(spark, sf), KEYWORDS)


def filing_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated filings without text or features: a narrow shuffle."""
    return staging.filings(
        raw_filings(spark, sf).withColumns(
            {"mdna_text": F.lit(None).cast("string"), "risk_factors_text": F.lit(None).cast("string")}
        )
    ).drop("mdna_text", "risk_factors_text")


def raw_macro(spark: SparkSession, sf: str) -> DataFrame:
    """Daily event means as series, 80 days apart; the first copy is off by one."""
    day = F.to_date("ts")
    daily = (
        table(spark, sf, "events")
        .groupBy(case_of("event_type", SERIES_OF_EVENT).alias("series_id"), day.alias("day"))
        .agg(F.round(F.avg("value"), 6).alias("mean"))
    )
    offset = F.datediff("day", F.lit("2024-01-01").cast("date")) * 80
    return copies(
        daily.withColumn("observation_date", F.date_add(F.lit("1995-01-01").cast("date"), offset))
    ).select(
        "series_id",
        "observation_date",
        (F.col("mean") - (1 - F.col("copy"))).alias("value"),
        shift_hours(F.col("day").cast("timestamp"), F.col("copy")).alias("ingested_at"),
    )


def macro(spark: SparkSession, sf: str) -> DataFrame:
    return staging.macro_observations(raw_macro(spark, sf))


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as option contracts before any flagging."""
    return table(spark, sf, "lineitem").select(
        text_of("C", F.col("l_partkey")).alias("underlying"),
        text_of("O", F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey")).alias(
            "contract_ticker"
        ),
        F.when(F.col("l_returnflag") == "R", "put").otherwise("call").alias("contract_type"),
        F.col("l_extendedprice").alias("strike"),
        F.date_add(F.to_date("l_shipdate"), 90).alias("expiration"),
        (F.col("l_quantity") * 20).cast("long").alias("day_volume"),
        (F.col("l_linenumber") - 1).cast("long").alias("open_interest"),
        F.when(F.col("l_tax") > 0, F.col("l_discount")).alias("implied_volatility"),
        F.col("l_shipdate").cast("timestamp").alias("detected_at"),
    )


def options(spark: SparkSession, sf: str) -> DataFrame:
    return staging.options_activity(unusual_activity(contracts(spark, sf)))


def raw_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as mentions in January 2000; the first copy has a lower-case ticker."""
    made = shift_hours(F.col("ts").cast("timestamp"), F.lit(-8766 * 24))
    return copies(table(spark, sf, "events")).select(
        text_of("e", F.col("event_id")).alias("post_id"),
        case_of("event_type", FORUM_OF_EVENT, "wallstreetbets").alias("subreddit"),
        F.concat(F.when(F.col("copy") == 0, "c").otherwise("C"), F.col("user_id").cast("string")).alias(
            "ticker"
        ),
        F.col("event_type").alias("title"),
        F.floor("value").cast("int").alias("score"),
        (F.col("event_id") % 50).cast("int").alias("num_comments"),
        made.alias("created_at"),
        shift_hours(made, F.col("copy")).alias("ingested_at"),
    )


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return staging.sentiment_mentions(raw_mentions(spark, sf))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as tagged facts of their customer and order year."""
    rows = (
        table(spark, sf, "lineitem")
        .join(
            table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y")),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .withColumn("kind", (F.col("l_partkey") % len(FACT_TAGS)).cast("int"))
        .withColumn(
            "end",
            F.when(F.col("l_linenumber") == 7, F.make_date("y", F.lit(6), F.lit(30))).otherwise(
                F.make_date("y", F.lit(12), F.lit(31))
            ),
        )
    )
    tag = F.get(F.array(*[F.lit(t) for t in FACT_TAGS]), F.col("kind"))
    return rows.select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.when(F.col("kind") == 10, "dei").otherwise("us-gaap").alias("taxonomy"),
        tag.alias("concept"),
        F.when(F.col("kind").isin(10, 11), "shares").otherwise("USD").alias("unit"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_partkey")).alias("pos"),
        F.when(
            F.col("kind") <= 4, F.date_sub("end", (F.col("l_quantity") * 15).cast("int"))
        ).alias("start"),
        "end",
        F.when(F.col("l_discount") > 0.085, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("val"),
        F.when(F.col("l_suppkey") % 5 == 0, "Q3").otherwise("FY").alias("fp"),
        F.when(F.col("l_returnflag") == "R", "10-Q").otherwise("10-K").alias("form"),
        F.to_date("l_shipdate").alias("filed"),
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        text_of("p", F.col("doc_id")).alias("post_id"),
        F.lit("stocks").alias("subreddit"),
        F.col("source").alias("title"),
        F.col("text").alias("body"),
        F.col("n_chars").alias("score"),
        (F.col("doc_id") % 50).alias("num_comments"),
        (F.col("doc_id") * 3600 + 946_684_800).alias("created_utc"),
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """The feature panel, written once per session and table folder."""
    return _written(spark, sf, "ml_features", build_panel)


def build_panel(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.ml_features(
        companies(spark, sf),
        fundamentals(spark, sf),
        narrow_filings(spark, sf),
        macro(spark, sf),
        keywords=KEYWORDS,
        excluded_sector=EXCLUDED,
    )


_MARTS: dict[tuple, str] = {}
_SOURCES = ("customer", "nation", "orders", "lineitem", "documents", "events")


def _written(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """Marts are tables: build into the shared folder, then read while the inputs stay the same.

    The inputs are told by the names, sizes and times of their files, so a table
    that is rewritten under its old path gets a new mart.
    """
    stamp = tuple(file_stamp(spark, f"{sf}/{t}.parquet") for t in _SOURCES)
    key = (spark.sparkContext.applicationId, sf, name, stamp)
    if key not in _MARTS:
        path = scratch_dir(spark, name)
        build(spark, sf).write.parquet(path)
        _MARTS[key] = path
    return spark.read.parquet(_MARTS[key])


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A made-up score for every customer-year of the panel and beyond."""
    score = ((F.substring("ticker", 2, 20).cast("long") * 7919 + F.col("fiscal_year") * 31) % 1000) / 1000.0
    keys = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("fiscal_year")).distinct()
    years = keys.select(text_of("C", F.col("o_custkey")).alias("ticker"), "fiscal_year")
    return years.select(
        "ticker",
        "fiscal_year",
        score.cast("double").alias("predicted_score"),
        (score >= 0.5).cast("int").alias("predicted_direction"),
        F.lit("stand-in").alias("model_artifact"),
        F.lit("2002-01-01 00:00:00").cast("timestamp").alias("scored_at"),
    )


def panel_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return marts.prediction_outcomes(
        staging.model_predictions(predictions(spark, sf)), panel(spark, sf), TRAIN_THROUGH
    )


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as predictions, labels as outcomes; unlabelled ones are pending."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    year = (F.lit(2020) + F.col("doc_id") % 6).cast("int")
    score = ((F.col("doc_id") * 7919) % 1000) / F.lit(1000.0)
    up = (score >= 0.5).cast("int")
    label = F.col("quality")
    return docs.join(labels, "doc_id", "left").select(
        text_of("D", F.col("doc_id")).alias("ticker"),
        year.alias("fiscal_year"),
        F.col("lang").alias("sector"),
        score.alias("predicted_score"),
        up.alias("predicted_direction"),
        label.alias("actual_direction"),
        (up == label).alias("correct"),
        F.when(label.isNull(), "pending").otherwise("scored").alias("status"),
        F.when(label.isNull(), "pending")
        .when(year <= 2023, "train")
        .otherwise("test")
        .alias("data_split"),
    )


PRICES = {"large": (10.0, 50.0), "small": (5.0, 25.0)}


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as metered calls of one run each."""
    chars = F.length("text")
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("run_id"),
        F.col("turn").alias("seq"),
        F.when(F.col("role") == "assistant", "large").otherwise("small").alias("model"),
        F.col("role").alias("agent_name"),
        text_of("C", F.col("conv_id")).alias("ticker"),
        F.floor(chars / 4).cast("long").alias("input_tokens"),
        F.floor(chars / 8).cast("long").alias("output_tokens"),
        (F.col("turn") * 10).alias("cache_creation_input_tokens"),
        (F.col("turn") * 100).alias("cache_read_input_tokens"),
    )
