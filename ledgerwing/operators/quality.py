"""Data-quality rules: each finds offending rows, an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


@dataclass(frozen=True)
class Rule:
    """One rule on one column; ``where`` limits the rows it applies to."""

    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    to: str = ""
    field: str = ""
    where: str = ""
    expression: str = ""

    @property
    def label(self) -> str:
        return f"{self.kind}({self.column})"


def unique(column: str) -> Rule:
    return Rule("unique", column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def accepted(column: str, *values) -> Rule:
    return Rule("accepted_values", column, values=values)


def relationship(column: str, to: str, field: str) -> Rule:
    return Rule("relationships", column, to=to, field=field)


def bounds(column: str, low: float, high: float, where: str = "") -> Rule:
    return Rule("bounds", column, low=low, high=high, where=where)


def invariant(name: str, violated: str) -> Rule:
    """A named condition that must hold nowhere."""
    return Rule("invariant", name, expression=violated)


def violation(rule: Rule) -> Column | None:
    """Row condition of a violation; None where a rule needs more than one row."""
    col = F.col(rule.column)
    if rule.kind == "not_null":
        bad = col.isNull()
    elif rule.kind == "accepted_values":
        bad = col.isNotNull() & ~col.isin(*rule.values)
    elif rule.kind == "bounds":
        bad = col.isNotNull() & ((col < rule.low) | (col > rule.high))
    elif rule.kind == "invariant":
        bad = F.expr(rule.expression)
    else:
        return None
    if rule.where:
        bad = bad & F.expr(rule.where)
    return F.coalesce(bad, F.lit(False))


def offending(df: DataFrame, rule: Rule, models: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows (or keys) that break a rule."""
    bad = violation(rule)
    if bad is not None:
        return df.where(bad)
    scope = df.where(rule.where) if rule.where else df
    scope = scope.where(F.col(rule.column).isNotNull())
    if rule.kind == "unique":
        return (
            scope.groupBy(rule.column)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1)
        )
    if rule.kind == "relationships":
        parent = (models or {})[rule.to].select(F.col(rule.field).alias(rule.column)).distinct()
        return scope.join(parent, rule.column, "left_anti")
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def checked_columns(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Rule]]:
    """What the rules need of a model, written in one pass over it, and the same rules on that.

    Row rules become flags; keys keep their values where the rule applies and are NULL elsewhere.
    """
    columns, narrow = [], []
    for i, rule in enumerate(rules):
        bad, name = violation(rule), f"c{i}"
        if bad is None:
            bad = F.when(F.expr(rule.where), F.col(rule.column)) if rule.where else F.col(rule.column)
            narrow.append(replace(rule, column=name, where=""))
        else:
            narrow.append(invariant(name, name))
        columns.append(bad.alias(name))
    return written(df.select(*columns), "checked-columns"), narrow


def run_checks(
    name: str,
    df: DataFrame,
    rules: Sequence[Rule],
    models: Mapping[str, DataFrame] | None = None,
    once: bool = False,
) -> DataFrame:
    """One row per rule: (model, rule, failures).

    All row rules share one pass; uniqueness and references add one
    aggregation or anti join each. A model that is costly to make is read
    ``once``: its :func:`checked_columns` are written, and all passes go over them.
    """
    labels = [r.label for r in rules]
    if once:
        df, rules = checked_columns(df, rules)
    label = dict(zip(rules, labels, strict=True))
    row_rules = [r for r in rules if violation(r) is not None]
    parts: list[DataFrame] = []
    if row_rules:
        counted = df.agg(
            *[
                F.count_if(violation(r)).alias(f"r{i}")
                for i, r in enumerate(row_rules)
            ]
        )
        pairs = F.array(
            *[
                F.struct(F.lit(label[r]).alias("rule"), F.col(f"r{i}").alias("failures"))
                for i, r in enumerate(row_rules)
            ]
        )
        parts.append(counted.select(F.explode(pairs).alias("x")).select("x.rule", "x.failures"))
    for rule in rules:
        if rule not in row_rules:
            parts.append(
                offending(df, rule, models)
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(label[rule]).alias("rule"), "failures")
            )
    return reduce(DataFrame.unionByName, parts).select(F.lit(name).alias("model"), "rule", "failures")


def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def violation_sql(rule: Rule) -> str | None:
    """The condition of :func:`violation` as SQL text; None where a rule needs more than one row."""
    column = f'"{rule.column}"'
    if rule.kind == "not_null":
        bad = f"{column} IS NULL"
    elif rule.kind == "accepted_values":
        bad = f"{column} NOT IN ({', '.join(_literal(v) for v in rule.values)})"
    elif rule.kind == "bounds":
        bad = f"({column} < {rule.low} OR {column} > {rule.high})"
    elif rule.kind == "invariant":
        bad = f"({rule.expression})"
    else:
        return None
    return f"{bad} AND ({rule.where})" if rule.where else bad


def checks_sql(name: str, source: str, rules: Sequence[Rule], sources: Mapping[str, str]) -> str:
    """One SELECT with the rows of :func:`run_checks`: (model, rule, failures).

    ``source`` is the model as SQL, ``sources`` the models that references point to. The
    model is evaluated once; all row rules are counted in one pass over it.
    """
    model = _literal(name)
    row_rules = [r for r in rules if violation_sql(r) is not None]
    parts = []
    if row_rules:
        labels = ", ".join(_literal(r.label) for r in row_rules)
        counts = ", ".join(f"count(*) FILTER (WHERE {violation_sql(r)})" for r in row_rules)
        parts.append(f"SELECT {model} AS model, unnest([{labels}]) AS rule, unnest([{counts}]) AS failures FROM m")
    for rule in rules:
        if rule in row_rules:
            continue
        column = f'"{rule.column}"'
        scope = f"{column} IS NOT NULL" + (f" AND ({rule.where})" if rule.where else "")
        if rule.kind == "unique":
            found = f"SELECT {column} FROM m WHERE {scope} GROUP BY {column} HAVING count(*) > 1"
        elif rule.kind == "relationships":
            known = f'SELECT "{rule.field}" FROM ({sources[rule.to]}) WHERE "{rule.field}" IS NOT NULL'
            found = f"SELECT {column} FROM m WHERE {scope} AND {column} NOT IN ({known})"
        else:
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        parts.append(f"SELECT {model}, {_literal(rule.label)}, count(*) FROM ({found})")
    return f"SELECT * FROM (WITH m AS MATERIALIZED ({source}) " + " UNION ALL ".join(parts) + ")"


# --- Fixed values: the rule sets of the models ----------------------------------
FORMS = ("10-K", "10-Q", "8-K", "DEF 14A", "S-1")
SERIES = ("FEDFUNDS", "CPIAUCSL", "UNRATE", "GDP", "DGS10", "T10Y2Y")
FORUMS = ("wallstreetbets", "investing", "stocks")
EXCLUDED_SECTOR = "Financials"
OUTSIDE_EXCLUDED = f"sector is null or sector != '{EXCLUDED_SECTOR}'"
PENDING_INVARIANT = (
    "(status = 'pending' and correct is not null) or (status = 'scored' and correct is null)"
)


def model_rules(outside_excluded: str = OUTSIDE_EXCLUDED) -> dict[str, list[Rule]]:
    """Rules of every staging, intermediate and mart model."""

    def keyed(column: str) -> list[Rule]:
        return [unique(column), not_null(column)]

    return {
        "stg_companies": [*keyed("ticker"), not_null("cik"), not_null("sector")],
        "stg_filings": [
            *keyed("accession_number"),
            not_null("ticker"),
            not_null("filing_date"),
            accepted("form_type", *FORMS),
        ],
        "stg_fundamentals": [
            *keyed("fundamental_id"),
            not_null("ticker"),
            relationship("ticker", "stg_companies", "ticker"),
            not_null("revenue"),
        ],
        "stg_macro_observations": [
            *keyed("macro_observation_id"),
            not_null("value"),
            accepted("series_id", *SERIES),
        ],
        "stg_options_activity": [
            *keyed("activity_id"),
            not_null("volume_oi_ratio"),
            accepted("contract_type", "call", "put"),
        ],
        "stg_sentiment_mentions": [*keyed("mention_id"), accepted("subreddit", *FORUMS)],
        "stg_transcript_segments": [
            *keyed("segment_id"),
            accepted("section", "prepared_remarks", "qa"),
        ],
        "stg_model_predictions": [
            not_null("ticker"),
            not_null("fiscal_year"),
            not_null("predicted_score"),
            accepted("predicted_direction", 0, 1),
        ],
        "int_financial_ratios": [
            *keyed("fundamental_id"),
            bounds("pe_ratio", -1000, 1000),
            bounds("debt_to_equity", 0, 1000),
            bounds("net_margin", -20, 3, where=outside_excluded),
            bounds("gross_margin", -5, 1, where=outside_excluded),
        ],
        "int_filing_language_features": [
            *keyed("accession_number"),
            not_null("risk_word_total"),
        ],
        "int_options_flow_daily": [*keyed("flow_id"), not_null("total_volume")],
        "int_sentiment_daily": [*keyed("sentiment_id"), not_null("mention_count")],
        "company_profile": [
            *keyed("ticker"),
            not_null("sector"),
            bounds("pe_ratio", -1000, 1000),
        ],
        "filing_history": [
            *keyed("accession_number"),
            not_null("ticker"),
            relationship("ticker", "company_profile", "ticker"),
            not_null("filing_date"),
        ],
        "signal_history": [
            *keyed("signal_id"),
            not_null("ticker"),
            relationship("ticker", "company_profile", "ticker"),
            not_null("composite_signal_score"),
            bounds("composite_signal_score", 0, 100),
        ],
        "sector_summary": [*keyed("sector"), not_null("company_count")],
        "ml_training_set": [
            *keyed("ml_row_id"),
            not_null("label"),
            accepted("label", 0, 1),
            *[
                not_null(c)
                for c in (
                    "ticker",
                    "fiscal_year",
                    "sector",
                    "revenue",
                    "fed_funds_rate",
                    "yield_curve_spread",
                )
            ],
        ],
        "ml_inference_set": [*keyed("ml_row_id"), not_null("ticker"), not_null("revenue")],
        "prediction_outcomes": [
            *keyed("prediction_id"),
            not_null("ticker"),
            not_null("fiscal_year"),
            accepted("predicted_direction", 0, 1),
            accepted("actual_direction", 0, 1),
            not_null("status"),
            accepted("status", "scored", "pending"),
            not_null("data_split"),
            accepted("data_split", "train", "test", "pending"),
            invariant("correct_iff_scored", PENDING_INVARIANT),
        ],
    }
