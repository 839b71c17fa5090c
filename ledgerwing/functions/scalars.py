"""Scalar expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The risk vocabulary counted in filing text (column stem -> needle).
RISK_KEYWORDS: dict[str, str] = {
    "litigation": "litigation",
    "impairment": "impairment",
    "decline": "decline",
    "uncertain": "uncertain",
    "recession": "recession",
}

#: SIC division ranges and their coarse sector.
SIC_DIVISIONS: tuple[tuple[int, int, str], ...] = (
    (100, 999, "Agriculture"),
    (1000, 1499, "Mining & Energy"),
    (1500, 1799, "Construction"),
    (2000, 3999, "Manufacturing"),
    (4000, 4999, "Transportation & Utilities"),
    (5000, 5199, "Wholesale Trade"),
    (5200, 5999, "Retail Trade"),
    (6000, 6799, "Financials"),
    (7000, 8999, "Services"),
    (9100, 9999, "Public Administration"),
)


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _d(value: Column | str) -> Column:
    return _c(value).cast("double")


def safe_div(top: Column | str, bottom: Column | str) -> Column:
    """Double division that is NULL, not an error, for a zero denominator."""
    return _d(top) / F.nullif(_d(bottom), F.lit(0.0))


def div_if_positive(top: Column | str, bottom: Column | str) -> Column:
    """Ratio that only has a meaning for a positive denominator."""
    return F.when(_c(bottom) > 0, _d(top) / _d(bottom))


def growth(current: Column | str, previous: Column | str) -> Column:
    """Relative change; NULL without a usable base."""
    return safe_div(current, previous) - F.lit(1.0)


def key_of(*parts: Column | str, sep: str = "|") -> Column:
    """Surrogate key text; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_c(part).cast("string"))
    return F.concat(*pieces)


def word_count(text: Column | str) -> Column:
    """Spaces plus one, so an empty text counts one word."""
    text = _c(text)
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return (spaces + F.lit(1)).cast("int")


def needle_count(lowered: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle`` in already lower-cased text.

    Byte lengths are O(1) on Spark's UTF-8 strings and give the same quotient
    as character lengths, because every removed piece is the needle itself.
    """
    lowered = _c(lowered)
    width = len(needle.encode("utf-8"))
    removed = F.octet_length(lowered) - F.octet_length(
        F.replace(lowered, F.lit(needle), F.lit(""))
    )
    return (removed / F.lit(width)).cast("int")


def sector_from_sic(sic: Column | str) -> Column:
    """Coarse sector of a SIC code; anything unparsable is ``Unknown``."""
    number = F.trim(_c(sic).cast("string")).try_cast("int")
    result = F.lit("Unknown")
    for low, high, label in reversed(SIC_DIVISIONS):
        result = F.when(number.between(low, high), F.lit(label)).otherwise(result)
    return result


def exchange_ticker(ticker: Column | str) -> Column:
    """Upper case, share classes written with a dash."""
    return F.upper(F.replace(_c(ticker), F.lit("."), F.lit("-")))


def pad_cik(cik: Column | str) -> Column:
    """Ten-digit zero-padded registry number; longer input is kept whole."""
    text = _c(cik).cast("string")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def is_close(a: Column | str, b: Column | str, rel: float = 1e-3, abs_: float = 1e-6) -> Column:
    """Symmetric closeness test on two non-NULL doubles."""
    a, b = _d(a), _d(b)
    slack = F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_))
    return F.abs(a - b) <= slack


def wilson(successes: Column | str, n: Column | str, z: float = 1.96) -> Column:
    """Wilson score interval as ``struct<low,high>``; (0, 0) for an empty set."""
    n_ = F.nullif(_d(n), F.lit(0.0))
    p = _d(successes) / n_
    z2 = z * z
    denom = F.lit(1.0) + F.lit(z2) / n_
    centre = (p + F.lit(z2) / (F.lit(2.0) * n_)) / denom
    half = (
        F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n_ + F.lit(z2) / (F.lit(4.0) * n_ * n_)) / denom
    )
    empty = _c(n) == 0
    return F.struct(
        F.when(empty, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - half)).alias("low"),
        F.when(empty, F.lit(0.0)).otherwise(F.least(F.lit(1.0), centre + half)).alias("high"),
    )


def attention_score(ratio: Column | str, mentions: Column | str, filings: Column | str) -> Column:
    """Bounded 0-100 attention heuristic (weights 8, 5 and 10)."""
    raw = (
        F.coalesce(_d(ratio), F.lit(0.0)) * F.lit(8.0)
        + _d(mentions) * F.lit(5.0)
        + _d(filings) * F.lit(10.0)
    )
    return F.least(F.lit(100.0), raw)


def token_estimate(*texts: Column | str) -> Column:
    """A quarter of the summed character counts, truncated."""
    chars: Column = F.lit(0)
    for text in texts:
        chars = chars + F.coalesce(F.length(_c(text)), F.lit(0))
    return F.floor(chars / F.lit(4)).cast("long")


def call_price(
    price_in: Column,
    price_out: Column,
    tokens_in: Column,
    tokens_out: Column,
    cache_write: Column | None = None,
    cache_read: Column | None = None,
) -> Column:
    """Cost of one call from per-million prices.

    Cache writes bill at 1.25 and cache reads at 0.1 of the input price.
    """
    zero = F.lit(0)
    per_in, per_out = price_in / F.lit(1e6), price_out / F.lit(1e6)
    write = cache_write if cache_write is not None else zero
    read = cache_read if cache_read is not None else zero
    return (
        tokens_in * per_in
        + write * per_in * F.lit(1.25)
        + read * per_in * F.lit(0.1)
        + tokens_out * per_out
    )

