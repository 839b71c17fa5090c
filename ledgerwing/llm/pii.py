"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Four strict patterns give the base spans, which always stay. Looser generators
propose further, overlapping spans per kind; boosted trees score each proposal by
its format and its context, and the proposals above their kind's threshold are
added where they do not touch a base span. The trees are fitted here, on all
documents, whose training rows are counted by their binned features: base spans are positive, also rewritten into forms
that the strict patterns miss; proposals that touch no base span are negative where
their digits or their surroundings rule personal data out (``surely_none``), and
teach nothing where they may be what the trees should add. Quantities, decimals,
ranges, lists, years, table cells, numbered points and the like are written into places of
the same texts (``impersonal``) and whatever is proposed in them is negative, too.
Thresholds are the lowest scores that keep the wanted precision on held-out rows of
both sorts; a kind that lacks either sort adds nothing.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import written
from .tokens import sliced, tidy

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Kinds of training rows that the trees are grown on; beyond that, cuts are fewer and no row is left out.
MAX_PATTERNS = 100_000
#: Precision that a threshold must keep on held-out spans.
PRECISION = 0.995
TREES, DEPTH, RATE, CUTS = 40, 3, 0.3, 16

#: The strict patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match can only start where a run of digits starts, as every start within a
#: run fails or succeeds as the run's first does; so long runs are read once.
IP_RUN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
AT = re.compile(r"@|\[at\]|\(at\)")
LOOSE_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
LOOSE_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]+)+")
LOOSE_NUMBER = re.compile(r"(?<![0-9A-Za-z+(])[+(]?[0-9](?:[0-9 ().-]*[0-9])?(?![0-9A-Za-z])")
#: What rules personal data out: a numeric name in front, or a price.
ID_BEFORE = re.compile(
    r"(?:[#=/_]|\b(?:id|isbn|issn|ean|sku|doi|invoice|order|ticket|patent|serial|version)"
    r"(?: (?:id|no\.?|nr\.?|number))?[ :#]{0,3})\Z",
    re.IGNORECASE,
)
PRICE_BEFORE = re.compile(r"(?:[$\u20ac\u00a3\u00a5]|\b(?:usd|eur|gbp)) ?\Z", re.IGNORECASE)
PRICE_AFTER = re.compile(r" ?(?:[$\u20ac\u00a3\u00a5%]|(?:usd|eur|gbp)\b)", re.IGNORECASE)
COUNTRY = re.compile(r"\A\+[0-9]{1,3}(?:[ .-]+(?=[0-9(])|(?=\())")
LAST_LABEL = re.compile(r"[A-Za-z0-9-]+\Z")
CONTEXT = 24
CUES = (
    ("mail", "contact", "write", "reach"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "pay"),
    ("call", "tel", "phone", "fax", "mobile", "contact"),
)


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_emails(text: str) -> list[Span]:
    """Read from each at sign outwards, so that long runs of letters cost nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(Span(EMAIL, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[Span]:
    """Strict matches, leftmost and not overlapping per kind, ordered by kind and start."""
    found = base_emails(text)
    if not DIGIT.search(text):
        return found
    for m in IP_RUN.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(Span(IP, *m.span()))
    for m in CARD_RUN.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(CARD, *m.span()))
    if "+" in text:
        for m in PHONE_RUN.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append(Span(PHONE, *m.span()))
    return found


def candidates(text: str) -> list[Span]:
    """Loose proposals of all kinds; one place may be proposed as several kinds."""
    found = []
    for m in AT.finditer(text):
        local = LOOSE_LOCAL.search(text, max(0, m.start() - 65), m.start())
        domain = LOOSE_DOMAIN.match(text, m.end())
        if local and domain:
            found.append(Span(EMAIL, local.start(), domain.end()))
    if DIGIT.search(text):
        for m in LOOSE_NUMBER.finditer(text):
            if m.end() - m.start() < 7:
                continue
            run = m.group()
            n = len(_digits(run))
            if n <= 12 and run.count(".") == 3:
                found.append(Span(IP, *m.span()))
            if 13 <= n <= 19:
                found.append(Span(CARD, *m.span()))
            if 7 <= n <= 15:
                found.append(Span(PHONE, *m.span()))
    return found


def features(text: str, span: Span) -> list[float]:
    """Format of the span, then its surroundings."""
    run = text[span.start : span.end]
    groups = re.findall(r"[0-9]+", run)
    digits = "".join(groups)
    before = text[max(0, span.start - CONTEXT) : span.start].lower()
    left, right = text[span.start - 1 : span.start], text[span.end : span.end + 1]
    return [
        span.kind,
        len(run),
        len(digits),
        len(groups),
        len(groups[0]) if groups else 0,
        len(groups[-1]) if groups else 0,
        max((int(g[-9:]) for g in groups), default=0) if span.kind == IP else 0,
        run.startswith("+"),
        "(" in run and ")" in run,
        run.count("."),
        run.count("-"),
        run.count(" "),
        "@" in run,
        run[-2:].isalpha(),
        len(groups) > 1 and len(digits) <= 12 and all(int(b) - int(a) == 1 for a, b in pairwise(groups)),
        13 <= len(digits) <= 19 and luhn(digits),
        any(c in before for c in CUES[span.kind]),
        left.isspace() or left == "",
        right.isspace() or right == "",
        left in '=:"#$/_',
        right in '"/_%@',
    ]


def rewritten(text: str, span: Span) -> list[tuple[str, Span]]:
    """A base span in forms that the strict pattern does not match, in its context."""
    a, b = text[max(0, span.start - CONTEXT) : span.start], text[span.end : span.end + CONTEXT]
    run = text[span.start : span.end]
    if span.kind == PHONE:
        national = COUNTRY.sub("", run)
        forms = [national if national != run and len(_digits(national)) >= 7 else run[1:]]
    elif span.kind == EMAIL:
        plain = re.sub(r"[0-9]", "", run)
        forms = [x.replace("@", " [at] ") for x in dict.fromkeys((run, plain)) if base_emails(x)]
    elif span.kind == IP:
        forms = [run.replace(".", " . "), run.replace(".", ". ")]
    else:
        digits, sep = _digits(run), next((c for c in run if c in " -"), " ")
        forms = [".".join(digits[k : k + 4] for k in range(0, len(digits), 4))]
        # Shorter cards: 4-6-5, 4-6-4 and 4-3-3-3 digits, the last one made to fit.
        for sizes in ((4, 6, 5), (4, 6, 4), (4, 3, 3, 3)):
            n = sum(sizes)
            short = next(c for c in (digits[: n - 1] + d for d in "0123456789") if luhn(c))
            ends = np.cumsum(sizes).tolist()
            forms += [short, sep.join(short[e - k : e] for k, e in zip(sizes, ends, strict=True))]
    return [(a + f + b, Span(span.kind, len(a), len(a) + len(f))) for f in forms]


def _is_date(groups: list[str]) -> bool:
    """Years, or a date in digits, with or without a time behind it."""
    if all(len(g) == 4 and "1900" <= g <= "2099" for g in groups):
        return True
    if len(groups) == 1 and len(groups[0]) in (8, 12, 14):
        g = groups[0]
        groups = [g[:4], g[4:6], g[6:8], *(g[k : k + 2] for k in range(8, len(g), 2))]
    if len(groups) < 3 or any(len(g) > 2 for g in groups[3:]):
        return False
    if len(groups[0]) == 4:
        year, days = groups[0], groups[1:3]
    else:
        year, days = groups[2], groups[:2]
    if not (len(year) == 4 and "1900" <= year <= "2099" and all(len(d) <= 2 for d in days)):
        return False
    low, high = sorted(map(int, days))
    return 1 <= low <= 12 and high <= 31


def surely_none(text: str, span: Span) -> bool:
    """Whether a proposal cannot be personal data of its kind, whatever its form."""
    run = text[span.start : span.end]
    if span.kind == EMAIL:
        last = LAST_LABEL.search(run).group()
        return len(last) < 2 or not any(c.isalpha() for c in last)
    groups = re.findall(r"[0-9]+", run)
    if span.kind == IP:
        parts = [p.strip(" ()-") for p in run.split(".")]
        return any(not p.isdigit() or int(p) > 255 for p in parts)
    digits = "".join(groups)
    if span.kind == CARD and not luhn(digits):
        return True
    before, after = text[max(0, span.start - CONTEXT) : span.start], text[span.end : span.end + 4]
    if ID_BEFORE.search(before) or PRICE_BEFORE.search(before) or PRICE_AFTER.match(after):
        return True
    if span.kind == CARD:
        return len(digits) == 13 and digits[:3] in ("978", "979")
    # A decimal number has one point and no other mark; 555.2652 may be dialled.
    decimal = len(groups) == 2 and run == ".".join(groups) and [len(g) for g in groups] != [3, 4]
    return decimal or len(groups) > 7 or _is_date(groups)


def impersonal_forms(rng: random.Random, words: list[str]) -> list[str]:
    """Numbers and at signs of ordinary prose that the generators take for candidates."""
    big = rng.randrange(10 ** rng.randint(6, 14), 10**15)
    point = rng.randint(8, 60)
    word = lambda: rng.choice(words)
    return [
        f"{big:,}".replace(",", rng.choice(" .")),
        str(rng.randrange(10**6, 10 ** rng.randint(7, 12))),
        f"{rng.randrange(1, 1000)}.{rng.randrange(10**6, 10**10)}",
        " ".join(str(rng.randrange(1, 10) * 10 ** rng.randint(1, 3)) for _ in range(rng.randint(3, 5))),
        "  ".join(str(rng.randrange(0, 10000)) for _ in range(rng.randint(3, 6))),
        f"{rng.randrange(10**3, 10**7)}-{rng.randrange(10**3, 10**7)}",
        " ".join(str(rng.randint(1800, 2100)) for _ in range(rng.randint(2, 4))),
        f"{rng.randint(1900, 2099)}-{rng.randint(1900, 2099)} {rng.randrange(1, 10**4)}",
        f"{rng.randrange(10**5, 10**8)} ({rng.randrange(1, 100)})",
        ". ".join(str(point + i) for i in range(4)),
        f"{word()} @ {word()}. {word().title()}",
        f"{word()}{rng.randrange(100)} @ {word()}{rng.randrange(10)}. {word().title()}",
        f"{word()} [at] {word()}.{rng.randrange(100)}",
    ]


def impersonal(text: str, rounds: int) -> list[tuple[str, Span]]:
    """Proposals within forms that are no personal data, in places of the text between its words."""
    rng = random.Random(zlib.crc32(text.encode()))
    words = re.findall(r"[^\W\d_]{2,12}", text)[:200]
    if not words:
        return []
    found = []
    for _ in range(rounds):
        for form in impersonal_forms(rng, words):
            at = rng.randrange(len(text))
            before = re.sub(r"[0-9@(+]", "", text[max(0, at - CONTEXT) : at]).rstrip() + " "
            after = " " + re.sub(r"[0-9@)]", "", text[at : at + CONTEXT]).lstrip()
            where = before + form + after
            inside = (s for s in candidates(where) if len(before) <= s.start and s.end <= len(before) + len(form))
            found += [(where, s) for s in inside]
    return found


def labelled(text: str) -> list[tuple[list[float], int]]:
    """Training rows of one text: features and whether the span is personal data."""
    base = base_spans(text)
    rows = [(features(text, s), 1) for s in base]
    rows += [(features(*other), 1) for s in base for other in rewritten(text, s)]
    loose = (s for s in candidates(text) if not _touches(s, base))
    rows += [(features(text, s), 0) for s in loose if surely_none(text, s)]
    rows += [(features(*other), 0) for other in impersonal(text, 1 if base else 0)]
    return rows


def _touches(span: Span, others: list[Span]) -> bool:
    return any(o.start < span.end and span.start < o.end for o in others)


class Trees(NamedTuple):
    """Boosted trees of equal depth as arrays: feature and cut per inner node, value per leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    thresholds: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                right = x[np.arange(len(x)), f[node]] > c[node]
                node = 2 * node + 1 + right
            total += v[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))

    def to_json(self) -> str:
        parts = (self.base, self.feature.tolist(), self.cut.tolist(), self.value.tolist())
        return json.dumps([*parts, self.thresholds])

    @staticmethod
    def from_json(text: str) -> Trees:
        base, feature, cut, value, thresholds = json.loads(text)
        return Trees(base, np.array(feature), np.array(cut), np.array(value), tuple(thresholds))


def cut_places(values: np.ndarray, n: np.ndarray, cuts: int = CUTS) -> np.ndarray:
    """Quantiles of a feature whose sorted ``values`` occur ``n`` times each, and its lowest values."""
    at = np.linspace(0, 1, cuts) * (n.sum() - 1)
    low, high = (values[np.searchsorted(np.cumsum(n), f(at), side="right")] for f in (np.floor, np.ceil))
    return np.unique(np.concatenate((low + (high - low) * (at % 1), values[: cuts // 4])))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    n: np.ndarray | None = None,
    held: np.ndarray | None = None,
    cuts: list[np.ndarray] | None = None,
) -> Trees:
    """Newton boosting on the logistic loss, cuts at quantiles.

    Row ``i`` stands for ``n[i]`` equal ones (1). The rows of ``held`` (every fourth)
    are not learned from and set the thresholds. A kind whose held-out rows reach the
    precision nowhere, or that has none that are positive, gets a threshold no score reaches.
    """
    n = np.ones(len(y)) if n is None else n
    held = np.arange(len(y)) % 4 == 3 if held is None else held
    xt, yt, nt = x[~held], y[~held], n[~held]
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    rate = np.clip((yt * nt).sum() / nt.sum() if len(yt) else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    trees = Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), ())
    if len(yt):
        if cuts is None:
            cuts = []
            for column in xt.T:
                values, at = np.unique(column, return_inverse=True)
                cuts.append(cut_places(values, np.bincount(at, nt)))
        raw, made = np.full(len(yt), base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = nt * (yt - p), nt * np.maximum(p * (1 - p), 1e-6)
            made.append(_grow(xt, grad, hess, cuts))
            raw += Trees(0.0, *(np.array([part]) for part in made[-1]), ()).score_raw(xt)
        trees = Trees(base, *(np.array(part) for part in zip(*made, strict=True)), ())
    scores, thresholds = trees.score(x[held]), []
    for kind in range(len(KINDS)):
        own = x[held][:, 0] == kind
        thresholds.append(_threshold(scores[own], y[held][own], n[held][own]))
    return trees._replace(thresholds=tuple(thresholds))


def _score_raw(self: Trees, x: np.ndarray) -> np.ndarray:
    p = self.score(x)
    return np.log(p / (1 - p))


Trees.score_raw = _score_raw


def _threshold(scores: np.ndarray, labels: np.ndarray, n: np.ndarray) -> float:
    """Midway between the lowest score that keeps the precision and the next one below.

    Where all rows keep it, no row says where personal data ends: then no score is enough.
    """
    order = np.argsort(-scores, kind="stable")
    s, right, taken = scores[order], np.cumsum((labels * n)[order]), np.cumsum(n[order])
    last = np.append(s[1:] != s[:-1], True)
    good = np.flatnonzero((right >= PRECISION * taken) & last & (right > 0))
    if not len(good):
        return 2.0
    at = good[-1]
    return float((s[at] + s[at + 1]) / 2) if at + 1 < len(s) else 2.0


def _grow(x, grad, hess, cuts):
    """One tree, level by level; a node without a useful cut sends all rows left."""
    inner = 2**DEPTH - 1
    feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    for at in range(inner):
        rows = np.flatnonzero(node == at)
        best = 1e-9
        g, h = grad[rows], hess[rows]
        whole = g.sum() ** 2 / (h.sum() + 1)
        for f, places in enumerate(cuts if len(rows) else ()):
            to = np.searchsorted(places, x[rows, f])
            gl = np.cumsum(np.bincount(to, g, len(places) + 1))[:-1]
            hl = np.cumsum(np.bincount(to, h, len(places) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - whole
            if len(gain) and gain.max() > best:
                best, feature[at], cut[at] = gain.max(), f, places[gain.argmax()]
        node[rows] = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
    leaf = node - inner
    value = RATE * np.bincount(leaf, grad, 2**DEPTH) / (np.bincount(leaf, hess, 2**DEPTH) + 1)
    return feature, cut, value


def training_patterns(docs: DataFrame) -> DataFrame:
    """``(x, y, held, n)``: how often each training row occurs in all of ``docs(doc_id, text)``.

    About every fourth row is held out, by a hash of its document's id and its place there.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text"), strict=True):
                made = labelled(text.as_py())
                yield pa.RecordBatch.from_pydict(
                    {
                        "h": pa.array([h] * len(made), pa.int64()),
                        "i": pa.array(range(len(made)), pa.int64()),
                        "x": pa.array([[float(v) for v in x] for x, _ in made], pa.list_(pa.float64())),
                        "y": pa.array([y for _, y in made], pa.int64()),
                    }
                )

    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    source = known.select(F.xxhash64("doc_id").alias("h"), "text")
    found = source.mapInArrow(tidy(rows), "h long, i long, x array<double>, y long")
    held = F.pmod(F.xxhash64("h", "i"), F.lit(4)) == 3
    return found.groupBy("x", "y", held.alias("held")).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, max_patterns: int = MAX_PATTERNS) -> Trees:
    """Fit on all documents; rows without an id or a text are not learned from.

    Trees compare features with cuts only, so rows between the same cuts are one
    pattern, and counts of patterns are all that the trees need. With more than
    ``max_patterns`` of them there are fewer cuts. Empty tables give trees that add nothing.
    """
    width = len(features("", Span(0, 0, 0)))
    rows = written(training_patterns(docs), "training-patterns")
    cells = rows.where("NOT held").select(F.posexplode("x").alias("f", "v"), "n")
    counted = cells.groupBy("f", "v").agg(F.sum("n").alias("n")).toPandas().sort_values(["f", "v"])
    if counted.empty:
        return fit_trees(np.zeros((0, width)), np.zeros(0))
    columns = [(c["v"].to_numpy(), c["n"].to_numpy()) for _, c in counted.groupby("f")]
    cuts = CUTS
    while True:
        places = [np.arange(len(KINDS)), *(cut_places(v, n, cuts) for v, n in columns[1:])]
        patterns = rows.groupBy(_bins(places).alias("bins"), "y", "held").agg(F.sum("n").alias("n"))
        patterns = written(patterns, "binned-patterns")
        if cuts <= 2 or patterns.count() <= max_patterns:
            break
        cuts //= 2
    table = patterns.toPandas()
    table = table.sort_values(["bins", "y", "held"], key=lambda c: c.map(tuple) if c.name == "bins" else c)
    bins = np.array(table["bins"].tolist(), int).reshape(-1, width)
    # Between two cuts every value is as good as the upper one, beyond the last as any larger.
    x = np.stack([np.append(p, p[-1] + 1)[b] for p, b in zip(places, bins.T, strict=True)], axis=1)
    return fit_trees(x, table["y"].to_numpy(), table["n"].to_numpy(float), table["held"].to_numpy(bool), places)


def _bins(places: list[np.ndarray]) -> Column:
    """Number of the feature's cuts below each value of ``x``."""

    def below(own: np.ndarray, value: Column) -> Column:
        return F.size(F.filter(F.lit([float(p) for p in own]), lambda p: p < value))

    return F.array(*[below(own, F.col("x")[k]) for k, own in enumerate(places)])


def select_spans(text: str, trees: Trees, scored: bool = True) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and the proposals that the trees add."""
    base = base_spans(text)
    loose = [s for s in candidates(text) if not _touches(s, base)] if scored else []
    if not loose:
        return base, base
    scores = trees.score(np.array([features(text, s) for s in loose], float))
    added: list[Span] = []
    for score, s in sorted(zip(scores.tolist(), loose, strict=True), key=lambda p: (-p[0], p[1])):
        if score >= trees.thresholds[s.kind] and not _touches(s, added):
            added.append(s)
    return base, sorted([*base, *added])


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def find_spans(docs: DataFrame, trees: Trees) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``, in one scan.

    ``n_email, n_ip, n_card, n_phone`` count the base spans, ``base_sha256`` is the
    digest of their list and ``spans`` lists all spans as ``kind:start:end``, in
    code points, by kind and start. NULL and empty texts have none; repeated rows
    come out repeated, NULL ``doc_id`` stays.
    """
    source = docs.select("doc_id", "text")
    model = trees.to_json()
    counts = [f"n_{k}" for k in KINDS]
    schema = StructType(
        [
            source.schema["doc_id"],
            *(StructField(c, LongType()) for c in counts),
            StructField("base_sha256", StringType()),
            StructField("spans", StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Trees.from_json(model)
        for batch in batches:
            rows = {c: [] for c in (*counts, "base_sha256", "spans")}
            for text in batch.column("text"):
                base, every = select_spans(text.as_py() or "", fitted)
                for k, c in enumerate(counts):
                    rows[c].append(sum(s.kind == k for s in base))
                rows["base_sha256"].append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                rows["spans"].append(spans_text(every))
            arrays = [pa.array(rows[c], pa.int64()) for c in counts]
            arrays += [pa.array(rows[c], pa.string()) for c in ("base_sha256", "spans")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema.names)

    return source.mapInArrow(tidy(run), schema)


def redact(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced as one, named by the first. Other columns stay;
    NULL texts stay NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Trees.from_json(model)
        for batch in sliced(batches):
            at = batch.schema.get_field_index("text")
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                spans = select_spans(text, fitted)[1] if text else []
                parts, done = [], 0
                for s in sorted(spans, key=lambda s: (s.start, s.kind)):
                    if s.start >= done:
                        parts += [text[done : s.start], f"[{KINDS[s.kind].upper()}]"]
                    done = max(done, s.end)
                texts.append("".join([*parts, text[done:]]) if parts else text)
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    model = trees.to_json()
    return docs.mapInArrow(tidy(run), docs.schema)
