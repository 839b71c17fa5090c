"""Benchmark decontamination by spaced seeds.

A mask picks some of the words under it and ignores the others, so a passage
whose words were partly replaced still has the seeds of its test item wherever
the replaced words fall on ignored places. Seeds of the benchmark and of the
documents are joined by hash, and every hit is verified along its diagonal: the
overlap is extended in both directions over equal and replaced words, and where
that cuts it short, the longest stretch of the diagonal that is equal enough counts.

Items shorter than ``MIN_WORDS`` must overlap whole, so they have masks of their own
length, one of which avoids the replaced words wherever they are.

A document is one row whose seeds never leave the scan unless a Bloom filter over
the benchmark's seeds lets them through. The filter's size follows the number of
seeds and is bounded by ``filters.MAX_FILTER_BITS``; beyond that it passes more seeds, all
of which the join decides.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .filters import filter_slots, in_filter, seed_filter
from .tokens import ALNUM, Words, grouped, mix, powers, sliced, tidy, unused, words_of

#: Ones are compared, noughts ignored. Together they meet every stretch of 13 to 24
#: words of which 80 % are equal, wherever the replaced words are.
MASKS = ("11101011", "1101001011", "110010100111", "110100010011", "1110111")
#: Words that an overlap must have, or all of a shorter item, and the share of equal ones.
MIN_WORDS = 13
MIN_SHARE = 0.8
#: Extension stops once the score is this far below its best: 1 per equal word, -2 per other.
DROP = 6

SEEDS = "h long, item long, item_at long"
ITEMS = "item long, item_id long, item_words binary"
SEGMENTS = "segment long, key long, doc_id long, at long, words binary, h array<long>, h_at array<long>"
OVERLAPS = (
    "key long, doc_id long, item_id long, doc_start long, doc_end long, item_start long, "
    "n_words long, n_same long, share double"
)


def word_hashes(texts: list[str | None]) -> Words:
    """Case-folded words of letters and digits."""
    return words_of([(t or "").lower().encode() for t in texts], ALNUM)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the words under the mask's ones, for every place where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, int(mask, 2), np.uint64)
    for factor, i in zip(powers(len(mask) + 1)[1:], range(len(mask)), strict=True):
        if mask[i] == "1":
            h += words[i : i + n] * factor
    return mix(h)


def short_masks(n: int) -> tuple[str, ...]:
    """Masks for whole items of ``n < MIN_WORDS`` words: some mask ignores all replaced ones.

    The words are cut into blocks and as many blocks are ignored as words may differ.
    """
    differ = n - math.ceil(MIN_SHARE * n)
    if not differ:
        return ("1" * n,)
    # About six words are compared where the item has that many.
    blocks = 5 if differ > 1 else min(n, math.ceil(n / max(1, n - 6)))
    block = [i * blocks // n for i in range(n)]
    return tuple(
        "".join("0" if b in out else "1" for b in block) for out in combinations(range(blocks), differ)
    )


def masks_of(n: int) -> tuple[str, ...]:
    """The masks that find an item of ``n`` words."""
    return MASKS if n >= MIN_WORDS else short_masks(n)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``ITEMS``: the words of each row of ``benchmark(item_id, text)``; empty ones are left out.

    ``item`` names the row by its id and text, as ids may be NULL or repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = word_hashes(batch.column("text").to_pylist())
            rows = [w.hash[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array(rows, pa.binary())],
                ["item", "item_id", "item_words"],
            )

    source = benchmark.select(
        F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"), "text"
    ).dropDuplicates(["item"])
    return written(source.mapInArrow(run, ITEMS).where("length(item_words) > 0"), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = np.frombuffer(words, np.uint64)
                seeds = [seed_hashes(words, m) for m in masks_of(len(words))]
                h = np.concatenate(seeds).view(np.int64)
                at = np.concatenate([np.arange(len(s)) for s in seeds])
                yield pa.RecordBatch.from_pydict(
                    {"h": h, "item": pa.array([item] * len(h), pa.int64()), "item_at": at}
                )

    return written(items.select("item", "item_words").mapInArrow(run, SEEDS), "seeds")


def candidate_segments(docs: DataFrame, table: np.ndarray, reach: int, masks: tuple[str, ...]) -> DataFrame:
    """``SEGMENTS``: seeds of ``masks`` that pass the filter, with ``reach`` words around them.

    ``key`` names the row by its id and text. Hits whose surroundings touch are one
    segment, so a segment holds each word once.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)
    bits = len(table) * 64
    longest = max((len(m) for m in masks), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches):
            keys, ids = (batch.column(c).to_pylist() for c in ("key", "doc_id"))
            texts = batch.column("text").to_pylist()
            raw = [(t or "").lower().encode() for t in texts]
            for lo, hi in grouped(raw):
                w = words_of(raw[lo:hi], ALNUM)
                places, hashes = [], []
                for mask in masks:
                    h = seed_hashes(w.hash, mask)
                    one, two = filter_slots(h, bits)
                    at = np.flatnonzero(in_filter(known, one))
                    at = at[in_filter(known, two[at])]
                    text = np.searchsorted(w.first, at, side="right") - 1
                    at = at[at + len(mask) <= w.first[text + 1]]
                    places.append(at)
                    hashes.append(h[at])
                if not places:
                    continue
                at, h = np.concatenate(places), np.concatenate(hashes).view(np.int64)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                text = np.searchsorted(w.first, at, side="right") - 1
                new = (np.diff(text) > 0) | (np.diff(at) > 2 * reach + longest)
                edges = np.concatenate(([0], np.flatnonzero(new) + 1, [len(at)]))
                rows = []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = text[a]
                    first = max(w.first[own], at[a] - reach)
                    last = min(w.first[own + 1], at[b - 1] + longest + reach)
                    rows.append(
                        {
                            "segment": uuid.uuid4().int >> 65,
                            "key": keys[lo + own],
                            "doc_id": ids[lo + own],
                            "at": int(first - w.first[own]),
                            "words": w.hash[first:last].tobytes(),
                            "h": h[a:b],
                            "h_at": at[a:b] - first,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _SEGMENTS)

    source = docs.select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return written(source.mapInArrow(tidy(run), SEGMENTS), "segments")


_SEGMENTS = pa.schema(
    [
        ("segment", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
        ("words", pa.binary()), ("h", pa.list_(pa.int64())), ("h_at", pa.list_(pa.int64())),
    ]
)


def extend(same: np.ndarray, at: int) -> tuple[int, int]:
    """The best range around ``at``: +1 per equal word, -2 per other, given up at ``DROP`` below the best."""

    def reach(run: np.ndarray) -> int:
        if not len(run):
            return 0
        score = np.cumsum(np.where(run, 1, -2))
        fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score >= DROP)
        score = score[: fallen[0]] if len(fallen) else score
        return int(score.argmax()) + 1 if len(score) and score.max() > 0 else 0

    return at - reach(same[:at][::-1]), at + reach(same[at:])


def stretch(same: np.ndarray, least: int) -> tuple[int, int] | None:
    """The longest range of ``least`` or more words that is equal enough, without replaced ends if it can."""
    # A range is equal enough if this sum does not fall over it (whole numbers for MIN_SHARE).
    part = Fraction(MIN_SHARE).limit_denominator(100)
    step = np.where(same, part.denominator - part.numerator, -part.numerator)
    total = np.concatenate(([0], np.cumsum(step)))
    # The longest range starts where the sum is lower than ever before.
    starts = np.flatnonzero(total < np.concatenate(([total[0] + 1], np.minimum.accumulate(total)[:-1])))
    tail = np.maximum.accumulate(total[::-1])[::-1]  # not increasing
    ends = len(total) - 1 - np.searchsorted(tail[::-1], total[starts])
    best = int((ends - starts).argmax())
    a, b = int(starts[best]), int(ends[best])
    if b - a < least:
        return None
    while b - a > least and not same[b - 1]:
        b -= 1
    while b - a > least and not same[a]:
        a += 1
    return a, b


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps along the diagonals of the hits, that are long and equal enough.

    ``extend`` gives the range, unless that is too short or unequal: then the whole
    diagonal is judged.
    """
    names = [f.split()[0] for f in OVERLAPS.split(", ")]
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key, doc, item, at, words, other, hit, diagonal = row
            w, o = np.frombuffer(words, np.uint64), np.frombuffer(other, np.uint64)
            lo, hi = max(0, diagonal), min(len(w), diagonal + len(o))
            same = w[lo:hi] == o[lo - diagonal : hi - diagonal]
            least = min(MIN_WORDS, len(o))
            a, b = extend(same, hit - lo)
            n, equal = b - a, int(same[a:b].sum())
            if n < least or equal < MIN_SHARE * n:
                enough = same.sum() >= MIN_SHARE * least
                a, b = (stretch(same, least) if enough else None) or (0, 0)
                n, equal = b - a, int(same[a:b].sum())
            if n:
                values = (key, doc, item, at + lo + a, at + lo + b, lo + a - diagonal, n, equal, equal / n)
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(
            out, pa.schema([(n, pa.float64() if n == "share" else pa.int64()) for n in names])
        )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``OVERLAPS``: one row per row of ``docs(doc_id, text)`` and item that it contains.

    The longest overlap of each is kept. Items of less than ``MIN_WORDS`` words are
    found whole, down to one word; NULL and empty texts overlap nothing. ``key`` tells
    rows of equal ``doc_id`` apart by their text; rows equal in both are one here.
    """
    items = benchmark_items(benchmark)
    seeds = item_seeds(items)
    n = (F.length("item_words") / 8).cast("int")
    reach, lengths = items.agg(F.max(n), F.collect_set(F.least(n, F.lit(MIN_WORDS)))).first()
    masks = tuple(dict.fromkeys(m for k in sorted(lengths) for m in masks_of(k)))
    segments = candidate_segments(docs, seed_filter(seeds), reach or 0, masks)
    # Hits on one diagonal of a segment are verified once, from the first of them. They are
    # few and narrow; as a table of known size they need no shuffle of the words behind.
    hits = written(
        segments.select("segment", F.inline(F.arrays_zip("h", "h_at")))
        .join(seeds, "h")
        .groupBy("segment", "item", (F.col("h_at") - F.col("item_at")).alias("diagonal"))
        .agg(F.array_sort(F.collect_set("h_at")).alias("places")),
        "seed-hits",
    )
    # A long diagonal may hold several overlaps: one start per run of hits.
    starts = F.filter(
        F.col("places"),
        lambda x, i: (i == 0) | (x - F.col("places")[F.greatest(i - 1, F.lit(0))] > 2),
    )
    pairs = (
        hits.select("segment", "item", "diagonal", F.explode(starts).alias("hit"))
        .join(segments.select("segment", "key", "doc_id", "at", "words"), "segment")
        .join(items, "item")
        .select("key", "doc_id", "item_id", "at", "words", "item_words", "hit", "diagonal")
    )
    found = pairs.mapInArrow(verify, OVERLAPS)
    rest = [f.split()[0] for f in OVERLAPS.split(", ")][3:]
    best = F.max(
        F.struct("n_same", (-F.col("doc_start")).alias("_near"), (-F.col("item_start")).alias("_item"), *[c for c in rest if c != "n_same"])
    )
    return (
        found.groupBy("key", "doc_id", "item_id")
        .agg(best.alias("o"))
        .select("key", "doc_id", "item_id", *[f"o.{c}" for c in rest])
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that overlap an item, all columns as they are.

    A row goes if it has both the id and the hash of a row that was found.
    """
    key = unused("key", docs.columns)
    found = overlaps(docs, benchmark).select(F.col("key").alias("leak"), F.col("doc_id").alias("leak_id"))
    found = written(found.distinct(), "leaks")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    same = (keyed[key] == found["leak"]) & keyed["doc_id"].cast("long").eqNullSafe(found["leak_id"])
    return keyed.join(found, same, "left_anti").drop(key)
