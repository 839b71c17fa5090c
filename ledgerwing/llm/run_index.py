"""Repeated byte strings by a run-length index.

The contexts of a reference block form one text with an end mark after each. Its
Burrows-Wheeler transform is kept as runs; the step to the preceding symbol of a
row needs the row's run alone, and text positions are sampled at run ends. All
contexts are streamed against the index from their ends to their starts in
lockstep. Rows whose suffixes agree in a whole window are neighbours; they are
kept as intervals with the least document among them, and a window is marked if
the interval that the stream is in has an earlier document.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Kind, remove_repeats

WINDOW_BYTES = 50
SEED_BYTES = 32
#: Symbols of nine bits that one 64-bit key holds; a window has as many at least.
FIRST_SYMBOLS = 7


def read_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    return np.frombuffer(b"".join(texts), np.uint8), first


class Marks(NamedTuple):
    """Marked rows as bits, with the number of marks before each word of 64."""

    bits: np.ndarray
    before: np.ndarray

    @staticmethod
    def at(rows: np.ndarray, n: int) -> Marks:
        flags = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
        flags[rows] = 1
        bits = np.packbits(flags, bitorder="little").view("<u8")
        counts = np.bitwise_count(bits).astype(np.int64)
        return Marks(bits, np.cumsum(counts) - counts)

    def rank(self, rows: np.ndarray) -> np.ndarray:
        """Marks at or before each row."""
        word = rows >> 6
        upto = np.uint64(2**64 - 1) >> (63 - (rows & 63)).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.bits[word] & upto)


class RunIndex(NamedTuple):
    run_start: np.ndarray  # first row of each run
    starts: Marks  # the same as bits
    step: np.ndarray  # row of the preceding symbol less the own row, by run
    sample: np.ndarray  # text position of each run's last row
    intervals: Marks  # first row of each interval of two rows and more
    interval_end: np.ndarray
    least: np.ndarray  # least document of each interval
    end_rows: np.ndarray  # row of each context's end mark
    rows: int

    def previous(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one symbol longer."""
        return rows + self.step[self.starts.rank(rows) - 1]

    def locate(self, row: int) -> int:
        """Text position of a row: steps to a sampled run end, counted."""
        steps = 0
        while True:
            run = int(np.searchsorted(self.run_start, row, side="right")) - 1
            end = self.run_start[run + 1] - 1 if run + 1 < len(self.run_start) else self.rows - 1
            if row == end:
                return int(self.sample[run]) + steps
            row = int(row + self.step[run])
            steps += 1


def suffix_order(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions by row, rows by position, and whether a row agrees with the one before in ``length`` symbols.

    ``text`` holds symbols below 512. By prefix doubling, starting with seven
    symbols; a rank is the first row of its group, and only groups of several rows
    are sorted again.
    """
    n, depth = len(text), FIRST_SYMBOLS
    if length < depth:
        raise ValueError(f"windows of fewer than {depth} symbols")
    padded = np.concatenate((text.astype(np.uint64), np.zeros(depth, np.uint64)))
    key = np.zeros(n, np.uint64)
    for i in range(depth):
        key = (key << np.uint64(9)) | padded[i : i + n]
    # What hangs over the end counts as less than any symbol and differs by its length.
    rank = np.zeros(n, np.uint64)
    order = np.empty(n, np.int64)
    rows, place = np.arange(n), np.arange(n)  # the rows that are not settled, and what stands there
    alike: list[np.ndarray] = []
    while True:
        by = np.argsort(key)
        place, key = place[by], key[by]
        order[rows] = place
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        rank[place] = np.maximum.accumulate(np.where(new[:-1], rows, 0)).astype(np.uint64)
        if depth <= length < 2 * depth:
            # two prefixes of this depth cover a window
            shift = length - depth
            alike = [rank.copy(), np.concatenate((rank[shift:], np.zeros(shift, np.uint64)))]
        open_ = ~(new[:-1] & new[1:])
        rows, place = rows[open_], place[open_]
        if not len(rows) and (alike or depth > length):
            break
        after = place + depth
        inside = after < n
        key = rank[place] << np.uint64(32)
        key[inside] |= rank[after[inside]] + np.uint64(1)
        depth *= 2
    same = np.zeros(n, bool)
    same[1:] = True
    for part in alike:
        ordered = part[order]
        same[1:] &= ordered[1:] == ordered[:-1]
    return order, rank.astype(np.int64), same


def build(text: np.ndarray, first: np.ndarray, docs: np.ndarray, length: int) -> RunIndex:
    """Index of the contexts ``text[first[i]:first[i + 1]]`` of documents ``docs[i]``.

    An end mark is the least symbol; a window never holds one.
    """
    n_pieces = len(docs)
    sizes = np.diff(first)
    marks = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(text) + n_pieces, bool)
    inside[marks] = False
    symbols = np.ones(len(inside), np.int64)
    symbols[inside] = text.astype(np.int64) + 2
    piece = np.repeat(np.arange(n_pieces), sizes + 1)
    order, row_of, same = suffix_order(symbols, length)
    # Transform: the symbol before each row. A row after an end mark starts a context;
    # nothing steps over it, so it is a run of its own with a sampled position.
    before = symbols[order - 1]
    change = before == 1
    change[0] = True
    change[1:] |= before[1:] != before[:-1]
    run_start = np.flatnonzero(change)
    run_size = np.diff(np.append(run_start, len(before)))
    head = before[run_start]
    # Rows that start with a symbol follow those of smaller ones, in the order of the runs.
    by_symbol = np.argsort(head, kind="stable")
    target = np.empty(len(head), np.int64)
    target[by_symbol] = np.cumsum(run_size[by_symbol]) - run_size[by_symbol]
    interval = np.flatnonzero(np.append(~same[:-1] & same[1:], False)) if len(same) else np.empty(0, int)
    stop = np.flatnonzero(np.append(same[:-1] & ~same[1:], same[-1:])) + 1
    owner = docs[piece[order]]
    if len(interval):
        edges = np.stack((interval, stop), axis=1).ravel()
        least = np.minimum.reduceat(np.append(owner, owner[-1]), edges)[::2]
    else:
        least = np.empty(0, np.int64)
    return RunIndex(
        run_start,
        Marks.at(run_start, len(order)),
        target - run_start,
        order[run_start + run_size - 1],
        Marks.at(interval, len(order)),
        stop,
        least,
        row_of[marks],
        len(order),
    )


def mark(text: np.ndarray, first: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Windows of each context that also start in an earlier document, context after context."""
    sizes = np.diff(first)
    counts = sizes - length + 1
    marks = np.zeros(counts.sum(), bool)
    if not len(docs):
        return marks
    index = build(text, first, docs, length)
    at = np.cumsum(counts) - counts
    longest_first = np.argsort(-sizes, kind="stable")
    ordered = -sizes[longest_first]
    rows = index.end_rows[longest_first]
    for t in range(1, int(sizes.max()) + 1):
        live = int(np.searchsorted(ordered, -t, side="right"))
        rows = index.previous(rows[:live])
        if t < length or not len(index.least):
            continue
        k = index.intervals.rank(rows) - 1
        hit = (k >= 0) & (rows < index.interval_end[np.maximum(k, 0)])
        own = longest_first[:live]
        hit &= index.least[np.maximum(k, 0)] < docs[own]
        marks[(at[own] + sizes[own] - t)[hit]] = True
    return marks


def keep_bytes(text: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text


def remove_strings(docs: DataFrame, window: int = WINDOW_BYTES, seed: int = SEED_BYTES) -> DataFrame:
    """Bytes left of each row of ``docs(doc_id, text)``; see :func:`repeats.remove_repeats`."""
    return remove_repeats(docs, Kind(read_bytes, "u1", window, seed), mark, keep_bytes)
