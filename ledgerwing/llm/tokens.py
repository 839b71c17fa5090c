"""Words of many texts at once, as 64-bit hashes, with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at a time, in arrays of eight bytes for each; longer texts are cut between words.
CHUNK_BYTES = 1 << 18
#: Bytes of texts that a batch function has as Python objects at a time.
SLICE_BYTES = 1 << 22
BASE = 0x9E3779B97F4A7C15

#: Bytes of words: everything but ASCII white space.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words without punctuation: ASCII letters and digits, and all of other scripts.
ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def release() -> None:
    """Give freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A batch function that gives freed memory back to the system when its task ends.

    Python workers stay for later tasks; without this each keeps its largest heap.
    """

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def sliced(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in slices of at most ``limit`` bytes of ``text``, or one longer row.

    A batch has thousands of whole texts; as Python objects they take several times its
    memory, in every worker. Slices are views of their batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        at = done = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def unused(name: str, columns: Iterable[str]) -> str:
    """A column name that no column has, whatever its case: the given one or a longer one."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 4096), BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p)
    return _POWERS[:n]


class Words(NamedTuple):
    """Words of several texts; text ``i`` has words ``first[i]`` up to ``first[i + 1]``.

    ``start`` and ``end`` are byte positions within the word's text.
    """

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _hashed(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.concatenate(([False], word[buf], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    value = buf[inside[1:-1]].astype(np.uint64) + np.uint64(1)
    value *= powers(int(sizes.max()))[place]
    h = np.add.reduceat(value, first)
    h += sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h), starts, ends


def _cuts(buf: np.ndarray, word: np.ndarray) -> list[int]:
    """Ends of chunks, each after a byte that is in no word; a longer word stays whole."""
    cuts, at = [], 0
    while len(buf) - at > CHUNK_BYTES:
        size = CHUNK_BYTES
        while True:
            gaps = np.flatnonzero(~word[buf[at : at + size]])
            if len(gaps) or at + size >= len(buf):
                break
            size *= 2
        if not len(gaps):
            break
        at += int(gaps[-1]) + 1
        cuts.append(at)
    return [*cuts, len(buf)]


def words_of(texts: list[bytes], word: np.ndarray) -> Words:
    """Words of all texts; the separator between texts must not be a word byte (a line feed)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    buf = np.frombuffer(b"".join([t + b"\n" for t in texts]), np.uint8)
    parts, at = [], 0
    for cut in _cuts(buf, word):
        h, s, e = _hashed(buf[at:cut], word)
        parts.append((h, s + at, e + at))
        at = cut
    h, s, e = (np.concatenate(p) for p in zip(*parts, strict=True))
    first = np.searchsorted(s, offsets)
    base = np.repeat(offsets[:-1], np.diff(first))
    return Words(h, s - base, e - base, first)


def grouped(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes together, at least one each."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
