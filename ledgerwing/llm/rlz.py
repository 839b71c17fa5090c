"""Duplicate passages of words by relative Lempel-Ziv parsing.

The passages of a reference block are taken in the order of their documents. Each
is parsed greedily against those before it: an index of the block's windows gives
the first source of the next factor, which is extended word by word for as long
as the source goes on alike. Factors of at least a window become duplicate spans.
A long repeat may continue in another source, so parsing goes on with the windows
that lie across the factor's end, not only behind it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Kind, remove_repeats
from .tokens import NOT_BLANK, mix, powers, words_of

WINDOW_WORDS = 50
SEED_WORDS = 25


def read_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    w = words_of(texts, NOT_BLANK)
    return w.hash, w.first


def window_hashes(text: np.ndarray, length: int) -> np.ndarray:
    n = max(0, len(text) - length + 1)
    h = np.zeros(n, np.uint64)
    for i, factor in zip(range(length), powers(length + 1)[1:], strict=True):
        h += text[i : i + n] * factor
    return mix(h)


def factors(text: np.ndarray, first: np.ndarray, docs: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """``(start, size, source)`` of all factors of at least ``length``, as places in ``text``.

    Passage ``i`` is ``text[first[i]:first[i + 1]]``; passages come in the order of
    their documents and have no source in their own document.
    """
    hashes = window_hashes(text, length).tolist()
    words, ends, owner = text.tolist(), first[1:].tolist(), docs.tolist()
    index: dict[int, tuple[int, int, int]] = {}  # first place, its passage's end, its document
    found = []
    for p, (start, end) in enumerate(zip(first[:-1].tolist(), ends, strict=True)):
        at, doc, last = start, owner[p], end - length
        while at <= last:
            source, source_end, source_doc = index.get(hashes[at], (-1, -1, doc))
            if source_doc >= doc or words[source : source + length] != words[at : at + length]:
                at += 1
                continue
            size, most = length, min(end - at, source_end - source)
            while size < most and words[at + size] == words[source + size]:
                size += 1
            found.append((at, size, source))
            at += size - length + 1
        for at in range(start, last + 1):
            index.setdefault(hashes[at], (at, end, doc))
    return found


def mark(text: np.ndarray, first: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Windows of each passage that lie in a factor, passage after passage."""
    counts = np.diff(first) - length + 1
    skipped = np.arange(len(counts)) * (length - 1)  # places that start no window
    edges = np.zeros(counts.sum() + 1, np.int64)
    if len(counts):
        found = np.array(factors(text, first, docs, length), np.int64).reshape(-1, 3)
        passage = np.searchsorted(first, found[:, 0], side="right") - 1
        start = found[:, 0] - skipped[passage]
        np.add.at(edges, start, 1)
        np.add.at(edges, start + found[:, 1] - length + 1, -1)
    return np.cumsum(edges)[:-1] > 0


def keep_words(text: bytes, gone: np.ndarray) -> bytes:
    words = text.split()
    if gone.any():
        words = [w for w, out in zip(words, gone.tolist(), strict=True) if not out]
    return b" ".join(words)


def remove_passages(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """Words left of each row of ``docs(doc_id, text)``; see :func:`repeats.remove_repeats`.

    Words are runs without ASCII white space, unchanged; spans count words and the
    kept words are joined by one blank.
    """
    return remove_repeats(docs, Kind(read_words, "<u8", window, seed), mark, keep_words)
