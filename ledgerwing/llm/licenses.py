"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

A document's word shingles are cut into blocks that double in size; two
neighbouring blocks are a window, so any passage up to a block's length lies in
some window of its size class. A template is looked for with windows of at most
four times its length. If such a window holds a share s of the template, their
Jaccard similarity is at least s / (5 - s), and with ``BANDS`` bands of one MinHash
each the chance that no band collides is at most ``(1 - s / (5 - s)) ** BANDS``,
2e-6 at the smallest share. Colliding windows are verified by the exact share of
the template's shingles that they contain.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .tokens import ALNUM, grouped, mix, powers, words_of

SHINGLE = 5
MIN_SHARE = 0.8
BANDS = 64
#: Shingles in the smallest block.
BLOCK = 2
#: Templates travel with the tasks; more words than this in all of them are an error.
MAX_TEMPLATE_WORDS = 1_000_000

#: Wordings of notices and grants, by licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "ISC-grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
)


class Shingles(NamedTuple):
    """Hashes of the shingles of several texts; text ``i`` has ``first[i]`` to ``first[i + 1]``."""

    hash: np.ndarray
    first: np.ndarray
    words: np.ndarray  # words per text


def shingles_of(texts: list[bytes]) -> Shingles:
    """Shingles of case-folded words of letters and digits; a shorter text is one shingle as a whole."""
    w = words_of(texts, ALNUM)
    sizes = np.diff(w.first)
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    factors = powers(SHINGLE + 1)[1:]
    padded = np.concatenate((w.hash, np.zeros(SHINGLE, np.uint64)))
    run = np.zeros(len(w.hash), np.uint64)
    for i in range(SHINGLE):
        run += padded[i : i + len(run)] * factors[i]
    for t in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
        own = w.hash[w.first[t] : w.first[t + 1]]
        run[w.first[t]] = (own * factors[: len(own)]).sum(dtype=np.uint64)
    place = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(w.first[:-1], n)
    return Shingles(mix(run[place]), first, sizes)


def _band_hash(h: np.ndarray, k: int) -> np.ndarray:
    seed = powers(BANDS + 2)[k + 1] | np.uint64(1)
    return (h ^ (h >> np.uint64(29))) * seed


class Templates(NamedTuple):
    names: tuple[str, ...]
    shingles: tuple[np.ndarray, ...]  # sorted and distinct
    blocks: tuple[int, ...]  # block length of the size class

    def bands(self) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """Per block length and band the sorted MinHashes and the templates that have them."""
        rows: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for t, (own, block) in enumerate(zip(self.shingles, self.blocks, strict=True)):
            for k in range(BANDS):
                rows.setdefault((block, k), []).append((int(_band_hash(own, k).min()), t))
        return {
            key: (np.array([v for v, _ in sorted(r)], np.uint64), np.array([t for _, t in sorted(r)]))
            for key, r in rows.items()
        }


def load_templates(templates: DataFrame) -> Templates:
    """Templates of ``templates(license, text)``, of a checked total size.

    Rows without a name or a word are left out; a name may have several wordings.
    """
    names, shingles, blocks, words = [], [], [], 0
    for row in templates.where("license IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        s = shingles_of([row["text"].lower().encode()])
        words += int(s.words[0])
        if words > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
        own = np.unique(s.hash)
        if len(own):
            block = BLOCK
            while block < len(s.hash):
                block *= 2
            names.append(row["license"])
            shingles.append(own)
            blocks.append(block)
    order = sorted(range(len(names)), key=lambda i: (names[i], shingles[i].tolist()))
    return Templates(
        tuple(names[i] for i in order), tuple(shingles[i] for i in order), tuple(blocks[i] for i in order)
    )


def _doc_blocks(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks aligned to each text's start, and the first block of each text."""
    n = -(-sizes // block)
    first = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], n)
    starts = np.repeat(np.cumsum(sizes) - sizes, n) + place * block
    return starts, first


def candidate_windows(s: Shingles, bands: dict) -> set[tuple[int, int, int]]:
    """``(text, template, block number)`` of windows that collide in some band."""
    sizes = np.diff(s.first)
    found: set[tuple[int, int, int]] = set()
    if not len(s.hash):
        return found
    base_starts, base_first = _doc_blocks(sizes, BLOCK)
    base_sizes = np.diff(base_first)
    classes = {
        block: _doc_blocks(base_sizes, block // BLOCK) for block in {b for b, _ in bands}
    }
    for k in range(BANDS):
        low = np.minimum.reduceat(_band_hash(s.hash, k), base_starts)
        for block, (starts, first) in classes.items():
            values, owners = bands[block, k]
            blocks = np.minimum.reduceat(low, starts)
            windows = blocks.copy()
            np.minimum(blocks[:-1], blocks[1:], out=windows[:-1])
            last = first[1:][np.diff(first) > 0] - 1
            windows[last] = blocks[last]
            place = np.searchsorted(values, windows)
            hit = np.flatnonzero(values[np.minimum(place, len(values) - 1)] == windows)
            for w in hit:
                text = int(np.searchsorted(first, w, side="right")) - 1
                for t in owners[values == windows[w]]:
                    found.add((text, int(t), int(w - first[text])))
    return found


def occurrences(own: np.ndarray, template: np.ndarray, block: int) -> list[tuple[int, int, float]]:
    """``(first shingle, last shingle, share)`` of the places that hold enough of the template.

    Matching shingles further apart than a block are different places.
    """
    at = np.flatnonzero(np.isin(own, template))
    if not len(at):
        return []
    edges = np.concatenate(([0], np.flatnonzero(np.diff(at) > block) + 1, [len(at)]))
    found = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        share = len(np.unique(own[at[a:b]])) / len(template)
        if share >= MIN_SHARE:
            found.append((int(at[a]), int(at[b - 1]), share))
    return found


def scan_texts(texts: list[bytes], templates: Templates, bands: dict) -> list[tuple]:
    """``(text, license, word_start, word_end, share)`` rows in order."""
    s = shingles_of(texts)
    regions: dict[tuple[int, int], list[int]] = {}
    for text, t, window in candidate_windows(s, bands):
        regions.setdefault((text, t), []).append(window)
    rows = set()
    for (text, t), windows in regions.items():
        own = s.hash[s.first[text] : s.first[text + 1]]
        block = templates.blocks[t]
        done = -1
        for w in sorted(windows):
            lo, hi = max(done, (w - 1) * block, 0), min(len(own), (w + 3) * block)
            if hi <= lo:
                continue
            # grow until no matching shingle stands near the region's ends
            while True:
                at = np.flatnonzero(np.isin(own[lo:hi], templates.shingles[t]))
                grow_lo = lo > 0 and len(at) and at[0] <= block
                grow_hi = hi < len(own) and len(at) and hi - lo - at[-1] <= block + 1
                if not (grow_lo or grow_hi):
                    break
                lo, hi = max(0, lo - 2 * block * bool(grow_lo)), min(len(own), hi + 2 * block * bool(grow_hi))
            for a, b, share in occurrences(own[lo:hi], templates.shingles[t], block):
                end = min(lo + b + SHINGLE, int(s.words[text]))
                rows.add((text, templates.names[t], lo + a, end, share))
            done = hi
    return sorted(rows)


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``(doc_id, license, word_start, word_end, share)``: each place that holds a template.

    ``templates(license, text)`` defaults to :data:`TEMPLATES`. Positions count words
    of letters and digits. One scan without a shuffle; NULL and empty texts hold
    nothing, repeated rows come out repeated, NULL ``doc_id`` stays.
    """
    spark = docs.sparkSession
    known = load_templates(templates if templates is not None else default_templates(spark))
    source = docs.select("doc_id", "text")
    schema = StructType(
        [
            source.schema["doc_id"],
            StructField("license", StringType()),
            StructField("word_start", LongType()),
            StructField("word_end", LongType()),
            StructField("share", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = known.bands()
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            out: list[list] = [[], [], [], [], []]
            for lo, hi in grouped(texts) if known.names else ():
                for text, *row in scan_texts(texts[lo:hi], known, bands):
                    for column, value in zip(out, (lo + text, *row), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(out[0], pa.int64())),
                    pa.array(out[1], pa.string()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.int64()),
                    pa.array(out[4], pa.float64()),
                ],
                schema.names,
            )

    return source.mapInArrow(run, schema)


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")
