"""Hard negatives by exact integer scores: matrix products modulo small primes.

Scores are inner products of whole numbers. For each of a few primes the components
are reduced to small signed residues, whose products and sums a float32 matrix
product holds exactly; the residues of a score then give the score itself by the
Chinese remainder theorem (in Garner's mixed radix form).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .tokens import tidy
from .warc import store_of

#: Anchors that are scored at a time, rows of one matrix, rows whose best are kept together.
ANCHOR_BLOCK, ROW_BLOCK, SLAB_ROWS = 256, 8192, 1 << 16
#: Primes stay below this, so that 1,000 products of residues sum exactly in float32.
PRIME_LIMIT = 256
#: 100 times a score must fit 64 bits.
LARGEST_SCORE = 1 << 56
NONE = np.iinfo(np.int64).min


def primes(bound: int) -> list[int]:
    """The largest primes under ``PRIME_LIMIT`` whose product tells signed numbers up to ``bound`` apart."""
    found, product = [], 1
    for p in range(PRIME_LIMIT - 1, 1, -1):
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
            if product > 2 * bound + 1:
                return found
    raise ValueError("scores are too large for the primes")


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo ``p``, the representative nearest zero, as float32."""
    r = x % p
    r[r > p // 2] -= p
    return r.astype(np.float32)


def modular_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, in 0 to p - 1; sums over few enough columns to be exact in float32."""
    width = (1 << 24) // max(1, (p // 2) ** 2)
    total = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], width):
        total += (a[:, at : at + width] @ b[:, at : at + width].T).astype(np.int32)
        total %= p
    return total


def from_residues(parts: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The signed numbers nearest zero with these residues, by mixed radix digits."""
    value, radix, digits = parts[0].astype(np.int64), 1, [parts[0]]
    for i in range(1, len(moduli)):
        p, rest = moduli[i], parts[i].astype(np.int32)
        for digit, q in zip(digits, moduli, strict=False):
            rest = (rest - digit) * pow(q, -1, p) % p
        digits.append(rest)
        radix *= moduli[i - 1]
        value += rest.astype(np.int64) * radix
    product = radix * moduli[-1]
    value[value > product // 2] -= product
    return value


def scores(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``, given as residues; a shorter row ends in zeros."""
    d = min(a[0].shape[1], b[0].shape[1])
    parts = [modular_product(x[:, :d], y[:, :d], p) for x, y, p in zip(a, b, moduli, strict=True)]
    return from_residues(parts, moduli)


def best(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest of each row and their columns, first columns first; changes ``s``."""
    rows = np.arange(len(s))
    at, high = np.empty((len(s), k), np.int64), np.empty((len(s), k), np.int64)
    for j in range(k):
        at[:, j] = s.argmax(axis=1) if s.shape[1] else 0
        high[:, j] = s[rows, at[:, j]] if s.shape[1] else NONE
        if s.shape[1]:
            s[rows, at[:, j]] = NONE
    return at, high


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) * width == len(flat):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Slab(NamedTuple):
    """Rows of a task in the order that breaks ties, with residues by block of rows."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    blocks: list[tuple[int, list[np.ndarray]]]


def _slabs(batches: Iterator[pa.RecordBatch], moduli: list[int]) -> Iterator[Slab]:
    def made(held: list[pa.RecordBatch]) -> Slab:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        row, ident, label = (t[c].to_numpy() for c in ("row", "vec_id", "label"))
        order = np.lexsort((row, ident))
        x = matrix(t["q"])[order]
        blocks = [
            (i, [residues(x[i : i + ROW_BLOCK], p) for p in moduli]) for i in range(0, len(x), ROW_BLOCK)
        ]
        return Slab(row[order], ident[order], label[order], blocks)

    held, size = [], 0
    for batch in batches:
        for at in range(0, len(batch), SLAB_ROWS):
            part = batch.slice(at, SLAB_ROWS)
            if held and size + len(part) > SLAB_ROWS:
                yield made(held)
                held, size = [], 0
            held.append(part)
            size += len(part)
    if size:
        yield made(held)


def _anchor_blocks(path: str) -> Iterator[dict[str, pa.Array]]:
    """The anchors of a written table, a block at a time."""
    files, where = store_of(path)
    table = ds.dataset(where, filesystem=files, format="parquet")
    for batch in table.to_batches(batch_size=ANCHOR_BLOCK, use_threads=False):
        if len(batch):
            yield dict(zip(batch.schema.names, batch.columns, strict=True))


POSITIVES = "anchor_row long, anchor_id long, row long, vec_id long, score long"
NEGATIVES = (
    "anchor_row long, anchor_id long, nth int, positive_id long, positive_score long, "
    "row long, vec_id long, score long"
)


def _positives(path: str, moduli: list[int], k: int):
    """Of each slab and anchor, the ``k`` best other rows of the anchor's label."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, moduli):
            for block in _anchor_blocks(path):
                own, label = block["row"].to_numpy(), block["label"].to_numpy()
                x = matrix(block["q"])
                a = [residues(x, p) for p in moduli]
                kept = []
                for at, b in slab.blocks:
                    s, here = scores(a, b, moduli), slice(at, at + ROW_BLOCK)
                    s[(label[:, None] != slab.label[here]) | (own[:, None] == slab.row[here])] = NONE
                    col, high = best(s, k)
                    kept.append((col + at, high))
                # Earlier blocks come first, so that ties go to the earlier row.
                col, high = (np.concatenate(z, axis=1) for z in zip(*kept, strict=True))
                at, high = best(high, k)
                col = np.take_along_axis(col, at, axis=1)
                i, j = np.nonzero(high != NONE)
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor_row": own[i],
                        "anchor_id": block["vec_id"].to_numpy()[i],
                        "row": slab.row[col[i, j]],
                        "vec_id": slab.id[col[i, j]],
                        "score": high[i, j],
                    }
                )

    return run


def _negatives(path: str, moduli: list[int], k: int):
    """Of each slab, anchor and positive, the ``k`` best rows of other labels within the positive's window."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches, moduli):
            for block in _anchor_blocks(path):
                label = block["label"].to_numpy()
                x = matrix(block["q"])
                a = [residues(x, p) for p in moduli]
                pos = matrix(block["positive_scores"])
                n_pos = np.diff(block["positive_scores"].offsets.to_numpy())
                kept: list[list] = [[] for _ in range(pos.shape[1])]
                for at, b in slab.blocks:
                    s, here = scores(a, b, moduli), slice(at, at + ROW_BLOCK)
                    other = label[:, None] != slab.label[here]
                    for nth, found in enumerate(kept):
                        p = pos[:, nth, None]
                        inside = other & (s >= -(-p // 2)) & (s <= 95 * p // 100)
                        col, high = best(np.where(inside & (nth < n_pos[:, None]), s, NONE), k)
                        found.append((col + at, high))
                for nth, found in enumerate(kept):
                    col, high = (np.concatenate(z, axis=1) for z in zip(*found, strict=True))
                    at, high = best(high, k)
                    col = np.take_along_axis(col, at, axis=1)
                    i, j = np.nonzero(high != NONE)
                    ids = matrix(block["positive_ids"])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "anchor_row": block["row"].to_numpy()[i],
                            "anchor_id": block["vec_id"].to_numpy()[i],
                            "nth": np.full(len(i), nth, np.int32),
                            "positive_id": ids[i, nth],
                            "positive_score": pos[i, nth],
                            "row": slab.row[col[i, j]],
                            "vec_id": slab.id[col[i, j]],
                            "score": high[i, j],
                        }
                    )

    return run


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``row``, ``vec_id``, ``label``, ``q``: the rows that take part, components scaled and floored.

    Left out: rows with a NULL id, label or vector and rows with a NULL or non-finite component.
    """
    sound = F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    # Beyond 2^62 the scores could not be told anyway; the bound below refuses them.
    whole = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))),
    )
    return vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(
        sound
    ).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole.alias("q"),
    )


def hard_negatives(rows: DataFrame, n_positives: int = 5, n_negatives: int = 3, every: int = 50) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has ``row`` (unique), ``vec_id``, ``label`` and ``q`` as of
    :func:`whole_numbers`; anchors are the rows whose ``vec_id`` is divisible by ``every``.
    An anchor's positives are the ``n_positives`` other rows of its label with the highest
    score; each gets the ``n_negatives`` rows of other labels that score highest between 50
    and 95 percent of the positive. Ties go to the smaller ``vec_id``. Rows that repeat
    an id are rows of their own. Shorter vectors count as filled up with zeros; scores
    that could pass 2^56 raise ``ValueError``. No rows, no anchors, no positives or an
    empty window give no rows.

    The rows lie still in their partitions: anchors are read from the shared folder
    block by block, and only the few best of each slab of rows are shuffled.
    """
    spark = rows.sparkSession

    def put(df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    base, _ = put(rows.select("row", "vec_id", "label", "q"), "whole-numbers")
    anchors, anchor_path = put(base.where(F.col("vec_id") % every == 0), "anchors")
    squares = F.aggregate("q", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    largest = base.agg(F.max(squares)).first()[0] or 0.0
    bound = int(largest * 1.001) + 1
    if bound >= LARGEST_SCORE:
        raise ValueError(f"scores may reach {largest:.3g}; 100 times that passes 64 bits")
    moduli = primes(bound)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if anchors.isEmpty():
        return spark.createDataFrame([], out)
    found = base.mapInArrow(_positives(anchor_path, moduli, n_positives), POSITIVES)
    first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row")
    positives = (
        found.withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= n_positives)
        .groupBy(F.col("anchor_row").alias("row"))
        .agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("p"))
        .select(
            "row", F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")
        )
    )
    paired, paired_path = put(anchors.join(positives, "row"), "anchors-with-positives")
    if paired.isEmpty():
        return spark.createDataFrame([], out)
    near = base.mapInArrow(_negatives(paired_path, moduli, n_negatives), NEGATIVES)
    order = Window.partitionBy("anchor_row", "nth").orderBy(F.desc("score"), "vec_id", "row")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n_negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
