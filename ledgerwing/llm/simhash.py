"""SimHash fingerprints and their near neighbours by multi-index hashing.

A fingerprint is cut into segments, and one table per segment maps segment
values to fingerprints. If two fingerprints differ in at most ``radius`` bits,
the pigeonhole principle gives a segment in which they differ by no more than
that segment's share of the radius, so enumerating that small Hamming ball
around each segment value and fetching the table's matches finds every pair;
the complete distance is verified on each match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import drop_written, scratch_dir, written
from .components import components
from .tokens import sliced, tidy, unused
from .warc import store_of

BITS = 64
SEED = 42
#: Ball members that one task enumerates, on average.
BALLS_PER_TASK = 1 << 19
#: Shingles whose bits are counted at a time.
COUNT_ROWS = 1 << 15


def shingle_digests(text: bytes, shingle: int) -> bytes:
    """The XXH64 digests (big-endian) of all word shingles, one after the other."""
    words = text.lower().split()
    if not words:
        return b""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    return b"".join(
        [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    )


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Bits that are set in over half of the shingles' hashes, as a signed 64-bit integer."""
    rows = np.frombuffer(shingle_digests(text or b"", shingle), np.uint8).reshape(-1, BITS // 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), COUNT_ROWS):
        counts += np.unpackbits(rows[at : at + COUNT_ROWS], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` and the columns of ``keep`` for every row of ``docs(doc_id, text)``.

    Only ASCII letters are folded; words are runs without ASCII white space. Texts
    with fewer words than a shingle hash as a whole; NULL and word-free texts get 0.
    """
    cols = ("doc_id", *keep)
    source = docs.select(*cols, F.col("text").cast("binary").alias("_text"))
    schema = StructType([*(source.schema[c] for c in cols), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in cols), pa.array(fps, pa.int64())], [*cols, "fp"]
            )

    return source.mapInArrow(tidy(run), schema)


def segment_shares(radius: int, segments: int) -> list[int]:
    """Ball radius per segment; -1 where a segment needs no table.

    The shares plus one each must exceed the radius: were every segment further
    off than its share, the whole distance would be above the radius.
    """
    spare = radius + 1 - segments
    if spare < 0:
        return [0] * (radius + 1) + [-1] * -spare
    return [spare // segments + (i < spare % segments) for i in range(segments)]


def _segment(fp: Column, k: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit((1 << width) - 1))


def _ball(k: int, value: Column, flips: list[int]) -> Column:
    masks = F.array(*[F.lit(x).cast("long") for x in flips])
    return F.transform(
        masks, lambda x: F.struct(F.lit(k).alias("k"), value.bitwiseXOR(x).alias("v"))
    )


def near_links(fps: DataFrame, radius: int = 2, segments: int = 2) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of distinct fingerprints of ``fps(fp)`` within the radius.

    Every pair is found. Equal fingerprints are one row here, so groups of copies
    cost nothing, and a pair is verified inside the join, which only puts out
    links. A segment value that many different fingerprints share is a skewed
    join key, which adaptive execution splits on both sides.
    """
    width = BITS // segments
    own, ball = [], []
    for k, share in enumerate(segment_shares(radius, segments)):
        if share < 0:
            continue
        value = _segment(F.col("fp"), k, width)
        flips = [sum(1 << i for i in c) for n in range(share + 1) for c in combinations(range(width), n)]
        own.append(F.struct(F.lit(k).alias("k"), value.alias("v")))
        ball.append(_ball(k, value, flips))
    nodes = written(fps.select("fp").distinct(), "nodes")
    # The enumerated balls are many times the nodes, so the tasks are counted by them.
    n_balls = nodes.count() * sum(math.comb(width, n) for s in segment_shares(radius, segments) for n in range(s + 1))
    nodes = nodes.repartition(max(1, -(-n_balls // BALLS_PER_TASK)), "fp")
    table = nodes.select(F.col("fp").alias("b"), F.inline(F.array(*own)))
    probes = nodes.select(F.col("fp").alias("a"), F.inline(F.concat(*ball)))
    return (
        probes.join(table, ["k", "v"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select("a", "b")
        .distinct()
    )


def near_groups(fps: DataFrame, radius: int = 2, segments: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``fps(doc_id, fp)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``radius`` differing bits, equal fingerprints included. Rows without a
    ``doc_id`` take part and get their group's id, NULL if the group has none;
    repeated rows come out repeated.
    """
    base = written(fps.select("doc_id", "fp"), "fingerprints")
    first = written(base.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    roots = components(near_links(first, radius, segments))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return base.join(written(named, "groups"), "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, segments: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest ``doc_id``.

    Groups are the components of :func:`near_groups`: rows whose fingerprints differ in
    at most ``radius`` bits, directly or over others; NULL and word-free texts have
    fingerprint zero like any other. Rows without an id come last; among rows of one id the
    text decides, among equal rows any one stays. Columns stay, whatever their names.

    Rows are told apart by a number that is written with them, not by a hash of theirs. Only
    fingerprints and numbers are shuffled.
    """
    columns = docs.columns
    row, fp = unused("row", columns), unused("fp", columns)
    schema = StructType([*docs.schema.fields, StructField(fp, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            fps = pa.array([fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), fps], schema.names)

    numbered = docs.mapInArrow(tidy(run), schema).withColumn(row, F.monotonically_increasing_id())
    numbered = written(numbered, "numbered")
    base = numbered.select(
        F.col("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"), F.xxhash64("text").alias("tie")
    )
    first = written(base.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    roots = components(near_links(first, radius, segments)).withColumnRenamed("node", "fp")
    best = (
        base.join(roots, "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "row")).alias("best"))
    )
    kept = scratch_dir(docs.sparkSession, "kept")
    part = F.shiftright("row", ROWS_BITS).alias("part")
    best.select(F.col("best.row").alias("row")).select("row", part).repartition("part").write.partitionBy(
        "part"
    ).parquet(kept)
    drop_written(first)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _KeptRows(kept)
        for batch in sliced(batches):
            stays = wanted.among(batch.column(row).to_numpy())
            yield batch.select(columns).filter(pa.array(stays))

    return numbered.mapInArrow(tidy(keep), docs.schema)


#: Row numbers that agree above this many bits are listed together: those of 64 tasks.
ROWS_BITS = 39


class _KeptRows:
    """Which rows stay, from lists in the shared folder of which one is held at a time.

    A row's number begins with that of the task that wrote it, so a task that reads the rows
    back needs one list, and no text is shuffled to find out.
    """

    def __init__(self, path: str):
        self.files, self.root = store_of(path)
        self.part, self.rows = -1, np.empty(0, np.int64)

    def _load(self, part: int) -> None:
        where = f"{self.root}/part={part}"
        found = self.files.get_file_info(where).type != fs.FileType.NotFound
        table = ds.dataset(where, filesystem=self.files, format="parquet").to_table(columns=["row"]) if found else None
        self.rows = np.empty(0, np.int64) if table is None else np.sort(table["row"].to_numpy())
        self.part = part

    def among(self, rows: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(rows), bool)
        for part in np.unique(rows >> ROWS_BITS).tolist():
            if part != self.part:
                self._load(part)
            own = rows >> ROWS_BITS == part
            at = np.searchsorted(self.rows, rows[own])
            at[at == len(self.rows)] = 0
            stays[own] = self.rows[at] == rows[own] if len(self.rows) else False
        return stays
