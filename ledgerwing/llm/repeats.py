"""Passages that also occur in an earlier document: routing of windows to reference blocks.

Every window of ``length`` symbols has a seed, the least hash among its runs of
``seed`` symbols, so equal windows have equal seeds wherever they stand. A
maximal run of neighbouring windows with one seed is a unit; its context is the
text its windows cover.

1. Documents are packed into compressed files of the shared folder, in groups of
   ``GROUP_BYTES``; their texts are never shuffled.
2. Each group sends one small record per different seed to the seed's bucket.
   There it turns out which seeds one document has alone (nothing to do), which
   always have the same context (all but the first document's units repeat), and
   which have several.
3. Contexts of the last kind go to reference blocks by seed, where the method
   (``mark``) finds the windows that also start in an earlier document. Seeds in
   very many groups are sent window by window, dealt out by the window, so one
   frequent line in a third of all documents does not fill one block.
4. Each group gets its marks back and reads its texts once more.

Equal contexts of one group travel once, with their first document, whatever the
number of copies; what a bucket holds of one seed is bounded by the number of
groups, and buckets are as many as the input needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir, written
from .tokens import BASE, mix, tidy
from .warc import store_of

#: Text in a group, and in a bucket or reference block, on average.
GROUP_BYTES = 1 << 20
BUCKET_BYTES = 1 << 23
GROUPS_PER_TASK = 8
#: Seeds in more groups than this are compared window by window.
FREQUENT_GROUPS = 512
#: Windows whose seeds are found at a time.
CHUNK_WINDOWS = 1 << 19
#: Order of documents without an id: after all others.
LAST = np.iinfo(np.int64).max
ALONE, REPEATED, SEVERAL, FREQUENT = range(4)

GROUPS = "part long, file string, offset long, size long, raw long, docs binary"


class Kind(NamedTuple):
    """What a symbol is: ``read`` gives the symbols of texts and the first of each text."""

    read: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    dtype: str
    length: int
    seed: int


Mark = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def store_groups(docs: DataFrame, folder: str, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``GROUPS``: where each group's texts lie; ``docs`` packs ids, NULL marks and sizes."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        name, out, at = uuid.uuid4().hex, None, 0
        ids: list = []
        texts: list[bytes] = []

        def flush() -> dict:
            nonlocal out, at
            if out is None:
                store.create_dir(root)
                out = store.open_output_stream(f"{root}/{name}.zst", compression=None)
            data = zstandard.compress(b"".join(texts), 1)
            out.write(data)
            table = np.array(
                [
                    [LAST if i is None else i for i in ids],
                    [i is None for i in ids],
                    [len(t) for t in texts],
                ],
                np.int64,
            )
            row = {
                "part": uuid.uuid4().int >> 65,
                "file": name,
                "offset": at,
                "size": len(data),
                "raw": sum(map(len, texts)),
                "docs": _pack(table),
            }
            at += len(data)
            ids.clear()
            texts.clear()
            return row

        for batch in batches:
            rows, held = [], sum(map(len, texts))
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py() or b""
                ids.append(doc.as_py())
                texts.append(text)
                held += len(text) + 16
                if held >= group_bytes:
                    rows.append(flush())
                    held = 0
            yield pa.RecordBatch.from_pylist(rows, _GROUPS)
        if ids:
            yield pa.RecordBatch.from_pylist([flush()], _GROUPS)
        if out is not None:
            out.close()

    return written(source.mapInArrow(run, GROUPS), "text-groups")


_GROUPS = pa.schema(
    [
        ("part", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
        ("size", pa.int64()), ("raw", pa.int64()), ("docs", pa.binary()),
    ]
)


class Group(NamedTuple):
    ids: np.ndarray
    missing: np.ndarray
    texts: list[bytes]


def load_group(folder: str, row: dict) -> Group:
    store, root = store_of(folder)
    with store.open_input_file(f"{root}/{row['file']}.zst") as f:
        data = zstandard.decompress(f.read_at(row["size"], row["offset"]))
    ids, missing, sizes = _unpack(row["docs"], "<i8").reshape(3, -1)
    ends = np.cumsum(sizes)
    texts = [data[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    return Group(ids, missing, texts)


class Units(NamedTuple):
    """Units ordered by seed and context, and the classes of equal ones."""

    start: np.ndarray
    last: np.ndarray  # last window
    doc: np.ndarray
    cls: np.ndarray
    first: np.ndarray  # a unit of each class
    seed: np.ndarray  # of each class
    context: np.ndarray  # of each class
    low: np.ndarray  # least document id of each class
    many: np.ndarray  # whether each class is in several documents


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        _TABLES[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _TABLES.append(np.cumprod(p))
    return _TABLES[0][:n], _TABLES[1][:n]


def find_units(symbols: np.ndarray, first: np.ndarray, ids: np.ndarray, kind: Kind) -> Units:
    """All units of a group. A unit that crosses a chunk comes out as two, which is harmless:
    its seed then has two contexts, and those are compared window by window."""
    length, k = kind.length, kind.seed
    parts = []
    total = len(symbols) - length + 1
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for at in range(0, max(total, 0), CHUNK_WINDOWS):
        n_windows = min(CHUNK_WINDOWS, total - at)
        own = symbols[at : at + n_windows + length - 1]
        n = len(own)
        up, down = _powers(CHUNK_WINDOWS + length + 1)
        sums = np.zeros(n + 1, np.uint64)
        value = own.astype(np.uint64)
        value += np.uint64(1)
        value *= up[:n]
        np.cumsum(value, out=sums[1:])
        least = sums[k:] - sums[:-k]
        least *= down[: n - k + 1]
        least = mix(least)
        width, have = length - k + 1, 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: have - width], least[width - have :])
        doc = owner[at : at + n_windows]
        inside = np.arange(at, at + n_windows) + length <= first[doc + 1]
        new = np.empty(n_windows, bool)
        new[0] = True
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        start = np.flatnonzero(new)
        last = np.append(start[1:], n_windows) - 1
        keep = inside[start]
        start, last = start[keep], last[keep]
        span = (last - start).astype(np.uint64)
        context = mix((sums[last + length] - sums[start]) * down[start] + span * np.uint64(BASE))
        # Least hashes are small numbers; mixed once more they fill all buckets evenly.
        parts.append((start + at, last + at, doc[start], mix(least[start]), context))
    if not parts:
        parts = [(*(np.empty(0, np.int64),) * 3, *(np.empty(0, np.uint64),) * 2)]
    start, last, doc, seed, context = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((context, seed))
    start, last, doc, seed, context = (x[order] for x in (start, last, doc, seed, context))
    new = np.ones(len(seed), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (context[1:] != context[:-1])
    edge = np.flatnonzero(new)
    low = np.minimum.reduceat(ids[doc], edge) if len(edge) else np.empty(0, np.int64)
    many = (
        np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge)
        if len(edge)
        else np.empty(0, bool)
    )
    return Units(start, last, doc, np.cumsum(new) - 1, edge, seed[edge], context[edge], low, many)


class Seeds(NamedTuple):
    """Different seeds of a group in order, and the seed of each class."""

    seed: np.ndarray
    of_class: np.ndarray
    signature: np.ndarray  # the context if there is one, else 0
    low: np.ndarray
    many: np.ndarray


def group_seeds(u: Units) -> Seeds:
    new = np.ones(len(u.seed), bool)
    new[1:] = u.seed[1:] != u.seed[:-1]
    edge = np.flatnonzero(new)
    if not len(edge):
        empty = np.empty(0, np.int64)
        return Seeds(u.seed, empty, u.seed, empty, np.empty(0, bool))
    sizes = np.diff(np.append(edge, len(new)))
    low = np.minimum.reduceat(u.low, edge)
    # Several classes are in several documents unless all their units are in one.
    docs = u.doc[u.first]
    many = np.logical_or.reduceat(u.many, edge) | (
        np.minimum.reduceat(docs, edge) != np.maximum.reduceat(docs, edge)
    )
    signature = np.where(sizes == 1, u.context[edge] | np.uint64(1), np.uint64(0))
    return Seeds(u.seed[edge], np.cumsum(new) - 1, signature, low, many)


def _split(sorted_seeds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and the edges of their ranges."""
    bucket = (sorted_seeds >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_seeds), np.int64)
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    return bucket[edge], np.append(edge, len(bucket))


def _planes(a: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit integers, byte by byte, which compresses well."""
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8")


def decide(
    seeds: list[np.ndarray],
    signatures: list[np.ndarray],
    lows: list[np.ndarray],
    manys: list[np.ndarray],
    frequent: int,
) -> list[np.ndarray]:
    """What each group has to do about each of its seeds, from all groups' records of a bucket."""
    sizes = [len(s) for s in seeds]
    seed, signature, low, many = (np.concatenate(x) for x in (seeds, signatures, lows, manys))
    if not len(seed):
        return seeds
    order = np.argsort(seed, kind="stable")
    s = seed[order]
    edge = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    count = np.diff(np.append(edge, len(s)))
    sig = signature[order]
    one = (np.minimum.reduceat(sig, edge) == np.maximum.reduceat(sig, edge)) & (sig[edge] != 0)
    lowest = np.minimum.reduceat(low[order], edge)
    shared = (count > 1) | np.logical_or.reduceat(many[order], edge)
    per_seed = np.where(~shared, ALONE, np.where(one, REPEATED, np.where(count > frequent, FREQUENT, SEVERAL)))
    code = np.empty(len(s), np.uint8)
    spread = np.repeat(per_seed, count)
    first = (spread == REPEATED) & (low[order] == np.repeat(lowest, count))
    code[order] = np.where(first, ALONE, spread)
    return np.split(code, np.cumsum(sizes)[:-1])


class Pieces(NamedTuple):
    """Texts to compare elsewhere: where they stand, whose they are, which block they go to."""

    start: np.ndarray
    size: np.ndarray
    low: np.ndarray
    block: np.ndarray
    cls: np.ndarray  # class of a context, -1 for a window
    windows: tuple[np.ndarray, np.ndarray, np.ndarray]  # class, offset, piece of each frequent window


def find_pieces(symbols: np.ndarray, u: Units, code: np.ndarray, kind: Kind, bits: int) -> Pieces:
    """Contexts of seeds with several, and the different windows of frequent seeds; ordered by block."""
    cls = np.flatnonzero(code == SEVERAL)
    unit = u.first[cls]
    start, size = u.start[unit], u.last[unit] - u.start[unit] + kind.length
    low, key = u.low[cls], u.seed[cls]
    often = np.flatnonzero(code == FREQUENT)
    counts = u.last[u.first[often]] - u.start[u.first[often]] + 1
    w_cls = np.repeat(often, counts)
    w_off = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    w_start = u.start[u.first[w_cls]] + w_off
    factor = _powers(kind.length + 1)[0][1:]
    w_hash = np.zeros(len(w_start), np.uint64)
    for i in range(kind.length):
        w_hash += (symbols[w_start + i].astype(np.uint64) + np.uint64(1)) * factor[i]
    w_hash = mix(w_hash)
    w_seed, w_first, w_piece = np.unique(w_hash, return_index=True, return_inverse=True)
    w_low = np.full(len(w_seed), LAST, np.int64)
    np.minimum.at(w_low, w_piece, u.low[w_cls])
    start = np.concatenate((start, w_start[w_first]))
    size = np.concatenate((size, np.full(len(w_seed), kind.length, np.int64)))
    low, key = np.concatenate((low, w_low)), np.concatenate((key, w_seed))
    owner = np.concatenate((cls, np.full(len(w_seed), -1, np.int64)))
    block = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
    order = np.argsort(block, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    windows = (w_cls, w_off, place[len(cls) + w_piece.reshape(-1)])
    return Pieces(start[order], size[order], low[order], block[order], owner[order], windows)


def compare(parts: list[tuple[np.ndarray, np.ndarray, bytes]], kind: Kind, mark: Mark) -> list[np.ndarray]:
    """Marks of the windows of all pieces of a reference block.

    ``parts`` has sizes, document ids and symbols of each group's pieces. Equal
    pieces are compared once, as their first document's; later ones repeat it.
    """
    width = np.dtype(kind.dtype).itemsize
    lowest: dict[bytes, int] = {}
    keys = []
    for sizes, lows, data in parts:
        ends = (np.cumsum(sizes) * width).tolist()
        own = [data[b - n * width : b] for b, n in zip(ends, sizes.tolist(), strict=True)]
        keys.append(own)
        for piece, low in zip(own, lows.tolist(), strict=True):
            if low < lowest.get(piece, LAST + 1):
                lowest[piece] = low
    pieces = sorted(lowest, key=lambda p: (lowest[p], p))
    sizes = np.array([len(p) // width for p in pieces], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(pieces), kind.dtype)
    docs = np.array([lowest[p] for p in pieces], np.int64)
    marks = mark(text, first, docs, kind.length)
    at = np.concatenate(([0], np.cumsum(sizes - kind.length + 1)))
    of = {p: marks[at[i] : at[i + 1]] for i, p in enumerate(pieces)}
    out = []
    for own, (_, lows, _) in zip(keys, parts, strict=True):
        found = [
            of[p] if low == lowest[p] else np.ones(len(of[p]), bool)
            for p, low in zip(own, lows.tolist(), strict=True)
        ]
        out.append(np.concatenate(found) if found else np.empty(0, bool))
    return out


def removed(n: int, u: Units, ids: np.ndarray, code: np.ndarray, pieces: Pieces, marks: np.ndarray, kind: Kind) -> np.ndarray:
    """Which of a group's symbols are covered by a window that starts in an earlier document."""
    later = ids[u.doc] > u.low[u.cls]
    unit_code = code[u.cls]
    whole = later | (unit_code == REPEATED)
    edges = np.bincount(u.start[whole], minlength=n + 1)
    edges = edges - np.bincount(u.last[whole] + kind.length, minlength=n + 1)
    # Marks of a class hold for all its units that were not settled above.
    counts = pieces.size - kind.length + 1
    at = np.cumsum(counts) - counts
    hit = np.flatnonzero(marks)
    piece = np.searchsorted(at, hit, side="right") - 1
    m_cls, m_off = pieces.cls[piece], hit - at[piece]
    own = m_cls >= 0
    m_cls, m_off = m_cls[own], m_off[own]
    w_cls, w_off, w_piece = pieces.windows
    w_hit = marks[at[w_piece]] | (u.low[w_cls] > pieces.low[w_piece]) if len(w_piece) else np.empty(0, bool)
    m_cls, m_off = np.concatenate((m_cls, w_cls[w_hit])), np.concatenate((m_off, w_off[w_hit]))
    rest = np.flatnonzero(~whole & (unit_code >= SEVERAL))
    if len(m_cls) and len(rest):
        order = np.argsort(m_cls, kind="stable")
        m_cls, m_off = m_cls[order], m_off[order]
        lo = np.searchsorted(m_cls, u.cls[rest])
        count = np.searchsorted(m_cls, u.cls[rest], side="right") - lo
        unit = np.repeat(rest, count)
        which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        start = u.start[unit] + m_off[which]
        edges = edges + np.bincount(start, minlength=n + 1)
        edges = edges - np.bincount(start + kind.length, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def _spans(gone: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]


RESULT = "doc_id long, n_symbols long, spans array<struct<start:long,end:long>>, kept binary"
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_symbols", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def remove_repeats(
    docs: DataFrame,
    kind: Kind,
    mark: Mark,
    keep: Callable[[bytes, np.ndarray], bytes],
    group_bytes: int = GROUP_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    frequent: int = FREQUENT_GROUPS,
) -> DataFrame:
    """``RESULT``: what is removed from and left of each row of ``docs(doc_id, text)``.

    A symbol goes if a window over it also starts in a document with a smaller
    ``doc_id``; windows are judged on the input. Rows without an id come after all
    others; rows of one id are no smaller than each other, so neither loses to the
    other. NULL and empty texts have no symbols.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "texts")
    groups = store_groups(docs, folder, group_bytes)
    n_groups, raw = groups.agg(F.count("*"), F.coalesce(F.sum("raw"), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, n_groups // GROUPS_PER_TASK, min(n_groups, 4 * cores))
    bits = 0
    while raw > bucket_bytes << bits and bits < 24:
        bits += 1

    def opened(row: dict):
        group = load_group(folder, row)
        symbols, first = kind.read(group.texts)
        return group, symbols, first, find_units(symbols, first, group.ids, kind)

    def emit_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = group_seeds(opened(row)[3])
                buckets, edges = _split(s.seed, bits)
                out = {"bucket": buckets, "part": [row["part"]] * len(buckets), "seeds": [], "rest": []}
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    out["seeds"].append(_planes(s.seed[a:b] >> np.uint64(24 - bits), 5))
                    rest = _planes(s.signature[a:b] >> np.uint64(8), 6) + _planes(s.low[a:b], 8)
                    # a signature of several contexts is all zeros; one of a context ends in 1
                    out["rest"].append(rest + s.many[a:b].astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("seeds", pa.binary()), ("rest", pa.binary())]),
                )

    def settle(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        seeds = [_from_planes(r["seeds"], 5) for r in rows]
        signatures, lows, manys = [], [], []
        for r, s in zip(rows, seeds, strict=True):
            n, data = len(s), r["rest"]
            signatures.append(_from_planes(data[: 6 * n], 6))
            lows.append(_from_planes(data[6 * n : 14 * n], 8).view("<i8"))
            manys.append(np.frombuffer(data[14 * n :], np.uint8) > 0)
        codes = decide(seeds, signatures, lows, manys, frequent)
        return pa.table(
            {
                "part": table["part"],
                "bucket": table["bucket"],
                "codes": pa.array([_pack(c.astype(np.uint8)) for c in codes], pa.binary()),
            }
        )

    def class_codes(row: dict, u: Units) -> np.ndarray:
        codes = [_unpack(c["codes"], "u1") for c in row["codes"] or ()]
        s = group_seeds(u)
        return (np.concatenate(codes) if codes else np.empty(0, np.uint8))[s.of_class]

    def emit_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, symbols, _, u = opened(row)
                p = find_pieces(symbols, u, class_codes(row, u), kind, bits)
                edge = np.flatnonzero(np.append(True, p.block[1:] != p.block[:-1])) if len(p.block) else []
                out = {"bucket": [], "part": [], "sizes": [], "lows": [], "symbols": []}
                for a, b in zip(edge, np.append(edge[1:], len(p.block)) if len(edge) else (), strict=True):
                    size = p.size[a:b]
                    total = int(size.sum())
                    place = np.arange(total) + np.repeat(p.start[a:b] - (np.cumsum(size) - size), size)
                    out["bucket"].append(int(p.block[a]))
                    out["part"].append(row["part"])
                    out["sizes"].append(_pack(size))
                    out["lows"].append(_pack(p.low[a:b]))
                    out["symbols"].append(_pack(symbols[place]))
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema(
                        [("bucket", pa.int32()), ("part", pa.int64()), ("sizes", pa.binary()), ("lows", pa.binary()), ("symbols", pa.binary())]
                    ),
                )

    def compare_block(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [
            (_unpack(r["sizes"], "<i8"), _unpack(r["lows"], "<i8"), zstandard.decompress(r["symbols"]))
            for r in rows
        ]
        marks = compare(parts, kind, mark)
        return pa.table(
            {
                "part": table["part"],
                "bucket": table["bucket"],
                "marks": pa.array([_pack(np.packbits(m)) for m in marks], pa.binary()),
                "n": pa.array([len(m) for m in marks], pa.int64()),
            }
        )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group, symbols, first, u = opened(row)
                code = class_codes(row, u)
                pieces = find_pieces(symbols, u, code, kind, bits)
                marks = [np.unpackbits(_unpack(m["marks"], "u1"), count=m["n"]) for m in row["marks"] or ()]
                marks = np.concatenate(marks).astype(bool) if marks else np.empty(0, bool)
                gone = removed(len(symbols), u, group.ids, code, pieces, marks, kind)
                out = []
                for i, text in enumerate(group.texts):
                    own = gone[first[i] : first[i + 1]]
                    out.append(
                        {
                            "doc_id": None if group.missing[i] else int(group.ids[i]),
                            "n_symbols": len(own),
                            "spans": _spans(own),
                            "kept": keep(text, own),
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, _RESULT)

    seeds = groups.repartition(tasks, "part").mapInArrow(
        tidy(emit_seeds), "bucket int, part long, seeds binary, rest binary"
    )
    codes = seeds.groupBy("bucket").applyInArrow(settle, "part long, bucket int, codes binary")
    coded = written(
        groups.join(
            codes.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("bucket", "codes"))).alias("codes")),
            "part",
            "left",
        ),
        "seed-codes",
    )
    pieces = coded.repartition(tasks, "part").mapInArrow(
        tidy(emit_pieces), "bucket int, part long, sizes binary, lows binary, symbols binary"
    )
    marks = pieces.groupBy("bucket").applyInArrow(
        compare_block, "part long, bucket int, marks binary, n long"
    )
    marked = written(
        marks.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("bucket", "marks", "n"))).alias("marks")),
        "window-marks",
    )
    return coded.join(marked, "part", "left").repartition(tasks, "part").mapInArrow(tidy(finish), RESULT)
