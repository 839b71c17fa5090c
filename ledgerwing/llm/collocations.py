"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are phrases, an edge is a longest gram (``MAX_WORDS`` words) between the two
overlapping phrases that it starts and ends with; its weight is how often it occurs.
At the end of a piece shorter grams stand in for the edges that no longer fit. The
count of a shorter phrase is then the flow out of its node: the weights of all edges
that begin with it, plus these piece-end corrections. A node whose whole flow goes
through one edge lies on a unary path and is compacted into that edge.

A phrase of ``least`` occurrences has only words and word pairs of as many. So pieces
are also ended at words and pairs that are surely rarer, which a first pass tells by
counting them in a fixed number of hash buckets; grams beyond are never written. The
others are dealt by their first pair, so that all shorter counts but those of single words
are complete where the grams meet. A pair that very many grams begin with is split:
its grams are dealt by all their words, and its sums are completed by one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_written, written
from .tokens import mix, powers, tidy

#: Words of the longest phrase, that is of an edge.
MAX_WORDS = 5
#: Hash buckets that rare words and pairs are told by, a fixed 8 MB of bits. More words
#: than that fill the buckets, which lets more grams through and changes no result.
BUCKET_BITS, RANGE_BITS = 26, 16
#: Bytes of text that are worked on at a time.
CHUNK_BYTES = 6 << 20
#: Copies of the few counts per language, so that no language is one key of a join.
SALTS = 64

#: Piece ends and the blanks between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True
_WORD = ~_ENDS
_WORD[list(BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Chunk:
    """Words of neighbouring texts; the first ``n_starts`` may begin a gram, the rest only go on with one."""

    def __init__(self, buf: np.ndarray, n_own: int, lang: np.ndarray, lang_hash: np.ndarray):
        """``buf`` bytes, of which the first ``n_own`` belong to this chunk; a language per byte position."""
        inside = np.concatenate(([False], _WORD[buf], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        self.n = len(start)
        self.n_starts = int(np.searchsorted(start, n_own))
        if not self.n:
            return
        size = end - start
        first = np.cumsum(size) - size
        body = buf[inside[1:-1]]
        value = body.astype(np.uint64) + np.uint64(1)
        value *= powers(int(size.max()))[np.arange(len(body)) - np.repeat(first, size)]
        h = np.add.reduceat(value, first)
        h += size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        self.lang = lang[start]
        self.hash = mix(h + lang_hash[self.lang])
        piece = np.cumsum(_ENDS[buf])[start]
        #: Whether a word and the next are in one piece.
        self.joined = np.append(piece[1:] == piece[:-1], False)
        offsets = np.append(first, len(body)).astype(np.int32)
        self.words = pa.StringArray.from_buffers(self.n, pa.py_buffer(offsets), pa.py_buffer(body.tobytes()))

    def pairs(self) -> np.ndarray:
        """A hash of each word and the next."""
        return mix(self.hash * np.uint64(0x9E3779B97F4A7C15) + np.roll(self.hash, -1))


def _own_end(buf: np.ndarray, at: int) -> tuple[int, int]:
    """Where a chunk from ``at`` ends, after a byte of no word, and where the grams of its last words do."""
    size = CHUNK_BYTES
    while True:
        if at + size >= len(buf):
            return len(buf), len(buf)
        gaps = np.flatnonzero(~_WORD[buf[at : at + size]])
        if len(gaps):
            break
        size *= 2
    cut = at + int(gaps[-1]) + 1
    ahead = 4096
    while True:
        rest = buf[cut : cut + ahead]
        ends = np.flatnonzero(_ENDS[rest])
        word = _WORD[rest]
        closed = np.flatnonzero(word[:-1] & ~word[1:])
        if len(ends) and len(closed) < MAX_WORDS:
            return cut, cut + int(ends[0]) + 1
        if len(closed) >= MAX_WORDS:
            return cut, cut + int(closed[MAX_WORDS - 1]) + 1
        if cut + ahead >= len(buf):
            return cut, len(buf)
        ahead *= 2


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, list[str]]]:
    """Chunks of the texts of ``(lang, text)`` batches, with the languages that their words name by number."""
    for batch in batches:
        texts, at = batch["text"], 0
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        while at < len(batch):
            # Some texts at a time; one that is longer is cut into chunks below.
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK_BYTES, side="right")))
            part = texts.slice(at, n).to_pylist()
            langs = batch["lang"].slice(at, n).dictionary_encode()
            names = langs.dictionary.to_pylist()
            lang_hash = np.array([_text_hash(x) for x in names], np.uint64)
            raw = np.frombuffer(b"".join([t.encode() + b"\n" for t in part]), np.uint8)
            buf = _LOWER[raw]
            lang = np.repeat(langs.indices.to_numpy().astype(np.int32), sizes[at : at + n])
            here = 0
            while here < len(buf):
                cut, end = _own_end(buf, here)
                yield Chunk(buf[here:end], cut - here, lang[here:end], lang_hash), names
                here = cut
            at += n


def _text_hash(text: str) -> int:
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = (h ^ b) * 0x100000001B3 % (1 << 64)
    return h


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


#: A word pair that makes up this share of a chunk's words is noted, and so many of those are split.
HEAVY_SHARE, SPLIT_HEADS = 1 / 256, 512
#: Text whose grams go to one range of first pairs, on average.
RANGE_BYTES = 8 << 20

_RANGES = pa.schema([("range", pa.int32()), ("counts", pa.binary()), ("head", pa.int64()), ("n", pa.int64())])
_RANGES_DDL = "range int, counts binary, head long, n long"
_N_RANGES = 1 << BUCKET_BITS - RANGE_BITS


def _kind(least: int) -> type:
    return np.uint8 if least < 256 else np.int32


def _count_buckets(least: int):
    """Occurrences of words and pairs by bucket, up to ``least``, in compressed ranges; and heavy pairs."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for chunk, _ in chunks(batches):
            n = chunk.n_starts
            if not n:
                continue
            if held is None:
                held = np.zeros(1 << BUCKET_BITS, _kind(least))
            pairs, pair_times = np.unique(chunk.pairs()[:n][chunk.joined[:n]], return_counts=True)
            words, word_times = np.unique(chunk.hash[:n], return_counts=True)
            # Sums up to the bound are the same whether their parts were cut at it or not.
            for h, times in ((pairs, pair_times), (words, word_times)):
                at, first = np.unique(_buckets(h), return_index=True)
                sums = np.add.reduceat(times, first) if len(first) else times
                held[at] = np.minimum(held[at].astype(np.int64) + sums, least)
            heavy = pair_times >= n * HEAVY_SHARE
            if heavy.any():
                m = int(heavy.sum())
                head = pairs[heavy].view(np.int64)
                # Behind the ranges, dealt by their hash.
                place = (_N_RANGES + (pairs[heavy] % np.uint64(64))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.nulls(m, pa.binary()), pa.array(head), pa.array(pair_times[heavy])], schema=_RANGES
                )
        if held is None:
            return
        for i, part in enumerate(held.reshape(-1, 1 << RANGE_BITS)):
            if part.any():
                packed = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({"range": [i], "counts": [packed], "head": [None], "n": [None]}, _RANGES)

    return run


def _sum_buckets(least: int):
    """Of each range of buckets, a bit per bucket that holds ``least`` occurrences or more; sums of heavy pairs."""
    kind = _kind(least)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        heavy: dict[int, int] = {}
        for batch in batches:
            for at, packed, head, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if head is not None:
                    heavy[head] = heavy.get(head, 0) + n
                    continue
                raw = pa.decompress(packed, (1 << RANGE_BITS) * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
                held = total.setdefault(at, np.zeros(1 << RANGE_BITS, np.int32))
                np.minimum(held + np.frombuffer(raw, kind), least, out=held)
        for at, held in total.items():
            bits = np.packbits(held >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"range": [at], "counts": [bits], "head": [None], "n": [None]}, _RANGES)
        if heavy:
            m = len(heavy)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.array(list(heavy), pa.int64()), pa.array(list(heavy.values()), pa.int64())],
                schema=_RANGES,
            )

    return run


class Filter(NamedTuple):
    """What the second pass goes by: common buckets as bits, and the pairs whose grams are split up."""

    bits: np.ndarray
    split: np.ndarray


def frequent_buckets(texts: DataFrame, least: int) -> Filter:
    """A bit for each hash bucket whose words and pairs occur ``least`` times or more (8 MB at any size).

    And the hashes of ``SPLIT_HEADS`` pairs at most, among them every pair that makes up
    twice ``HEAVY_SHARE`` of all words: half of its occurrences at least are in chunks where it is
    heavy, and no more than ``1 / HEAVY_SHARE`` pairs can have as many.
    """
    ranges = texts.mapInArrow(_count_buckets(least), _RANGES_DDL)
    kept = written(ranges.repartition("range").mapInArrow(_sum_buckets(least), _RANGES_DDL), "buckets")
    bits = np.zeros((_N_RANGES, 1 << RANGE_BITS - 3), np.uint8)
    for row in kept.where("head IS NULL").collect():
        bits[row["range"]] = np.frombuffer(row["counts"], np.uint8)
    heavy = kept.where("head IS NOT NULL").orderBy(F.desc("n"), "head").limit(SPLIT_HEADS).select("head").collect()
    drop_written(kept)
    return Filter(bits.reshape(-1), np.sort(np.array([r["head"] for r in heavy], np.int64)).view(np.uint64))


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _buckets(h)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 != 0


class Grams(NamedTuple):
    """Different grams of one length in a chunk, where each first stands, and how often each occurs."""

    words: int
    at: np.ndarray
    text: pa.Array
    times: np.ndarray


def longest_grams(chunk: Chunk, bits: np.ndarray) -> Iterator[Grams]:
    """The grams from every common word on, as long as they go."""
    n = chunk.n_starts
    common = _holds(bits, chunk.hash)
    goes_on = chunk.joined & common & np.roll(common, -1)
    goes_on[goes_on] = _holds(bits, chunk.pairs()[goes_on])
    words = np.zeros(chunk.n, np.int32)
    for _ in range(MAX_WORDS):
        words = np.where(common, 1 + np.where(goes_on, np.minimum(np.roll(words, -1), MAX_WORDS - 1), 0), 0)
    code = chunk.words.dictionary_encode().indices.to_numpy().astype(np.int64)
    # Equal grams have equal numbers: those of a gram's first words and of its next word.
    number = np.unique(code * (int(chunk.lang.max()) + 1) + chunk.lang, return_inverse=True)[1]
    begins = np.flatnonzero(words[:n])
    number = number[begins]
    for size in range(1, MAX_WORDS + 1):
        ends = words[begins] == size
        if ends.any():
            _, first, times = np.unique(number[ends], return_index=True, return_counts=True)
            at = begins[ends][first]
            parts = [chunk.words.take(pa.array(at + i)) for i in range(size)]
            text = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
            yield Grams(size, at, text, times)
        begins, number = begins[~ends], number[~ends]
        if not len(begins):
            break
        number = np.unique(number * (int(code.max()) + 1) + code[begins + size], return_inverse=True)[1]


def _where_to(chunk: Chunk, grams: Grams, split: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each gram: that of its first pair, or one of its own (numbered below -1) if that is split."""
    if grams.words == 1:
        return (chunk.hash[grams.at] % np.uint64(ranges)).astype(np.int64)
    head = chunk.pairs()[grams.at]
    to = (head % np.uint64(ranges)).astype(np.int64)
    own = np.isin(head, split)
    if own.any():
        h = head[own]
        for i in range(2, grams.words):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + chunk.hash[grams.at[own] + i])
        to[own] = -2 - (mix(h) % np.uint64(ranges)).astype(np.int64)
    return to


_PACKED = pa.schema(
    [("lang", pa.string()), ("range", pa.int64()), ("size", pa.int64()), ("grams", pa.binary()), ("times", pa.binary())]
)
_PACKED_DDL = "lang string, range long, size long, grams binary, times binary"


def _pack_grams(shared, ranges: int):
    """The grams of each chunk by language and range, compressed in order; range -1 has the number of words."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        for chunk, names in chunks(batches):
            if not chunk.n_starts:
                continue
            langs, times = np.unique(chunk.lang[: chunk.n_starts], return_counts=True)
            out: dict[str, list] = {
                "lang": [names[i] for i in langs], "range": [-1] * len(langs), "size": times.tolist(),
                "grams": [None] * len(langs), "times": [None] * len(langs),
            }
            found = list(longest_grams(chunk, by.bits))
            if found:
                lang = np.concatenate([chunk.lang[g.at] for g in found])
                to = np.concatenate([_where_to(chunk, g, by.split, ranges) for g in found])
                text = pa.concat_arrays([g.text for g in found])
                n = np.concatenate([g.times for g in found]).astype("<i8")
                table = pa.table({"lang": lang, "to": to, "text": text})
                order = pc.sort_indices(table, [("lang", "ascending"), ("to", "ascending"), ("text", "ascending")])
                order = order.to_numpy()
                lang, to, n = lang[order], to[order], n[order]
                edge = np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (to[1:] != to[:-1])))
                lines = text.take(pa.array(order)).to_pylist()
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(n)], strict=True):
                    body = "\n".join(lines[a:b]).encode()
                    out["lang"].append(names[lang[a]])
                    out["range"].append(int(to[a]))
                    out["size"].append(len(body))
                    out["grams"].append(pa.compress(body, codec="zstd", asbytes=True))
                    out["times"].append(pa.compress(n[a:b].tobytes(), codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_pydict(out, _PACKED)

    return run


_COUNTS = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNTS_DDL = "lang string, words int, phrase string, n long"


def node_flow(grams: pa.Array, times: pa.Array) -> Iterator[tuple[int, pa.Table]]:
    """Of each number of words, the phrases that the grams begin with and the sums of their times."""
    lists = pc.split_pattern(grams, " ")
    sizes = pc.list_value_length(lists)
    for k in range(1, MAX_WORDS + 1):
        long_enough = pc.greater_equal(sizes, k)
        own = lists.filter(long_enough)
        if not len(own):
            return
        phrase = pc.binary_join(pc.list_slice(own, 0, k), " ")
        yield k, pa.table({"phrase": phrase, "n": times.filter(long_enough)}).group_by("phrase").aggregate([("n", "sum")])


def _sum_grams(least: int):
    """Phrases of each language and range with their flow; all grams of a pair are in one range unless it is split.

    What is complete here is kept from ``least`` on; first words and the phrases of split
    pairs are parts of sums that Spark completes. Rows come ordered by range and language.
    """

    def flow(lang: str, at: int, held: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        text = b"\n".join(pa.decompress(g, size, codec="zstd", asbytes=True) for size, g, _ in held)
        grams = pa.array(text.decode().split("\n"), pa.string())
        raw = [zstandard.decompress(t) for _, _, t in held]
        times = pa.array(np.frombuffer(b"".join(raw), "<i8"), pa.int64())
        for k, found in node_flow(grams, times):
            if k > 1 and at >= 0:
                found = found.filter(pc.greater_equal(found["n_sum"], least))
            m = len(found)
            columns = [
                pa.array([lang] * m, pa.string()), pa.array(np.full(m, k, np.int32)),
                found["phrase"].combine_chunks(), found["n_sum"].combine_chunks(),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for lang, at, size, grams, times in zip(*batch.columns, strict=True):
                lang, at, size = lang.as_py(), at.as_py(), size.as_py()
                if at == -1:
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "words": [0], "phrase": [""], "n": [size]}, _COUNTS)
                    continue
                if (lang, at) != key:
                    if held:
                        yield from flow(*key, held)
                    key, held = (lang, at), []
                held.append((size, grams.as_py(), times.as_py()))
        if held:
            yield from flow(*key, held)

    return run


def first_words(gram: Column, n: Column) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), n)


def last_words(gram: Column, n: Column) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), -n)


def graph(docs: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, phrase, n)`` of all phrases with ``least`` occurrences, and ``(lang, total)`` words.

    Phrases of ``MAX_WORDS`` words are the graph's edges, shorter ones its nodes with the
    flow out of them: the edges that begin with them and the piece-end corrections.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, -(-n_bytes // RANGE_BYTES))
    shared = spark.sparkContext.broadcast(frequent_buckets(texts, least))
    packed = texts.mapInArrow(_pack_grams(shared, ranges), _PACKED_DDL)
    dealt = packed.repartition("lang", "range").sortWithinPartitions("range", "lang")
    parts = dealt.mapInArrow(_sum_grams(least), _COUNTS_DDL)
    flow = parts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    counts = written(flow.where((F.col("n") >= least) | (F.col("words") == 0)), "phrases")
    return counts.where("words > 0"), counts.where("words = 0").select("lang", F.col("n").alias("total"))


def compacted(counts: DataFrame) -> DataFrame:
    """The phrases with ``absorbed``: whether an edge to or from the phrase carries its whole flow.

    Such a node has one edge there and no piece begins or ends at it, so it lies within a unary
    path and every occurrence of it is one of the longer phrase.
    """
    ends = F.array(
        first_words(F.col("phrase"), F.col("words") - 1), last_words(F.col("phrase"), F.col("words") - 1)
    )
    edge = counts.where("words > 1").select("lang", F.explode(ends).alias("phrase"), "n")
    widest = edge.groupBy("lang", "phrase").agg(F.max("n").alias("widest"))
    return counts.join(widest, ["lang", "phrase"], "left").select(
        "lang", "words", "phrase", "n", F.coalesce(F.col("widest") >= F.col("n"), F.lit(False)).alias("absorbed")
    )


def unary_paths(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, words, n)``: the edges of a phrase table with unary paths compacted.

    Two edges are joined where one's last words are the other's first and that node's
    whole flow goes from the one into the other, so a passage that is always
    repeated whole is one row, however long. Places along a path are found by pointer doubling,
    in rounds that are logarithmic in the longest path. A path that closes on itself has no
    first edge and stays as its edges.
    """
    edges = counts.where(F.col("words") == MAX_WORDS).select("lang", "phrase", "n")
    node = counts.where(F.col("words") == MAX_WORDS - 1).select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    k = F.lit(MAX_WORDS - 1)
    into = edges.select("lang", last_words(F.col("phrase"), k).alias("node"), F.col("phrase").alias("before"), "n")
    out = edges.select("lang", first_words(F.col("phrase"), k).alias("node"), "phrase", F.col("n").alias("m"))
    # An edge that carries the whole flow is the only one on its side.
    links = (
        into.join(node, ["lang", "node"])
        .where("n = flow")
        .join(out, ["lang", "node"])
        .where("m = flow AND before <> phrase")
        .select("lang", "phrase", "before")
    )
    at = edges.join(links, ["lang", "phrase"], "left").select(
        "lang", "phrase", "n", F.coalesce("before", "phrase").alias("head"),
        F.col("before").isNotNull().cast("int").alias("place"), F.col("before").isNull().alias("ended"),
    )
    at = written(at, "path-places")
    open_, reach = at.where("NOT ended").count(), 1
    total = at.count()
    while open_ and reach <= 2 * total:
        to = at.select(
            "lang", F.col("phrase").alias("head"), F.col("head").alias("next"), F.col("place").alias("more"), F.col("ended").alias("next_ended")
        )
        moved = at.where("NOT ended").join(to, ["lang", "head"]).select(
            "lang", "phrase", "n", F.col("next").alias("head"), (F.col("place") + F.col("more")).alias("place"), F.col("next_ended").alias("ended")
        )
        old, at = at, written(at.where("ended").unionByName(moved), "path-places")
        drop_written(old)
        open_, reach = at.where("NOT ended").count(), 2 * reach
    own = F.struct(F.col("place"), F.substring_index("phrase", " ", -1).alias("word"))
    straight = at.where("ended").groupBy("lang", "head").agg(F.sort_array(F.collect_list(own)).alias("p"), F.min("n").alias("n"))
    rest = F.slice(F.col("p.word"), 2, F.greatest(F.size("p") - 1, F.lit(0)))
    straight = straight.select(
        "lang", F.concat_ws(" ", F.col("head"), rest).alias("phrase"), (F.size("p") + MAX_WORDS - 1).cast("int").alias("words"), "n"
    )
    closed = at.where("NOT ended").select("lang", "phrase", F.lit(MAX_WORDS).alias("words"), "n")
    return straight.unionByName(closed) if open_ else straight


def collocations(docs: DataFrame, least: int = 100, top: int | None = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: phrases whose words keep company, best first.

    Texts are lower-cased (A-Z), split into pieces and words; a phrase has 2 to
    ``MAX_WORDS`` words of one piece. ``a`` counts the phrase, ``l`` and ``r`` the two
    parts of its worst cut, ``n`` all words of the language (NULL: ``und``); the score
    is ``floor(1000 * a * n / (l * r))``. Phrases that never occur but in one longer
    phrase are left out. NULL and empty texts have no words; repeated rows count as
    often as they occur; equal scores go by ``a``, then by the phrase in byte order, so
    no ties are left. Other columns are ignored; no frequent phrase gives no rows.
    ``top`` phrases per language are returned (NULL: all).
    """
    counts, totals = graph(docs, least)
    kept = compacted(counts).where("words > 1 AND NOT absorbed")
    cuts = kept.select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        F.explode(F.expr("sequence(1, words - 1)")).alias("k"),
        "words",
    )
    cuts = cuts.withColumn("head", first_words(F.col("phrase"), F.col("k"))).withColumn(
        "tail", last_words(F.col("phrase"), F.col("words") - F.col("k"))
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    total = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("total", "n")
    wide = {c: F.col(c).cast("decimal(38,0)") for c in "alrn"}
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("salt", salt)
        .join(total, ["lang", "salt"])
        .withColumns({f"wide_{c}": x for c, x in wide.items()})
        .withColumn("score", F.expr("(1000 * wide_a * wide_n) div (wide_l * wide_r)"))
    )
    worst = F.min(F.struct("score", "k", "l", "r", "n")).alias("c")
    ranked = scored.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "c.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = ranked.withColumn("rank", F.row_number().over(order))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
