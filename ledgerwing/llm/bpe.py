"""BPE encoding by tree concatenation, and decoding.

A text longer than a leaf is halved until the pieces fit; pieces are rows that
any task encodes. Where two encoded pieces meet, a window around the join is
encoded again and grown until it agrees with the left piece on one side and with
the right piece on the other; the tokens between the two agreements replace
those of the pieces.

An agreement is a place where a token of both encodings starts and either white
space stands before it (no token and no merge spans white space), or the two
tokens before it and the two after it are the same in both. The latter suffices
because a BPE encoding is the right one exactly if every pair of neighbouring
tokens encodes to itself, and each such pair then stands in one of the encodings.
If a window grows over both pieces, they are encoded as one text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .tokens import grouped, sliced, tidy

#: Texts of more characters are halved into leaves.
LEAF_CHARS = 16384
#: Characters on each side of a join in the first window.
WINDOW_CHARS = 32
#: Words, and runs of letters within them, kept with their tokens by one Python
#: worker; and the longest such word.
CACHED_WORDS = 100_000
CACHED_RUNS = 250_000
CACHED_CHARS = 64
#: Characters encoded or decoded at a time, unless one text has more.
BATCH_CHARS = 1 << 20
#: These count as blanks for Python's split, but not for the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORD = re.compile(r"[^ \t\n\r]+")
#: A run of Latin letters, then ASCII punctuation but for the apostrophe: the
#: tokenizer's rules always part such a word there and fold its letters one by one.
LETTERS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """A tokenizer of the tokenizers library, called for words that are not known yet."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        suffix = self.tokenizer.model.end_of_word_suffix
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {"": b""}

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Token ids and the character at which each token starts."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        return np.array(found.ids, np.uint32), starts

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _letter_runs(self, runs: list[str]) -> list[bytes]:
        """Runs of letters are one word each, so one call encodes them and word ends part them."""
        if not runs:
            return []
        joined = self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(runs):
            return self._each(runs)
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """A table with the tokens of all these words; forgets old ones when it is large."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.runs) > CACHED_RUNS:
            self.runs = {"": b""}
        parted, letters, rest = [], set(), set()
        for word in words.difference(self.words):
            m = LETTERS.fullmatch(word)
            if m:
                run, tail = m[1].lower(), m[2]
                parted.append((word, run, tail))
                letters.add(run)
                rest.add(tail)
            else:
                rest.add(word)
        fresh = list(letters.difference(self.runs))
        self.runs.update(zip(fresh, self._letter_runs(fresh), strict=True))
        fresh = list(rest.difference(self.runs))
        other = dict(zip(fresh, self._each(fresh), strict=True))
        self.runs.update((w, i) for w, i in other.items() if len(w) <= CACHED_CHARS)
        found = {w: self.runs[a] + (self.runs[b] if b in self.runs else other[b]) for w, a, b in parted}
        found.update((w, self.runs[w] if w in self.runs else other[w]) for w in rest)
        self.words.update((w, i) for w, i in found.items() if len(w) <= CACHED_CHARS)
        longer = {w: i for w, i in found.items() if len(w) > CACHED_CHARS}
        return {**self.words, **longer} if longer else self.words

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers.

        White space always ends a token, so a text is its words one after the other.
        """
        parts = [
            t.split(" ") if any(c in t for c in SEPARATORS) else t.split() for t in texts
        ]
        known = self.learn(set().union(*parts, ("",)))
        return [b"".join([known[w] for w in p]) for p in parts]

    def leaf(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`whole`, word by word; tokens of short words all start with their word.

        That is enough for joins: they look inside a word only if it is long.
        """
        words = WORD.findall(text)
        at = np.fromiter((m.start() for m in WORD.finditer(text)), np.int64, len(words))
        known = self.learn({w for w in words if len(w) <= CACHED_CHARS})
        long_words = {i: self.whole(w) for i, w in enumerate(words) if len(w) > CACHED_CHARS}
        parts = [
            long_words[i][0].astype("<u4").tobytes() if i in long_words else known[w]
            for i, w in enumerate(words)
        ]
        counts = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
        starts = np.repeat(at, counts)
        first = np.cumsum(counts) - counts
        for i, (own, places) in long_words.items():
            starts[first[i] : first[i] + len(own)] += places
        return np.frombuffer(b"".join(parts), "<u4"), starts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, whose word table lives as long as the worker."""
    return Encoder(path)


@lru_cache(maxsize=2)
def token_table(path: str) -> list[str | None]:
    """Tokens by id, read from the vocabulary file: decoding needs no tokenizer in memory."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    if content.get("decoder") is not None:
        raise ValueError("only tokenizers without a decoder are decoded by their tokens")
    tokens = {i: t for t, i in content["model"]["vocab"].items()}
    tokens.update((t["id"], t["content"]) for t in content["added_tokens"])
    return [tokens.get(i) for i in range(max(tokens) + 1)]


def leaf_bounds(size: int, leaf: int) -> list[int]:
    """Ends of the leaves of a text that is halved until no piece is above ``leaf``."""
    parts = 1
    while size > leaf * parts:
        parts *= 2
    return [size * (i + 1) // parts for i in range(parts)]


Piece = tuple[int, int, np.ndarray, np.ndarray]  # from, to, ids, starts


def _agreements(text: str, own: Piece, window: Piece) -> list[tuple[int, int, int, bool]]:
    """Places ``(char, index in own, index in window, after white space)`` of agreement."""
    _, _, ids, starts = own
    lo, hi, w_ids, w_starts = window
    first, last = np.searchsorted(starts, [lo, hi])
    at: dict[int, int] = {}
    for i in range(first, last):
        if i == 0 or starts[i] != starts[i - 1]:
            at[int(starts[i])] = i
    found = []
    for j, char in enumerate(w_starts.tolist()):
        i = at.get(char)
        if i is None or (j and w_starts[j - 1] == char):
            continue
        blank = char > max(lo, own[0]) and text[char - 1] in " \t\n\r"
        same = blank or (
            min(i, j) >= 2
            and i + 2 <= len(ids)
            and j + 2 <= len(w_ids)
            and np.array_equal(ids[i - 2 : i + 2], w_ids[j - 2 : j + 2])
            and np.array_equal(starts[i - 2 : i + 2], w_starts[j - 2 : j + 2])
        )
        if same:
            found.append((char, i, j, blank))
    return found


def join_pieces(coder: Encoder, text: str, left: Piece, right: Piece, window: int) -> Piece:
    """The encoding of two neighbouring pieces of ``text`` as one."""
    a, c, left_ids, left_starts = left
    _, b, right_ids, right_starts = right
    while True:
        lo, hi = max(a, c - window), min(b, c + window)
        ids, starts = coder.whole(text[lo:hi])
        middle = (lo, hi, ids, starts + lo)
        if lo == a and hi == b:
            return middle
        before = [(0, 0, 0, True)] if lo == a else _agreements(text, left, middle)
        after = (
            [(b, len(right_ids), len(ids), True)] if hi == b else _agreements(text, right, middle)
        )
        before = [x for x in before if x[0] < c]
        after = [x for x in after if x[0] >= c]
        if before and after:
            _, i, p, _ = max(before, key=lambda x: (x[3], x[0]))
            _, j, q, _ = min(after, key=lambda x: (not x[3], x[0]))
            if p <= q:
                return (
                    a,
                    b,
                    np.concatenate((left_ids[:i], ids[p:q], right_ids[j:])),
                    np.concatenate((left_starts[:i], middle[3][p:q], right_starts[j:])),
                )
        window *= 2


def join_tree(coder: Encoder, text: str, pieces: list[Piece], window: int = WINDOW_CHARS) -> Piece:
    """Join neighbours, then neighbouring pairs, up to the whole text."""
    while len(pieces) > 1:
        pieces = [
            join_pieces(coder, text, *pieces[i : i + 2], window) if i + 1 < len(pieces) else pieces[i]
            for i in range(0, len(pieces), 2)
        ]
    return pieces[0]


def decode_ids(ids: bytes | None, path: str) -> str:
    """Tokens by one space, as the library joins them for a tokenizer without a decoder."""
    return " ".join(map(token_table(path).__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(
    docs: DataFrame,
    path: str,
    leaf_chars: int = LEAF_CHARS,
    window_chars: int = WINDOW_CHARS,
    decoded: bool = False,
) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs(doc_id, text)``.

    With ``decoded`` a third column has what :func:`decode` makes of the ids, in the
    same pass.

    ``ids`` is binary, little-endian unsigned 32-bit, exactly as the library encodes
    the whole text without added special tokens. NULL and empty texts have no ids;
    repeated rows come out repeated, NULL ``doc_id`` stays.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    out = StructType([StructField("doc_id", kind), StructField("ids", BinaryType())])
    if decoded:
        out = out.add("decoded", StringType())

    def columns(doc_ids: pa.Array, ids: list[bytes]) -> list[pa.Array]:
        made = [doc_ids, pa.array(ids, pa.binary())]
        if decoded:
            made.append(pa.array([decode_ids(i, path) for i in ids], pa.string()))
        return made

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            for lo, hi in grouped(texts, BATCH_CHARS):  # a text's words take ten times its memory
                ids = coder.batch(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    columns(batch.column("doc_id").slice(lo, hi - lo), ids), out.names
                )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                ends = leaf_bounds(len(text), leaf_chars)
                starts = [0, *ends[:-1]]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("row")[i].as_py()] * n, pa.int64()),
                        pa.array([batch.column("doc_id")[i].as_py()] * n, batch.column("doc_id").type),
                        pa.array(range(n), pa.int32()),
                        pa.array([text[a:b] for a, b in zip(starts, ends, strict=True)], pa.string()),
                    ],
                    ["row", "doc_id", "leaf", "text"],
                )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            done = [coder.leaf(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([i.astype("<u4").tobytes() for i, _ in done], pa.binary()),
                    pa.array([s.astype("<i4").tobytes() for _, s in done], pa.binary()),
                ],
                [*batch.schema.names, "ids", "starts"],
            )

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("leaf")
        texts, pieces, at = table["text"].to_pylist(), [], 0
        for t, ids, starts in zip(texts, table["ids"], table["starts"], strict=True):
            places = np.frombuffer(starts.as_py(), "<i4").astype(np.int64) + at
            pieces.append((at, at + len(t), np.frombuffer(ids.as_py(), "<u4"), places))
            at += len(t)
        whole = join_tree(encoder(path), "".join(texts), pieces, window_chars)
        doc_id = table["doc_id"].slice(0, 1).combine_chunks()
        return pa.table(columns(doc_id, [whole[2].astype("<u4").tobytes()]), names=out.names)

    piece = [
        StructField("row", LongType()),
        StructField("doc_id", kind),
        StructField("leaf", IntegerType()),
        StructField("text", StringType()),
    ]
    coded = StructType([*piece, StructField("ids", BinaryType()), StructField("starts", BinaryType())])
    long_rows = rows.where(F.length("text") > leaf_chars).withColumn(
        "row", F.monotonically_increasing_id()
    )
    long_ids = (
        long_rows.mapInArrow(split, StructType(piece))
        .repartition("row", "leaf")
        .mapInArrow(tidy(leaves), coded)
        .groupBy("row")
        .applyInArrow(joined, out)
    )
    return rows.where(F.length("text") <= leaf_chars).mapInArrow(tidy(short), out).unionByName(long_ids)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` for every row of ``encoded(doc_id, ids)``.

    For a tokenizer without a decoder the library joins the tokens by one space;
    special tokens stay. NULL ids decode to the empty text.
    """
    source = encoded.select("doc_id", "ids")
    out = StructType([*source.schema, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [ids or b"" for ids in batch.column("ids").to_pylist()]
            for lo, hi in grouped(coded, 4 * BATCH_CHARS):
                texts = [decode_ids(i, path) for i in coded[lo:hi]]
                columns = [c.slice(lo, hi - lo) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
                )

    return source.mapInArrow(tidy(run), out)
