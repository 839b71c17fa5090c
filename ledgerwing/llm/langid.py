"""Language identification in two levels: family first, then the language within it.

At both levels each pair of classes has a linear support vector machine over byte
trigram frequencies, and the class with the highest sum of pairwise confidences
wins. Training takes a bounded sample of labelled rows and fits every pair in a
task of its own; what a text must reach is set by all rows that were held out; prediction is one scan in which a text's score is the mean of
its trigrams' weights, so texts of any length cost their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..operators.ranked import exact_quantile
from ..session import written
from .tokens import release, sliced, tidy, unused

#: Labelled rows per language that the machines are fitted on.
SAMPLE_PER_LANG = 500
#: Labels that are learned, those with the most labelled rows, as every pair has a machine.
MAX_LANGS = 64
UNDETERMINED = "und"
#: Trigram buckets as a power of two.
BUCKET_BITS = 13
#: Bytes of one text whose trigrams are counted at a time, and of texts scored at a time.
CHUNK_BYTES = 1 << 22
BATCH_BYTES = 1 << 20
SLOPE = 4.0

#: Families of languages by ISO 639-1 code; others are families of their own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nb", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def _lower_table() -> np.ndarray:
    """Bytes to bytes: ASCII letters folded, other ASCII to blanks, the rest kept."""
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalpha() else 32
    return table


LOWER = _lower_table()
LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every trigram of the texts, padded by blanks, and each text's range.

    Capitals of the Latin-1 range are folded as ASCII ones are.
    """
    raw = np.frombuffer(b"".join([b" %b " % t for t in texts]), np.uint8)
    low = LOWER[raw]
    latin = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1
    latin = latin[raw[latin] != 0x97]
    low[latin] += 0x20
    wide = low.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    code *= np.uint32(2654435761)
    code >>= np.uint32(32 - BUCKET_BITS)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 2)[:-1]))
    return code.astype(np.int64), starts, starts + sizes


def frequencies(text: bytes) -> np.ndarray:
    """Share of each trigram bucket in one text."""
    counts = np.zeros(1 << BUCKET_BITS)
    for at in range(0, max(1, len(text)), CHUNK_BYTES):
        code, starts, ends = trigrams([text[at : at + CHUNK_BYTES]])
        counts += np.bincount(code[starts[0] : ends[0]], minlength=len(counts))
    return counts / max(1.0, counts.sum())


#: A filled bucket and its share. Packed texts sort as their whole rows of shares do.
_FILLED = np.dtype([("bucket", ">u2"), ("share", "<f4")])


def packed(shares: np.ndarray) -> bytes:
    """The filled buckets of one text, few beside all."""
    x = shares.astype("<f4")
    at = np.flatnonzero(x)
    out = np.empty(len(at), _FILLED)
    out["bucket"], out["share"] = 0xFFFF - at, x[at]
    return out.tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """One row of shares per packed text."""
    x = np.zeros((len(rows), 1 << BUCKET_BITS), "<f4")
    for i, row in enumerate(rows):
        filled = np.frombuffer(row, _FILLED)
        x[i, 0xFFFF - filled["bucket"]] = filled["share"]
    return x


class Machine(NamedTuple):
    """A linear machine: positive margins speak for ``a``."""

    a: str
    b: str
    bias: float
    weights: np.ndarray


class Model(NamedTuple):
    langs: tuple[str, ...]
    machines: tuple[Machine, ...]


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised machine with squared hinge loss.

    Dual coordinate descent over rows of about unit length; the bias is the weight
    of a constant feature. ``y`` is 1 or -1.
    """
    w, bias, alpha = np.zeros(x.shape[1], x.dtype), 0.0, np.zeros(len(x))
    diag = np.einsum("ij,ij->i", x, x) + 1 + 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(x)):
            grad = y[i] * (float(w @ x[i]) + bias) - 1 + 0.5 * alpha[i] / cost
            step = max(alpha[i] - grad / diag[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += x.dtype.type(step * y[i]) * x[i]
                bias += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w, float(bias)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: ``crc32(doc_id as text) mod 4 = 2``; NULL ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from ``docs(doc_id, text, lang)``.

    Per language the rows with the smallest ``doc_id`` hashes are taken,
    ``sample_per_lang`` at most; held-out rows and rows without an id, a text or a
    label are not. The choice is made on narrow columns and limited per task before
    it is shuffled; repeated ids count once. The ``MAX_LANGS`` labels with the most rows
    are learned, of equally frequent ones the first by name.
    """
    spark = docs.sparkSession
    usable = docs.select("doc_id", "text", "lang", F.xxhash64("doc_id").alias("h")).where(
        F.col("doc_id").isNotNull()
        & F.col("text").isNotNull()
        & F.col("lang").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    by_hash = Window.partitionBy("lang").orderBy("h")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    frequent = [r.lang for r in counts.limit(MAX_LANGS).collect()]
    cuts = (
        usable.select("lang", "h")
        .where(F.col("lang").isin(frequent))
        .withColumn("n", F.row_number().over(by_hash))
        .where(F.col("n") <= sample_per_lang)
        .groupBy("lang")
        .agg(F.max("h").alias("last"))
        .collect()
    )
    langs = tuple(sorted(r.lang for r in cuts))
    pairs = _pairs(langs)
    if not pairs:
        return Model(langs, ())
    last = F.create_map(*[F.lit(x) for r in cuts for x in (r.lang, r.last)])

    def shares(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: packed(frequencies(t)))

    sample = (
        usable.where(F.col("h") <= last[F.col("lang")])
        .select("lang", "h", F.pandas_udf(shares, "binary")(F.col("text").cast("binary")).alias("x"))
        .groupBy("lang", "h")
        .agg(F.min("x").alias("x"))
    )
    roles = spark.createDataFrame(
        [(k, side, lang) for k, (_, _, a, b) in enumerate(pairs) for side, own in ((1, a), (-1, b)) for lang in own],
        "pair int, side int, lang string",
    )

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "h"])
        x = unpacked(rows.pop("x").tolist())
        scale = 1 / np.sqrt(np.einsum("ij,ij->j", x, x) / len(x) + np.float32(1e-9))
        x *= scale
        scale /= np.sqrt(np.einsum("ij,ij->i", x, x)).mean()
        x /= np.sqrt(np.einsum("ij,ij->i", x, x)).mean()
        w, bias = fit_machine(x, rows["side"].to_numpy())
        weights = (w * scale).astype("<f4").tobytes()
        del x
        release()
        return pd.DataFrame({"pair": [rows["pair"].iloc[0]], "bias": [bias], "weights": [weights]})

    fitted = (
        sample.join(F.broadcast(roles), "lang")
        .groupBy("pair")
        .applyInPandas(train, "pair int, bias double, weights binary")
        .collect()
    )
    return Model(
        langs,
        tuple(
            Machine(pairs[r.pair][0], pairs[r.pair][1], r.bias, np.frombuffer(r.weights, "<f4"))
            for r in sorted(fitted, key=lambda r: r.pair)
        ),
    )


def _pairs(langs: tuple[str, ...]) -> list[tuple[str, str, tuple, tuple]]:
    """Class names and member languages of every pair, of families and then within them."""
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family_of(lang), []).append(lang)
    found = [
        (f"family:{f}", f"family:{g}", tuple(families[f]), tuple(families[g]))
        for f, g in combinations(sorted(families), 2)
    ]
    for members in families.values():
        found += [(a, b, (a,), (b,)) for a, b in combinations(members, 2)]
    return found


def _margins(model: Model, texts: list[bytes]) -> np.ndarray:
    """Margin of every machine (columns) for every text (rows)."""
    out = np.zeros((len(texts), len(model.machines)))
    batch: list[int] = []
    held = 0

    def flush() -> None:
        code, starts, ends = trigrams([texts[i] for i in batch])
        bounds = np.minimum(np.stack((starts, ends), axis=1).ravel(), len(code))
        for k, m in enumerate(model.machines):
            sums = np.concatenate((m.weights[code], np.zeros(1, "<f4")))
            total = np.add.reduceat(sums, bounds, dtype=np.float64)[::2]
            total[ends == starts] = 0
            out[batch, k] = m.bias + total / np.maximum(ends - starts, 1)

    for i, text in enumerate(texts):
        if len(text) > CHUNK_BYTES:
            x = frequencies(text)
            out[i] = [m.bias + x @ m.weights for m in model.machines]
            continue
        batch.append(i)
        held += len(text)
        if held > BATCH_BYTES:
            flush()
            batch, held = [], 0
    if batch:
        flush()
    return out


def classify(model: Model, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each text that has a letter."""
    margins = np.clip(_margins(model, texts), -50, 50)
    sure = 1 / (1 + np.exp(-SLOPE * margins))
    families = sorted({family_of(x) for x in model.langs})
    index = {(m.a, m.b): k for k, m in enumerate(model.machines)}

    def win(names: list[str], prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
        votes = np.zeros((len(texts), len(names)))
        for i, j in combinations(range(len(names)), 2):
            k = index.get((prefix + names[i], prefix + names[j]))
            p = sure[:, k] if k is not None else 0.5
            votes[:, i] += p
            votes[:, j] += 1 - p
        votes /= max(1, len(names) - 1)
        if len(names) == 1:
            votes[:] = 1
        best = votes.argmax(axis=1)
        return best, votes[np.arange(len(texts)), best]

    family, p_family = win(families, "family:")
    names = np.full(len(texts), UNDETERMINED, object)
    score = np.zeros(len(texts))
    for f, own in enumerate(families):
        members = [x for x in model.langs if family_of(x) == own]
        best, p = win(members)
        rows = family == f
        names[rows] = np.array(members, object)[best[rows]]
        score[rows] = p_family[rows] * p[rows]
    return names.tolist(), score


def has_letter(text: bytes) -> bool:
    if LETTER[np.frombuffer(text, np.uint8)].any():
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    Texts that are NULL or have no letter are ``und`` with score 0, as is every
    text if nothing was learned. Repeated rows come out repeated. Columns of these
    names that ``docs`` has already are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    body = unused("text_bytes", docs.columns)
    source = docs.withColumn(body, F.col("text").cast("binary"))
    kept = docs.schema.fields
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches, body):
            texts = [t or b"" for t in batch.column(body).to_pylist()]
            known = [i for i, t in enumerate(texts) if t and has_letter(t)] if model.langs else []
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if known:
                names, sure = classify(model, [texts[i] for i in known])
                for i, name in zip(known, names, strict=True):
                    langs[i] = name
                scores[known] = sure
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name) for f in kept),
                    pa.array(langs, pa.string()),
                    pa.array(np.clip(scores, 0, 1), pa.float64()),
                ],
                schema.names,
            )

    return source.mapInArrow(tidy(run), schema)


class Limits(NamedTuple):
    """What a text must reach for its language to count as told."""

    score: float
    letters: float


def letter_share(text: Column) -> Column:
    """Share of letters among the characters that are no white space; NULL for texts without any."""
    solid = F.regexp_replace(text, r"\s", "")
    letters = F.length(F.regexp_replace(solid, r"\P{L}", ""))
    return letters / F.nullif(F.length(solid), F.lit(0))


def calibrate(docs: DataFrame, model: Model) -> Limits:
    """Half of what nearly all labelled rows reach that were not learned from.

    All held-out rows with a learned label are predicted; all but the lowest two in a
    thousand set the limits. Without such rows nothing is asked for.
    """
    labelled = docs.where(held_out(F.col("doc_id")) & F.col("lang").isin(list(model.langs)))
    found = predict(labelled.select("text"), model).where(F.col("lang_pred") != UNDETERMINED)
    reached = written(found.select("score", letter_share(F.col("text")).alias("letters")), "reached")
    low = {r.feature: r.quantile for r in exact_quantile(reached, ["score", "letters"], 0.002).collect()}
    return Limits(low.get("score", 0.0) / 2, low.get("letters", 0.0) / 2)


def told(docs: DataFrame, model: Model, limits: Limits) -> DataFrame:
    """The rows of :func:`predict` whose language can be told.

    Rejected are texts without a letter, with a score below the limit, or in which too few characters are letters.
    """
    found = predict(docs, model).where(F.col("lang_pred") != UNDETERMINED)
    return found.where((F.col("score") >= limits.score) & (letter_share(F.col("text")) >= limits.letters))
