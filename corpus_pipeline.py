"""Corpus cleaning: language, near copies, benchmark leaks, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run``
writes a stage's rows to the shared folder and hands them to the next. All stages
but the last return the columns of ``documents``.

The stages cannot be said in SQL (trained models, hashes that SQL lacks), so there
is none; ``tests/llm`` holds them against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwing.llm import bpe, decontaminate, langid, pii, simhash
from ledgerwing.llm.queries import tokenizer_path
from ledgerwing.session import drop_folders, recorded, small_batches, written

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told; ``lang`` becomes the predicted one.

    Texts that are NULL, have no letter, hardly any letters, or a score far below that of
    labelled rows go. Repeated rows stay repeated. Without any labelled row nothing can be
    predicted, and every text with a letter stays as it is; no rows give no rows.
    """
    small_batches(spark)
    model = langid.fit(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = langid.told(docs, model, langid.calibrate(docs, model))
    return told.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints of three-word shingles differ in 2 bits or fewer.

    The smallest ``doc_id`` stays, rows without an id come last; one of equal rows stays.
    NULL and word-free texts are one group; no rows give no rows.
    """
    small_batches(spark)
    return simhash.keep_one_of_each(docs, shingle=3, radius=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a passage of the benchmark.

    NULL and empty texts and items have none. Repeated rows stay or go together.
    """
    small_batches(spark)
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with personal data replaced by its kind; ``n_chars`` follows the text.

    NULL texts stay NULL, empty ones empty, repeated rows repeated.
    """
    small_batches(spark)
    clean = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text decoded from them.

    A NULL text has no tokens; repeated rows come out repeated.
    """
    small_batches(spark)
    path = tokenizer_path()
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("personal data", redact_personal_data),
    ("tokenization", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``.

    Each stage's rows are written before the next begins; what it kept in the shared
    folder on the way, and the rows it was given, are deleted then.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with recorded() as made:
            found = stage(spark, docs, sf_dir)
        with recorded() as kept:
            docs = written(found, f"stage-{name.replace(' ', '-')}")
        drop_folders(spark, [*made, *before])
        before = kept
    return docs
