"""A corpus pipeline: language, near-duplicates, benchmark leaks, secrets, packing.

Every stage works on all rows the stage before it kept and is written as
Parquet before the next one reads it.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablescope.llm import containment, credentials, langid, packing, simhash
from tablescope.llm.common import Scratch, fresh, table

LEAST_SCORE = 0.4  # share of a text's n-grams that its language has to contain

ORACLE_SQL = None  # the stages are trained, hashed and tokenised; the tests compare them with plain Python


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows; rows in no known language go, also null texts and texts without letters."""
    lang, score = fresh(docs, "_lang", "_score")
    told = langid.predict(docs, langid.fit(docs), "text", lang, score)
    return told.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return containment.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, ``n_chars`` follows the text."""
    out = credentials.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, first-fit decreasing."""
    from public_tokenizers import path

    parts = packing.pieces(docs, path("word_bpe_49k.json"))
    return packing.pack(parts).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
