"""A training-corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir), works on all the rows it is given and returns
the rows it keeps; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.llm import decontaminate, icws, langid_crf, segment, suffix_dedup
from wayloom.llm.storage import checkpoint

#: A document goes in which no language has so much of the words, as do documents without a letter.
LEAST_LANGUAGE_SHARE = 0.2
WIDTH = 50
WINDOW = 10
SAMPLES = 2


def _sized(docs: DataFrame) -> DataFrame:
    """docs with n_chars, if there is such a column, of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; a missing language is filled in."""
    found = langid_crf.identify(docs, langid_crf.train(docs))
    kept = found.where((F.col("lang_pred") != langid_crf.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id, of each group of near copies."""
    return icws.dedupe(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings of documents with smaller ids."""
    return _sized(suffix_dedup.dedupe(docs, width=WIDTH))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those that are mostly benchmark go."""
    return _sized(decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=WINDOW))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document, and whether they decode to its text."""
    import public_tokenizers

    return segment.digests(docs, public_tokenizers.path("piece_bpe_32k.model"), k=SAMPLES)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("segmentation", segmentation),
]

#: Sampling, weighted hashing and the trained language model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
