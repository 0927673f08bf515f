"""The corpus pipeline: language ID, near-dedup, secret redaction, mixing, packing.

``STAGES`` is a list of (name, function); a function takes (spark, docs, sf_dir)
and returns the DataFrame that the next stage gets as ``docs`` after it was
written as Parquet and read back.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feescope.llm import language_id, mixing, packing, secret_scan, simhash_dedup
from feescope.llm.common import table
from feescope.session import release_scratch, scratch_path, scratch_paths

#: Only texts without letters are rejected: how much of a profile a short text shares depends on its alphabet.
MIN_LANGUAGE_SCORE = 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the language of each text, of those of the labelled rows, into ``lang``; reject texts without letters.

    The mixing stage reads it. A text that shares nothing with any language keeps its row's own value.
    """
    return language_id.keep_identified(docs, language_id.train_profiles(docs), MIN_LANGUAGE_SCORE, write="lang")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group."""
    return simhash_dedup.simhash_dedup(docs, words_per_shingle=3, max_bits=2)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; no document goes."""
    return secret_scan.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their target weights.

    Which of a source's documents come first depends on their words against the usual ones of the identified language.
    """
    return mixing.mix_documents(docs, lang="lang")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences: one row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", near_dedup),
    ("secret_scan", scan_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Fingerprints, n-gram ranks and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder.

    What a stage leaves there besides its result goes when the result is written,
    and so does the result that it read.
    """
    docs = table(spark, sf_dir, "documents")
    others = scratch_paths(spark)  # of other queries
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        release_scratch(spark, keep=[*others, path])
    return docs
