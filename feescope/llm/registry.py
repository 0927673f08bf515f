"""The corpus operators as queries ``opN_<name>``, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feescope.llm import (
    ann_search, bpe_reuse, hnsw_dedup, html_extract, language_id, mixing, oracles, packing, periodic_runs,
    secret_scan, simhash_dedup, token_alignment, toxicity, warc,
)
from feescope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    profiles = language_id.train_profiles(docs.where(~held_out))
    return language_id.predict_languages(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_main_text(pages, html_extract.train(pages))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = toxicity.train(docs.where(~held_out), labels.where(~held_out))
    return toxicity.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann_search.nearest_neighbours(vectors.where("vec_id % 100 = 0"), vectors, k=10)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encode_documents(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_html_extraction, op3_toxicity, op4_secret_scan, op5_warc, op6_source_mixing,
    op7_nearest_neighbours, op8_embedding_dedup, op9_simhash_dedup, op10_packing,
    op11_token_alignment, op12_bpe_reuse, op13_periodic_runs)}

ORACLES: dict[str, str] = {
    "op5_warc": oracles.WARC,
    "op6_source_mixing": oracles.mixing(),
    "op7_nearest_neighbours": oracles.NEAREST,
    "op8_embedding_dedup": oracles.DUPLICATES,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
