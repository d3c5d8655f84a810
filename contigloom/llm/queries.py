"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.llm import decontam, fair_mix, kd_shards, licenses, near_dedup, token_counts, token_files, toxicity, voronoi_knn, wrappers
from contigloom.runtime import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), scratch(spark, "tokens"), _tokenizer("word_bpe_49k.json"))
    return token_files.read_digests(manifest)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score_texts(docs, model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(_table(spark, sf_dir, "documents"), shards=40)


def op6_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mixed_sizes(_table(spark, sf_dir, "documents"))


def op7_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_k(_table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_main_text": op4_main_text,
    "op5_kd_shards": op5_kd_shards,
    "op6_fair_mix": op6_fair_mix,
    "op7_voronoi_knn": op7_voronoi_knn,
    "op8_token_counts": op8_token_counts,
    "op9_near_dedup": op9_near_dedup,
    "op10_decontamination": op10_decontamination,
}
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.ORACLE,
    "op6_fair_mix": fair_mix.ORACLE,
    "op7_voronoi_knn": voronoi_knn.ORACLE,
    "op9_near_dedup": near_dedup.ORACLE,
}
