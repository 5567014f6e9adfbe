"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    decontamination, embedding_dedup, html_text, language, licenses, near_dedup, packing, pii, secrets, token_store,
    toxicity, vector_codes, whitening,
)
from wattline.llm.tables import held_out, load
from wattline.session import fresh_dir

ORACLES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op5_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


@query
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "token-store")
    token_store.write(load(spark, sf_dir, "documents"), out)
    return token_store.digests(spark, out).withColumnRenamed("key", "doc_id")


@query
def op9_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(load(spark, sf_dir, "documents")))
    return packed.drop("ids").withColumnRenamed("id", "doc_id")


@query
def op1_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("key").withColumnRenamed("id", "doc_id")


@query
def op6_language_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept)


@query
def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(load(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *(F.expr(f"bigint(size(filter(base, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
        F.col("live").alias("n_live"),
        F.col("copied").alias("n_copied"),
    )


ORACLES["op3_secret_ownership"] = secrets.ORACLE_SQL


@query
def op8_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


ORACLES["op8_license_windows"] = licenses.ORACLE_SQL


@query
def op10_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select(
        F.col("id").alias("doc_id"),
        *(F.expr(f"bigint(size(filter(base, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@query
def op4_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    network = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    found = toxicity.score_documents(docs, network)
    return found.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op11_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op12_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op13_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(load(spark, sf_dir, "pages"))
    return found.withColumnRenamed("id", "page_id")
