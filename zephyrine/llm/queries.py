"""Registered queries of the operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.llm import (
    chunk_dedup,
    decontaminate,
    embedding_dedup,
    factorisation,
    line_dedup,
    outliers,
    ranked_search,
    sentencepiece,
    sharding,
    simhash,
    sql,
    toxicity,
    url_filter,
    whitening,
)
from zephyrine.llm.common import ORACLES, QUERIES, fold, query, table  # noqa: F401


def _judged(scored: DataFrame, parts: int, held_out: int, limit: float) -> DataFrame:
    held = F.coalesce(fold("doc_id", parts) == held_out, F.lit(False))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        F.when(F.col("score") >= limit, 1).otherwise(0).alias("predicted"),
    )


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(toxicity.training_fold())
    return _judged(toxicity.score(docs, toxicity.fit(docs, labels)), 5, 0, 0.5)


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_and_check(
        table(spark, sf_dir, "documents"), sentencepiece.load_pieces()
    )


@query("op3_kd_tree_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), leaves=24)


@query("op4_line_dedup", sql.LINES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op5_chunk_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.copied_spans(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op6_url_aliases", sql.ALIASES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op7_simhash_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query("op8_decontaminate", sql.DECONTAMINATE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("text_hash")


@query("op9_outliers")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


@query("op10_factorisation_machine")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    machine = factorisation.fit(docs, labels.filter(factorisation.training_fold()))
    return _judged(factorisation.score(docs, machine), 4, 2, 0.7)


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.fixed_point(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(vectors, components=8)
    error = whitening.identity_error(whitening.whiten(vectors, model), model)
    sums = F.array(*[F.lit(s) for s in model.sums]).cast("array<bigint>")
    away = F.zip_with("x", sums, lambda x, s: F.lit(model.n).cast("bigint") * x - s)
    deviation = F.aggregate(away, F.lit(0).cast("bigint"), lambda total, a: total + a * a)
    told = whitening.whiten(vectors.withColumn("deviation", deviation), model, ["vec_id", "deviation"])
    explained = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    rows = told.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query("op12_embedding_near_duplicates")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op13_ranked_search", sql.RANKED)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
