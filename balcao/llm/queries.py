"""The registered queries of this subpackage: each operator over its whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm import (
    decontaminate,
    extract,
    jaccard,
    language,
    licenses,
    likelihood,
    mixing,
    neighbours,
    quality,
    repair,
    toxicity,
    variants,
    whitening,
)
from balcao.llm.tables import fold, given


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = language.train(documents.filter(~held_out))
    predict = language.predictor(model, spark)
    return documents.select("doc_id", held_out.alias("held_out"), predict(F.col("text")).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def op2_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return likelihood.scored(given(spark, folder, "documents"), fold("doc_id", 7) == 2)


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned_licenses(given(spark, folder, "documents"))


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents")
    return jaccard.linked(documents, k=4, least=85).select("doc_id", "n_shingles", "component_id")


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = given(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def op6_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.pages_text(given(spark, folder, "pages"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = given(spark, folder, "documents").select("doc_id", "text"), given(spark, folder, "labels")
    held_out = fold("doc_id", 3) == 1
    model = quality.train(documents.filter(~held_out), labels.filter(~held_out))
    score = quality.QualityColumn(model, spark)
    return _scored(documents, held_out, score(F.col("text")))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = given(spark, folder, "documents").select("doc_id", "text"), given(spark, folder, "labels")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.train(documents.filter(~held_out), labels.filter(~held_out))
    score = toxicity.ToxicityColumn(model, spark)
    return _scored(documents, held_out, score(F.col("text")))


def _scored(documents: DataFrame, held_out, score) -> DataFrame:
    scored = documents.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(given(spark, folder, "documents"))


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = given(spark, folder, "conversations")
    return repair.every_conversation(turns, repair.repair(repair.damaged(turns)))


def op12_whiten(spark: SparkSession, folder: str) -> DataFrame:
    vectors = given(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return whitening.whitened(vectors)


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return variants.linked(given(spark, folder, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_language,
        op2_likelihood,
        op3_licenses,
        op4_jaccard,
        op5_neighbours,
        op6_extract,
        op7_decontaminate,
        op8_quality,
        op9_toxicity,
        op10_mix,
        op11_repair,
        op12_whiten,
        op13_simhash,
    )
}
