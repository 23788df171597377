"""A training corpus from raw documents: five stages over the operators of ``balcao.llm``.

Each stage takes all that its predecessor kept, and its decisions take effect. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm import decontaminate, jaccard, language, mixing, quality
from balcao.llm.tables import given
from balcao.sources.scratch import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a language that the corpus names; texts without letters go."""
    found = language.predictor(language.train(docs), spark)(F.col("text"))
    return docs.filter((found["lang_pred"] != language.UNDETERMINED) & (found["score"] >= 0.5))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that are at least as likely good as not."""
    model = quality.train(docs, given(spark, sf_dir, "labels"))
    return docs.filter(quality.QualityColumn(model, spark)(F.col("text")) >= 0.5)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (five words, 0.8)."""
    return jaccard.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, given(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes."""
    return mixing.mixed(docs)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("mix", mixture),
]

#: Trained models decide in the first two stages, so SQL cannot state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
