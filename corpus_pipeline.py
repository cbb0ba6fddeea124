"""A training corpus from ``documents`` in five stages, each of which reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language, neardup, packing, pii, toxicity
from tessera.llm.common import settle
from tessera.session import prepare

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A predicted language of less certainty than this is a rejection.
CERTAIN = 0.4


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, by the nearest labelled ones, stays below the limit."""
    docs = docs.select(*DOCUMENTS)
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, index).filter(F.col("toxicity") < toxicity.REJECT).select(*DOCUMENTS)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: texts without letters and texts that fit none of the languages go."""
    docs = docs.select(*DOCUMENTS)
    told = language.predict(docs, language.fit(docs), floor=language.FITS)
    return told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= CERTAIN)).select(*DOCUMENTS)


def without_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return neardup.without_duplicates(docs.select(*DOCUMENTS), size=5, similarity=0.8)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets in them replaced by pseudonyms."""
    masked = pii.pseudonyms(docs.select(*DOCUMENTS))
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*DOCUMENTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs.select(*DOCUMENTS))


STAGES = [
    ("toxicity", without_toxic),
    ("language", with_language),
    ("near_duplicates", without_duplicates),
    ("pii", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over ``documents`` of a folder."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models, tokenizers and keyed permutations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
