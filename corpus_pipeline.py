"""From raw documents to packed sequences: five stages, each written and read by the next.

Each stage is judged on what it gets: the toxicity and language models are fitted on the stage's
own documents (and the labels in ``sf_dir``), duplicates are those among the documents left, and
the mix's targets are shares of the words left. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm import jaccard, langid, mixing, packing, toxicity
from lakeshore.session import materialize, ship_package, small_batches

#: A document is rejected from this toxicity score on.
TOXIC_FROM = 0.3
#: A document is rejected if it has no word, or its words' best languages are less sure on average.
LANGUAGE_LEAST = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    ship_package(spark)
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return toxicity.keep_below(docs, model, TOXIC_FROM)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters have languages that are sure to LANGUAGE_LEAST on average."""
    ship_package(spark)
    small_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs, F.lit(True)), LANGUAGE_LEAST)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one with the smallest id."""
    ship_package(spark)
    small_batches(spark)
    return jaccard.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    small_batches(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in the packed sequences."""
    ship_package(spark)
    small_batches(spark)
    return packing.pack(packing.token_pieces(docs))


STAGES = [("toxicity", drop_toxic), ("language", keep_known_language), ("near_duplicates", drop_near_duplicates),
          ("mix", mix_sources), ("pack", pack_sequences)]

#: Learned models and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; between two stages the rows are a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline_{name}")
    return docs
