"""From raw documents to a training mix: five filtering stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import decontaminate, jaccard, language, mixing, toxicity
from tracklane.llm.common import stored, table
from tracklane.llm.queries import language_model, toxicity_model


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with the calibrated confidence; texts that are null or without letters go."""
    model = language_model(docs.select("doc_id", "text", "lang"))
    return docs.where(~language.identify(docs["text"], model, docs)["rejected"])


def keep_clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely clean than toxic."""
    model = toxicity_model(spark, sf_dir, docs.select("doc_id", "text"))
    return docs.where(toxicity.toxicity(docs["text"], model, docs) < 0.5)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similar ones. Rows that share an id stay together, or one of
    equal rows stays; documents without id or words are no group and stay."""
    groups = stored(jaccard.join_similar(docs.select("doc_id", "text")), "groups")
    gone = groups.where("component_id IS NOT NULL AND doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
    # Rows with one id: those that repeat an id are few; only they are compared.
    again = groups.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_again"))
    return kept if again.isEmpty() else _first_of_equal(kept, stored(again, "again"))


def _first_of_equal(docs: DataFrame, again: DataFrame) -> DataFrame:
    rest = docs.join(again, docs["doc_id"] == F.col("_again"), "left_anti")
    repeated = docs.join(again, docs["doc_id"] == F.col("_again"), "left_semi")
    return rest.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often every remaining document is taken; documents that are not taken are left out."""
    mixed = mixing.mix_sources(docs.select("doc_id", "text", "source"))
    return mixed.where("copies > 0").select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("toxicity", keep_clean_speech),
    ("near_duplicates", keep_one_of_similar),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_by_weight),
]
#: Trained models and random draws have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
