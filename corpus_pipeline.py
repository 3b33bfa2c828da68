"""From raw documents to a mix: language ID, exact dedup, n-gram Jaccard join, benchmark decontamination, source mixing.

Every stage reads whole texts, judges each row by its own text and returns the columns of its input, whatever other names
they have. Nulls in other columns than the text are values like others; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricmart.llm import decontaminate, exact_dedup, language, mixing, ngram_join
from metricmart.llm.common import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay. The network learns from the labelled documents themselves.

    Null and empty texts and texts without a letter go; so do texts of which no language has a share of 0.3. Repeated rows
    fare alike. Without any labelled text nothing is learned and everything stays.
    """
    Scratch(spark)
    return language.keep_identified(docs, language.learn(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts stays: the one with the largest doc_id.

    Null and empty texts are identical, a null id is smaller than any other, and of repeated rows one stays.
    """
    return exact_dedup.drop_exact(docs, Scratch(spark))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays.

    Texts without words and rows without an id are nobody's near duplicates and stay. Of rows that share an id, only those go
    whose own text has another survivor.
    """
    return ngram_join.keep_one(docs, Scratch(spark))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, exactly or nearly, go.

    Short items count where they are a whole line or document. Null and empty texts hold nothing; rows that share an id, or
    have none, are judged one by one; an empty benchmark leaves everything.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Texts without words weigh nothing and are not taken; a null source is a source, the last; rows alike in id, source and
    text are taken alike.
    """
    return mixing.mix(docs, Scratch(spark))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", deduplicate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("source_mix", mix_sources),
]

# Training, fuzzy search and random rounding: the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
