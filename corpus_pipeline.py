"""The corpus pipeline over ``documents``: five stages, each applying one operator to all that is left.

Toxic documents go, then those in no known language, then all but one of each group of near duplicates;
the rest is mixed to the target weights of its sources and packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retailmarts.llm import language, mixing, neardup, packing, toxicity
from retailmarts.llm.common import Scratch, prepare, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text whose best language agrees less than this is in none.  Even one word of a language agrees more.
LEAST_AGREEMENT = 0.2
#: Per cent of shared shingles from which documents are duplicates.
SIMILAR = 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: rejects the documents that the classifier chain, trained on ``labels``, calls toxic."""
    scratch = Scratch(prepare(spark), "toxic")
    chain = toxicity.train(docs, read(spark, sf_dir, "labels"), scratch)
    return toxicity.accept(docs, chain)


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: rejects texts without a letter and those unlike every language."""
    prepare(spark)
    return language.accept(docs, language.learn(docs), LEAST_AGREEMENT)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group of near duplicates stays."""
    return neardup.keep_one(docs, Scratch(prepare(spark), "neardup"), SIMILAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each pass over a document, with the text that the mix takes."""
    mixed = mixing.mix(docs, Scratch(prepare(spark), "mix"))
    return mixing.mixed_texts(mixed, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents in their sequences, ids included."""
    return packing.pack(docs, Scratch(prepare(spark), "pack"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: No SQL: learned rejections and tokenisation cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    tables = Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = tables.save(stage(spark, docs, sf_dir))
    return docs
