"""Registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.llm import (
    chat, codes, ctw, fingerprints, language, mixing, neardup, packing, quality, search, toxicity, vectors, wrappers,
)
from retailmarts.llm.common import Scratch, read, word_count

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, Scratch(spark, "quality")).drop("boilerplate")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", language.remainder("doc_id", 4) == 2)
    profiles = language.learn(docs.where("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


def op7_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return chat.render(conversations, chat.collapse(conversations))


def op2_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"), Scratch(spark, "wrappers"))


def op3_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(read(spark, sf_dir, "embeddings"), Scratch(spark, "vectors")).drop("row")
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("mark")
    )
    mixed = mixing.mix(docs, Scratch(spark, "mix"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, Scratch(spark, "packing"), keep_ids=False).drop("ids", "boundary")


def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read(spark, sf_dir, "documents"), Scratch(spark, "ctw"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = neardup.near_duplicates(docs, Scratch(spark, "neardup")).drop("row", "text_hash")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.judge(docs, toxicity.train(docs, labels, Scratch(spark, "toxicity")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return search.rank_documents(docs, items, Scratch(spark, "search"))


def op12_integer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"), Scratch(spark, "codes"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.judge(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_frequency, op2_wrappers, op3_vector_graph, op4_source_mix, op5_packing, op6_language, op7_chat_snapshots,
    op8_context_tree, op9_near_duplicates, op10_toxicity, op11_ranked_search, op12_integer_codes, op13_fingerprints,
)}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_frequency": quality.ORACLE, "op7_chat_snapshots": chat.ORACLE, "op11_ranked_search": search.ORACLE,
        "op12_integer_codes": codes.ORACLE,
    }
