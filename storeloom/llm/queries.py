"""One query per operator, over whole tables. Each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import (
    chat,
    decontamination,
    jaccard_join,
    language_id,
    lattice,
    max_sketch,
    mixing,
    neighbours,
    recompression,
    secrets,
    threshold,
    toxicity,
    warc,
)
from storeloom.llm.frames import fold, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words a mix of one and a half times the corpus takes of every document."""
    found = mixing.mix(read(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "position")


@query
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are 85 % alike."""
    return jaccard_join.jaccard_components(read(spark, folder, "documents"), words=4, percent=85)


@query
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: plain patterns, and literals under sensitive names."""
    return secrets.scan(read(spark, folder, "documents"))


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three folds of four."""
    docs = read(spark, folder, "documents")
    found = language_id.identify(docs, fold("doc_id", 4) != 2)
    return found.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a ten-word window of a test item."""
    found = decontamination.scan(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth id."""
    vectors = read(spark, folder, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op2_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    """Likelihood of every document, learned from six folds of seven."""
    found = lattice.score(read(spark, folder, "documents"), fold("doc_id", 7) != 2)
    held = (fold("doc_id", 7) == 2).alias("held_out")
    return found.select("doc_id", held, *found.columns[1:])


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from three folds of four."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    found = toxicity.score(docs, labels, fold("doc_id", 4) != 2)
    return found.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"),
    )


@query
def op7_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back through the capture index."""
    return warc.archived(read(spark, folder, "pages"), least=1000)


@query
def op5_perspective_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every dialogue, whole, from the perspective of each of its participants."""
    found = chat.perspectives(read(spark, folder, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select(
        "conv_id",
        "part",
        "speaker",
        "n_turns",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.array_join(spans, ",").alias("mask"),
    )


@query
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words of thirteen-word windows that start in an earlier one."""
    found = recompression.without_repeats(read(spark, folder, "documents"), size=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every test item."""
    docs, items = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return max_sketch.search(docs, items, k=10)


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, some of whose labels are moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, folder, "embeddings").withColumn("label", moved)
    return threshold.mine(vectors, F.col("vec_id") % 50 == 0)
