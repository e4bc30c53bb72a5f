"""A corpus from documents to a training mix, stage by stage over the operators of the package.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows
that go on. Each stage but the last returns the columns of ``documents``:

- ``language``: documents without a letter, mostly in scripts that are not those of a label, or whose
  language is told hardly better than by even odds, or less surely than half the least sure right
  answer on held-out rows, go;
- ``near_duplicates``: one document, that of the smallest id, stays of each group of documents
  whose sets of five-word shingles are 80 % alike;
- ``decontamination``: documents that hold a ten-word window of a test item go;
- ``secrets``: secrets are masked in the text, and ``n_chars`` follows; no document goes;
- ``mixing``: a row per copy that the mix takes, with its training position.

Nulls: a document without text has no letter and goes in the first stage. One without ``doc_id``
passes the first four stages and is not mixed. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import decontamination, jaccard_join, language_id, mixing, secrets
from storeloom.llm.frames import bound_batches, read, settled


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = language_id.fit(docs.select("doc_id", "text", F.col("lang").alias("label")))
    return language_id.told(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_component(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return secrets.masked_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_copies(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

# SQL can't fit a classifier, so the rows are compared with a brute-force version in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what the one before it wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
