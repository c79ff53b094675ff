"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Quality classifier (junk goes), n-gram Jaccard join (one document of each group
stays), benchmark decontamination (documents with a test item go), secret scan
(secrets in the text are replaced), mixing of sources (documents with their copies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, mixing, ngram_join, quality_model, secrets
from meterlake.llm.shared import fresh, materialize, rows_of


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality model scores 0.5 or more; it learns from labelled rows that are not held out."""
    labels = rows_of(spark, sf_dir, "labels")
    model = quality_model.train(docs, labels.where(~quality_model.held_out(labels["doc_id"])))
    return quality_model.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts: the one of the smallest id."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a test item is found. Equal texts share the decision, which is made by text."""
    mark = fresh(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    leaks = decontaminate.find_leaks(marked, rows_of(spark, sf_dir, "benchmark"), id_col=mark)
    leaks = leaks.select(F.col("doc_id").alias(fresh(marked, "leak"))).distinct()
    return marked.join(leaks, marked[mark] == leaks[leaks.columns[0]], "left_anti").drop(mark)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in the texts; no document goes. n_chars follows the text."""
    return secrets.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the column ``copies``."""
    return mixing.with_copies(docs)


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", hide_secrets),
    ("mixing sources", mix),
]

#: The stages learn, iterate and align, which SQL cannot say; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
