"""Stored moments of Bronze by file, and the ledger of the files they are of.

Each version of a Bronze file (path, size, modification time) has its own rows of
exact, mergeable moments. A run lists the files, reads those whose version the
ledger lacks, and merges the moments of the versions that Bronze has now. So a
file that was changed, replaced or deleted is taken back by itself, whatever its
rows, and no other file is read again.

Moments are appended in batches, and a version counts once the ledger names its
batch: what a failed run left behind is never merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.config import PipelineConfig
from meterlake.operators.quality import baseline_from_moments, feeder_moments
from meterlake.schemas import FILE_LEDGER, MOMENTS
from meterlake.session import scratch_path
from meterlake.sinks.writers import folder_exists, partition_path, remove_folder
from meterlake.sources.bronze import read_bronze

#: Up to so many files are read by their paths; more of them by a scan that keeps their rows.
MOST_PATHS = 10_000

_FILE = ["file_path", "file_size", "file_modification_time"]


def _version():
    return F.sha2(F.concat_ws("|", "file_path", F.col("file_size").cast("string"), F.unix_micros("file_modification_time").cast("string")), 256)


def bronze_files(bronze: DataFrame) -> DataFrame:
    """(version, file_path, file_size, file_modification_time) of the files that Bronze reads, from a listing; no file is opened."""
    paths = [unquote(p) for p in bronze.inputFiles()]
    if not paths:
        raise ValueError("stored moments need a Bronze that is read from files")
    listed = bronze.sparkSession.read.format("binaryFile").load(paths)
    return listed.select(*[f"_metadata.{c}" for c in _FILE]).select(_version().alias("version"), *_FILE)


def _ledger(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    if not folder_exists(spark, cfg.ledger_uri):
        return spark.createDataFrame([], FILE_LEDGER)
    return spark.read.schema(FILE_LEDGER).parquet(cfg.ledger_uri)


def _add(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame, from_source: bool, missing: DataFrame) -> str:
    """Store the moments of the missing versions as one batch, checked against the listing; the ledger is the caller's."""
    batch = uuid.uuid4().hex
    found = missing.select("file_path").take(MOST_PATHS + 1)
    paths = [r["file_path"] for r in found]
    if len(paths) > MOST_PATHS:
        rows = bronze.select("*", *[F.col(f"_metadata.{c}").alias(c) for c in _FILE]).join(missing.select("file_path"), "file_path", "left_semi")
    else:
        source = read_bronze(spark, [unquote(p) for p in paths]) if from_source else bronze
        rows = source.select("*", *[F.col(f"_metadata.{c}").alias(c) for c in _FILE]).where(F.col("file_path").isin(paths))
    moments = feeder_moments(rows, _version().alias("version"))
    path = partition_path(cfg.moments_uri, "batch", batch)
    moments.hint("rebalance").write.parquet(path)
    read = spark.read.schema(moments.schema).parquet(path).select("version").distinct()
    strangers = read.join(missing, "version", "left_anti").count()
    now = bronze_files(bronze)
    gone = missing.join(now, "version", "left_anti").count()
    if strangers or gone:
        remove_folder(spark, path)
        raise ValueError(f"Bronze files changed while they were read ({max(strangers, gone)}); run again")
    return batch


def rebuild_moments(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None) -> None:
    """Store the moments of all Bronze files anew as one batch, and drop what was stored before."""
    source = bronze if bronze is not None else read_bronze(spark, cfg.source_uri)
    files = _stored(bronze_files(source), "bronze-files")
    batch = _add(spark, cfg, source, bronze is None, files)
    files.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(cfg.ledger_uri)
    from meterlake.sinks.writers import partition_days

    for old in partition_days(spark, cfg.moments_uri, "batch"):
        if old != batch:
            remove_folder(spark, partition_path(cfg.moments_uri, "batch", old))
    remove_folder(spark, files.scratch)


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


@contextmanager
def stored_baseline(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None) -> Iterator[DataFrame]:
    """The baseline of all rows that Bronze has now, merged from the stored moments of its files.

    Versions that the ledger lacks are read first. ``bronze`` must hold all rows of its
    files; without it the files at the source are read, those that are new by their paths.
    The merged baseline is kept under the shared folder until the block ends.
    """
    source = bronze if bronze is not None else read_bronze(spark, cfg.source_uri)
    files = _stored(bronze_files(source), "bronze-files")
    scratch = [files.scratch]
    try:
        missing = files.join(_ledger(spark, cfg).select("version"), "version", "left_anti")
        if not missing.isEmpty():
            missing = _stored(missing, "new-files")
            scratch.append(missing.scratch)
            batch = _add(spark, cfg, source, bronze is None, missing)
            missing.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("append").parquet(cfg.ledger_uri)
        # a version that two runs stored at the same time is taken from one batch
        present = _ledger(spark, cfg).join(files.select("version"), "version", "left_semi")
        present = present.groupBy("version").agg(F.max("batch").alias("batch"))
        moments = spark.read.schema(MOMENTS).parquet(cfg.moments_uri)
        baseline = _stored(baseline_from_moments(moments.join(present, ["version", "batch"], "left_semi")), "baseline")
        scratch.append(baseline.scratch)
        yield baseline
    finally:
        for path in scratch:
            remove_folder(spark, path)
