"""Incremental trigger for the daily transform.

The batch jobs are the engine; this module only decides *when* and *which
days* to run. A file stream over the Bronze folder sees new parquet files;
for each micro-batch the days it touched (as contiguous spans) are re-run with
:func:`meterlake.plans.jobs.backfill_range` (all-history baseline, whole-day
overwrites), so late readings replace their days idempotently. The stream
checkpoint has a fixed place under the warehouse, so a restarted driver
resumes after the last processed file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.config import PipelineConfig
from meterlake.schemas import BRONZE
from meterlake.session import ensure_utc


def touched_days(batch: DataFrame) -> list[tuple]:
    """Contiguous (first, last) day spans touched by a micro-batch.

    Only the distinct reading dates come back to the driver (at most one row
    per day), already folded into spans by a window over those few dates.
    """
    d = F.to_date("data_collection_log_timestamp")
    days = batch.select(d.alias("d")).where(F.col("d").isNotNull()).distinct()
    # consecutive days share (day - its position in date order)
    span_key = F.date_sub(F.col("d"), F.row_number().over(Window.orderBy("d")))
    spans = days.withColumn("k", span_key).groupBy("k").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return [(r["lo"], r["hi"]) for r in spans.orderBy("lo").collect()]


def start_incremental_transform(
    spark: SparkSession,
    cfg: PipelineConfig,
    *,
    checkpoint_uri: str | None = None,
    available_now: bool = True,
    processing_time: str = "10 minutes",
) -> StreamingQuery:
    """Watch ``cfg.source_uri`` for new Bronze files and re-run the days they touch."""
    from meterlake.plans.jobs import backfill_range
    from meterlake.sources.bronze import read_bronze

    ensure_utc(spark)
    stream = spark.readStream.schema(BRONZE).parquet(cfg.source_uri).select("data_collection_log_timestamp")

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        for lo, hi in touched_days(batch):
            backfill_range(spark, cfg, lo, hi, bronze=read_bronze(spark, cfg.source_uri))

    writer = stream.writeStream.foreachBatch(run_batch).option(
        "checkpointLocation", checkpoint_uri or f"{cfg.warehouse_uri.rstrip('/')}/meta/stream_checkpoint"
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
