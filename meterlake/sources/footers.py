"""Row counts from the footers of Parquet files.

Spark's V2 Parquet reader answers COUNT from the footers, also by partition
column, without reading a data page. That reader and its aggregate pushdown are
settings of a session, so the counts run in a session of their own that shares the
context; the caller's session keeps its settings.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.sources.bronze import parquet_profile, read_bronze


def _reader(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1 if x.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def counted_rows(spark: SparkSession, uri: str, key: str, days: list[date]) -> DataFrame:
    """(key, row_count) of each day partition in the span of ``days``; days without files have no row."""
    # no column but the partition key is asked for, so the schema is that key alone
    files = _reader(spark).read.schema(T.StructType([T.StructField("any", T.LongType()), T.StructField(key, T.DateType())])).parquet(uri)
    span = F.col(key).between(F.lit(str(days[0])).cast("date"), F.lit(str(days[-1])).cast("date"))
    return files.where(span).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def rows_by_day(spark: SparkSession, uri: str, key: str, days: list[date]) -> dict[date, int]:
    """Rows of each stored day of the span: a row a day."""
    return {r[key]: r["row_count"] for r in counted_rows(spark, uri, key, days).collect()}


def row_count(spark: SparkSession, uri: str) -> int:
    """Rows of all files under a folder."""
    return _reader(spark).read.schema("any long").parquet(uri).agg(F.count(F.lit(1))).first()[0]


def file_profile(spark: SparkSession, uri: str) -> DataFrame:
    """Rows, files and bytes of a Bronze folder from footers and the listing, with the reading-time range from a scan of that column.

    Timestamps are not pushed down, so their range stays a narrow scan.
    """
    bronze = read_bronze(spark, uri)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(uri)
    files = listed.select("_metadata.file_size").agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("bytes")).first()
    times = parquet_profile(bronze).drop("row_count")
    return times.select(
        F.lit(row_count(spark, uri)).cast("bigint").alias("row_count"),
        F.lit(files["n"]).cast("bigint").alias("files"),
        F.lit(files["bytes"] or 0).cast("bigint").alias("bytes"),
        *times.columns,
    )
