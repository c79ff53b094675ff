"""Small helpers shared by the operators: scratch tables, bounded bitmaps, rank of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.session import scratch_path

#: Arrow output is handed over in pieces of about this many bytes.
OUT_BYTES = 4_000_000
#: Spark's setting that removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id (long) and the text (string) alone, so that other columns can have any name."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write to a fresh folder under spark.checkpoint.dir and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write go with its end: nothing reads them again. ``by`` is a
    column whose values have a folder each, which release() can remove alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path  # for release()
    return out


def release(*dfs: DataFrame, part: str = "") -> None:
    """Remove scratch tables, or one folder of them, that no later result reads."""
    for df in dfs:
        path = getattr(df, "scratch", None)
        if path:
            jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{part}" if part else path)
            folder.getFileSystem(jsc.hadoopConfiguration()).delete(folder, True)


def commonest(df: DataFrame, count: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows with the largest counts, ``most`` at most, and all others.

    The cut is at a step of a 16th of a power of two, found from a histogram of at
    most 1024 steps; rows of equal count stay together.
    """
    n = F.col(count)
    step = F.when(n == 1, 0).otherwise(F.floor(16 * F.log2(n))).cast("int")
    steps = {r[0]: (r[1], r[2]) for r in df.groupBy(step).agg(F.count("*"), F.min(n)).collect()}
    least, taken = 2**63 - 1, 0
    for s in sorted(steps, reverse=True):
        taken += steps[s][0]
        if taken > most:
            break
        least = steps[s][1]
    return df.where(n >= least), df.where(n < least)


class Bitmap:
    """A set of 64-bit hashes as a bitmap of bounded size; false positives only.

    It is a prefilter in front of an exact join, so that rows without a partner
    are dropped before a shuffle. At any size results stay exact; a full bitmap
    only stops helping. 2**27 bits (16 MB) at most are sent to the executors.
    """

    MAX_BITS = 27

    def __init__(self, data: np.ndarray, bits: int):
        self.data, self.bits = data, bits

    @staticmethod
    def of(df: DataFrame, hash_col: str, entries: int, each: int = 16) -> Bitmap:
        """``each`` bits for each of the entries, within the bound."""
        bits = min(Bitmap.MAX_BITS, max(16, math.ceil(math.log2(each * entries + 1))))
        slot = F.expr(f"({hash_col} & {(1 << bits) - 1}L) + 1")
        rows = (
            df.select(slot.alias("slot"))
            .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
            .toArrow()  # 4096 rows of 4 KB at most, in one job: an iterator would run one for each partition
        )
        data = np.zeros((1 << bits) // 8, dtype=np.uint8)
        for bucket, own in zip(rows["bucket"].to_pylist(), rows["bits"]):
            at = (bucket - 1) * 4096
            part = np.frombuffer(own.as_buffer(), dtype=np.uint8)
            data[at : at + 4096] = part[: max(0, len(data) - at)]
        return Bitmap(data, bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.astype(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    """(id, UTF-8 text) of each row of (doc_id, text); a null text is empty."""
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
        buffer = text.as_buffer() if text.is_valid else None
        yield doc_id, buffer.to_pybytes() if buffer is not None else b""


class Rows:
    """Collects columns of Python lists and numpy arrays; gives Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = OUT_BYTES):
        self.schema, self.limit = schema, limit
        self.clear()

    def clear(self) -> None:
        self.parts: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, n: int, *cols) -> None:
        """Append n rows; a scalar is repeated."""
        for part, col in zip(self.parts, cols):
            part.append(col if isinstance(col, np.ndarray) else np.full(n, col))
        self.size += n * 8 * len(cols)

    def full(self) -> bool:
        return self.size >= self.limit

    def batch(self) -> pa.RecordBatch:
        cols = [
            pa.array(np.concatenate(p) if p else [], type=f.type) for p, f in zip(self.parts, self.schema)
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(cols, schema=self.schema)


def crc_part(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(col.cast("string")) % n


def ranked(df: DataFrame, key: str, rank: str) -> DataFrame:
    """df with the 0-based rank of its rows by ``key`` (unique, nulls last), without a one-task window.

    The rows are range-partitioned and written once; each partition numbers its
    own rows and adds the counts of the partitions before it.
    """
    flag = F.col(key).isNull()
    parts = df.repartitionByRange(flag, F.col(key).asc_nulls_last())
    spread = materialize(parts.withColumn("_part", F.spark_partition_id()), "ranked")
    # a row for each partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy("_part").count()
    offsets = counts.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    own = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_last())
    return (
        spread.withColumn("_own", F.row_number().over(own) - 1)
        .join(offsets, "_part")
        .withColumn(rank, (F.col("_own") + F.col("_offset")).cast("long"))
        .drop("_part", "_own", "_offset")
    )


def rows_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
