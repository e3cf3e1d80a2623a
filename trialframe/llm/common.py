"""Shared folder, written intermediate tables, and text columns as flat buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import shared_dir

#: Texts are handed to the numpy code in slices of about this many bytes (or one text).
SLICE_BYTES = 2_000_000


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the lineage, and
    later stages start from files that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of an id table that may be broadcast (24 MB as a hash table of longs)
BROADCAST_ROWS = 500_000


def small(ids: DataFrame) -> DataFrame:
    """``ids``, a written table of few columns, marked for broadcast if it has few rows; left to a shuffled join if not."""
    return F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows in each Arrow batch for the jobs run inside: for rows of many kilobytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            drop_path(df.sparkSession, files[0].rpartition("/")[0])


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of our own that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: rows in an Arrow batch of whole texts
TEXT_ROWS = 1000


def spread(df: DataFrame) -> DataFrame:
    """Rows ready for work on whole texts: at least one partition for each core, and the session's Arrow
    batches no larger than TEXT_ROWS, since each of a core's batches is held by Spark and by Python."""
    spark = df.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, TEXT_ROWS)
    want = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with more columns."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def plain_strings(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """One contiguous large-string array, null as the empty string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def byte_view(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings and the n + 1 offsets of the strings in them, without a copy."""
    _, offsets, data = strings.buffers()
    off = np.frombuffer(offsets, np.int64, len(strings) + 1, strings.offset * 8) if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_slices(strings: pa.LargeStringArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive strings of about ``limit`` bytes, one string at least."""
    off = byte_view(strings)[1]
    at, n = 0, len(strings)
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def code_points(strings: pa.LargeStringArray) -> tuple[str, np.ndarray, np.ndarray]:
    """All strings joined, their code points, and the n + 1 offsets of the strings in them."""
    raw, off = byte_view(strings)
    text = raw.tobytes().decode("utf-8")
    if len(text) == len(raw):
        return text, raw.astype(np.uint32), off
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=before[1:])
    return text, np.frombuffer(text.encode("utf-32-le"), np.uint32), before[off]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets; empty stretches give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged_take(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[s : s + n]`` for each start and length."""
    ends = np.cumsum(lens)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lens, lens)
    return values[index]
