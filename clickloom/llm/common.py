"""What several operators share: columns in, Arrow batches through a function, tables kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Text that one step of a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about SLICE_BYTES of a text column (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and held + (size or 0) > SLICE_BYTES:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size or 0
        if start < len(sizes):
            yield batch.slice(start)


def map_rows(
    frame: DataFrame,
    schema: str,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> DataFrame:
    return frame.mapInArrow(work, schema)


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several steps read to the shared folder and read it from there, so
    that it is made once, and outlives a lost executor."""
    spark = frame.sparkSession
    path = f"{shared_root(spark)}/llm-{purpose}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def dealt_by_range(frame: DataFrame, purpose: str, *order: Column | str) -> DataFrame:
    """The rows with ``part``, numbers of ranges of an order, which have about as many rows each
    however far apart the values are. Ranges ascend with their numbers. The table is written, as
    where ranges begin comes from a sample; rows that may repeat need something in the order that
    tells them apart, else they all are in one range."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    return kept(dealt, purpose)
