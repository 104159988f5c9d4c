"""The raw event files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.schema import BRONZE_COLUMNS, CORRUPT, RAW_SCHEMA
from clickloom.session import shared_folder


def _file_name() -> Column:
    """File names come URL-encoded, but for the plus sign, which decoding would turn to a space."""
    encoded = F.col("_metadata.file_name")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def input_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Base name and bytes of each file behind the paths. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(list(paths))
        .select(_file_name().alias("source_file"), F.col("_metadata.file_size").alias("file_bytes"))
    )


def check_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Refuse no input, empty files and equal base names. No contents are read; the headers of
    all files are checked by the scan."""
    if not paths:
        raise ValueError("no input path given")
    files = input_files(spark, paths)
    # The listing has empty files too, the scan of names and sizes skips them. The listing is
    # counted where it is, in the scan's file index.
    listed = spark.read.format("binaryFile").load(list(paths))._jdf.inputFiles()
    if len(listed) != files.count():
        raise ValueError(f"empty input files among {list(paths)}")
    repeated = files.groupBy("source_file").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"input files with equal names: {repeated['source_file']}")


def exact_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings that tells case apart in names. The scan compares
    header names as its session compares column names, and other queries of the caller's session
    have to go on as they are meanwhile."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


@contextmanager
def staged_events(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Iterator[DataFrame]:
    """All rows of the files, read once into the shared folder. A file with another header,
    whichever of them it is, ends the job. What ``columns`` makes of the rows is stored, so that
    columns it adds are worked out once however many steps read them. The table is emptied at the
    end."""
    path = shared_folder(spark, "bronze")
    staged = columns(read_events(exact_session(spark), paths))
    staged.write.parquet(path)
    rows = spark.read.schema(staged.schema).parquet(path)
    try:
        yield rows
    finally:
        rows.limit(0).write.mode("overwrite").parquet(path)


def read_events(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All rows as text, lines that do not fit marked in the corrupt column.

    Column pruning stays off: with it the reader would parse only the columns a query names
    and miss bad lines. ``enforceSchema=false`` makes the scan fail on another header, in any of
    the files; in an :func:`exact_session` on names in other case too.
    """
    rows = (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", False)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(list(paths))
    )
    return rows.withColumn("source_file", _file_name()).select(
        *BRONZE_COLUMNS
    )
