"""Tick streams and tables of nested ticks, read from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas

FORMATS = ("parquet", "json", "orc")


def from_tick(ticks: DataFrame, start_tick: int = 0) -> DataFrame:
    """Ticks from a number on; 0 takes all. A restarted stream resumes from its own
    checkpoint, so this matters for its first run only."""
    return ticks if start_tick == 0 else ticks.filter(F.col("tick_number") >= start_tick)


def read_ticks(
    spark: SparkSession, path: str, file_format: str = "parquet", start_tick: int = 0
) -> DataFrame:
    """Nested ticks as a batch, always with the explicit schema."""
    _check(file_format)
    ticks = spark.read.schema(schemas.TICK).format(file_format).load(path)
    return from_tick(ticks, start_tick)


def stream_ticks(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    start_tick: int = 0,
    max_files: int | None = None,
) -> DataFrame:
    """Nested ticks as an unbounded stream of files landing in ``path``."""
    _check(file_format)
    reader = spark.readStream.schema(schemas.TICK).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return from_tick(reader.load(path), start_tick)


def _check(file_format: str) -> None:
    if file_format not in FORMATS:
        raise ValueError(f"unsupported format {file_format!r}; allowed: {', '.join(FORMATS)}")
