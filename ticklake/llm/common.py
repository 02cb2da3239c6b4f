"""Helpers the corpus operators share: reading tables, staged tables, Arrow schemas."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ticklake.functions.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc32_of(name: str = "doc_id") -> Column:
    """Unsigned crc32 of an id written as decimal text (null: 0)."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(0))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string; needs the session, so call it on the driver."""
    return to_arrow_schema(_parse_datatype_string(ddl))


_APART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case runs of characters other than ASCII punctuation, controls and white space."""
    return (text or "").lower().encode("utf-8").translate(_APART).split()


_TERMS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def term_parts(text: str | None, part: int = 1 << 20) -> Iterator[list[bytes]]:
    """The runs of letters, digits and non-ASCII characters of a text, only A-Z lower-cased,
    in order and in lists of bounded length (a single longer run stays whole)."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + part)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
