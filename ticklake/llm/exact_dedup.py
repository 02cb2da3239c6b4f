"""Exact deduplication by 128-bit content hash, with bytes compared inside groups.

Rows whose texts are byte for byte equal form a group (null counts as the empty text);
the row with the smallest or largest id stays. Texts are hashed with MD5, and rows are
grouped by the hash and then the bytes, so texts that merely collide stay apart. The
grouping combines on the map side: a task sends one row per distinct text it has seen, and
no group is gathered in one task. Rows find their group again by MD5 and SHA-256, in a
join without texts whose hot keys Spark can split.

Defined results: an empty table gives no rows; a null id never beats another, and a group
of null ids keeps its rows; rows that repeat id and text are all members of the group and
get the same decision. Only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """128-bit content hash, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    content: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    best = F.min if keep == "smallest" else F.max
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    ).withColumn("h", content(F.col("t")))
    sha = F.sha2(F.col("t").cast("binary"), 256).alias("sha")
    groups = (
        rows.groupBy("h", "t").agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", sha, "keep_id", "group_size")
    )
    return rows.select("id", "h", sha).join(groups, ["h", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
