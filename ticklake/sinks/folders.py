"""Partition folders of a table, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


# Below a table, while it is compacted: folders that do not count yet, and from then on
# folders that do not count any more. Spark's readers pass over names with an underscore.
MADE, REPLACED = "_compaction/made", "_compaction/replaced"


def hidden(spark: SparkSession, path: str) -> list[str]:
    """Folders that readers must leave out: none, unless a compaction is under way."""
    replaced = read_lines(spark, f"{path}/{REPLACED}")
    return replaced if replaced is not None else read_lines(spark, f"{path}/{MADE}") or []


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small file that is there whole or not at all."""
    target, fs = _path(spark, path)
    draft, _ = _path(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray("\n".join(lines).encode()))
    stream.close()
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def read_lines(spark: SparkSession, path: str) -> list[str] | None:
    """The lines of a small file; None if it is not there."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    return data.decode().split("\n")


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def delete(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _path(spark, path)
    fs.delete(jvm_path, True)


def partitions(
    spark: SparkSession, path: str, columns: list[str], first: str = "*"
) -> list[tuple[dict, str]]:
    """The partition values and paths below a table, down to the given columns. ``first``
    is a glob for the values of the first column."""
    pattern = "/".join(f"{c}={first if i == 0 else '*'}" for i, c in enumerate(columns))
    glob, fs = _path(spark, f"{path}/{pattern}")
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(glob))
    names = [str(p.toString()) for p in found] if found else []
    depth = len(columns)
    return [
        (dict(part.split("=", 1) for part in name.split("/")[-depth:]), name) for name in names
    ]


def file_count(spark: SparkSession, path: str) -> int:
    jvm_path, fs = _path(spark, path)
    files, count = fs.listFiles(jvm_path, True), 0
    while files.hasNext():
        count += files.next().getPath().getName().endswith(".parquet")
    return count
