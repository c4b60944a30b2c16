"""Folder listing and removal through Hadoop's FileSystem, so any storage Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of one folder, sorted; empty if the folder does not exist."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop_path = _fs(spark, source)
    if not fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)


def list_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Name -> bytes of the files of one folder, without hidden ones."""
    fs, hadoop_path = _fs(spark, path)
    found = fs.listStatus(hadoop_path) if fs.exists(hadoop_path) else []
    return {s.getPath().getName(): s.getLen() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole or not at all: under another name first, then renamed."""
    fs, _ = _fs(spark, path)
    part = f"{path}.part"
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(part), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
