"""A few file-system calls on any file system Spark can write to."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def make_directory(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def numbered_directories(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the complete directories ``name=N`` below a path, ascending."""
    if not exists(spark, path):
        return []
    pattern = re.compile(rf"{name}=(\d+)")
    names = [s.getPath().getName() for s in _file_system(spark, path).listStatus(_path(spark, path))]
    numbers = [int(m.group(1)) for m in map(pattern.fullmatch, names) if m]
    return sorted(n for n in numbers if is_complete(spark, f"{path}/{name}={n}"))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a Spark job has written this directory to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _file_system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what is in a directory, in order; none if it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _file_system(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; readers see it whole or not at all."""
    staged = re.sub(r"([^/]*)$", r".staged-\1", path)
    stream = _file_system(spark, staged).create(_path(spark, staged), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename(spark, staged, path)
