"""Small metadata calls on whatever file system Spark is set up for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in name order; none when the parent does not exist."""
    fs, where = _file_system(spark, pattern)
    found = fs.globStatus(where)
    return sorted(s.getPath().toString() for s in found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library wrote."""
    fs, where = _file_system(spark, path)
    return fs.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty marker file."""
    fs, where = _file_system(spark, path)
    fs.create(where, True).close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a path that does not exist yet."""
    fs, where = _file_system(spark, source)
    fs.mkdirs(_file_system(spark, target)[1].getParent())
    if not fs.rename(where, _file_system(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since 1970."""
    fs, where = _file_system(spark, path)
    return fs.getFileStatus(where).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, where = _file_system(spark, path)
    return fs.getContentSummary(where).getLength()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there with all of its text or not at all; ``path`` must not exist."""
    write_text(spark, path + ".part", text)
    rename(spark, path + ".part", path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced as a whole."""
    fs, where = _file_system(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
