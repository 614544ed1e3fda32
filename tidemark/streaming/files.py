"""The few folder operations the table sinks need, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is absent."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Make a written folder visible under its final name by one rename."""
    fs, final = _open(spark, target)
    fs.mkdirs(final.getParent())
    if not fs.rename(_path(spark, source), final):
        raise OSError(f"could not rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if it is absent."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return stream.readAllBytes().decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _open(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _open(spark: SparkSession, path: str):
    target = _path(spark, path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target
