"""Folders of the file system that holds the tables, whichever it is."""

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none if there is no such path."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where) if entry.isDirectory())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of all that lies in ``path``, sorted; none if there is no such folder."""
    files, where = _located(spark, path)
    if not files.exists(where) or not files.getFileStatus(where).isDirectory():
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    files, where = _located(spark, path)
    files.create(where).close()


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.delete(where, True)
