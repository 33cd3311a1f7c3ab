"""Folders in the shared file system (any Hadoop file system Spark can reach)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def make_folder(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.mkdirs(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; empty if it does not exist."""
    fs, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if f.isDirectory()) if fs.exists(place) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path``; empty if it does not exist."""
    fs, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if f.isFile()) if fs.exists(place) else []


def file_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def move_folder(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; on HDFS and local disks its files appear all at once."""
    fs, place = _at(spark, old)
    if not fs.rename(place, _at(spark, new)[1]):
        raise OSError(f"could not move {old} to {new}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this application wrote."""
    fs, place = _at(spark, path)
    fs.delete(place, True)
