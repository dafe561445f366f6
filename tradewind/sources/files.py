"""What readers and writers don't offer of a file system: listing, markers, removal. Any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system itself: a failed read would cost an analysis and fill the log."""
    files, place = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file, or a folder with all that is in it. False if it wasn't there."""
    files, place = _at(spark, path)
    return files.delete(place, True)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file, in one step. False if it was there."""
    files, place = _at(spark, path)
    return files.createNewFile(place)


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote a folder came to its end. Spark's writers leave this marker last."""
    return exists(spark, f"{folder}/_SUCCESS")
