"""Folders by path, through the file systems that Spark itself uses."""

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    system, at = _on(spark, path)
    return system.exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file, or a folder with all it holds; nothing happens if it isn't there."""
    system, at = _on(spark, path)
    system.delete(at, True)
