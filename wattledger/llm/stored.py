"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from wattledger.session import new_folder


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written below spark.checkpoint.dir and read from there: a lost executor costs
    no recomputation, and what follows reads them as often as it likes.

    The shuffle files behind the rows are of no more use. Spark deletes them when the JVM has
    collected the objects that name them, so it is asked to, instead of keeping the shuffles
    of all steps on disk until the last one ends.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, label)
    schema = rows.schema
    rows.write.parquet(folder)
    del rows
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(schema).parquet(folder)
    table.stored_in = folder
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes tables made by stored() that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
