"""Sinks that may be replayed, and the numbers they report."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wattledger.files import delete_path


_DYNAMIC = ("partitionOverwriteMode", "dynamic")


def ensure_schema(spark: SparkSession, table: str) -> None:
    """Creates the schema a table name starts with, if it names one."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def run_to_end(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Takes everything available now, in bounded batches, and returns when it is done.
    A failure in the stream is raised here."""
    return _wait(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_to_table(
    rows: DataFrame, table: str, checkpoint: str, file_format: str = "parquet", path: str | None = None
) -> StreamingQuery:
    """Appends a stream to a named table through the native sink, which commits each batch
    once. A table read by a further stream must be written this way: rewritten files would
    reach that stream again."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path is not None:
        writer = writer.option("path", path)
    return _wait(writer.toTable(table, format=file_format, outputMode="append"))


def _wait(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def _is_path(target: str) -> bool:
    return "/" in target


def _overwrite_batches(rows: DataFrame, target: str, file_format: str) -> None:
    """Replaces the batches that `rows` holds, in a folder or a named table."""
    folders = ["batch_id"]
    if _is_path(target):
        writer = rows.write.format(file_format).mode("overwrite").partitionBy(*folders)
        writer.option(*_DYNAMIC).save(target)
        return
    spark = rows.sparkSession
    ensure_schema(spark, target)
    if not spark.catalog.tableExists(target):
        # The table itself says that partitions are overwritten one by one.
        empty = spark.createDataFrame([], rows.schema).write.format(file_format).option(*_DYNAMIC)
        empty.partitionBy(*folders).saveAsTable(target)
    # Inserting goes by position, and a table keeps its partition columns last.
    ordered = rows.select(*spark.table(target).columns)
    if _DYNAMIC[0].lower() in spark.sql(f"SHOW CREATE TABLE {target}").first()[0].lower():
        ordered.write.mode("overwrite").insertInto(target)
        return
    # A table made elsewhere: only the session can say it.
    setting = f"spark.sql.sources.{_DYNAMIC[0]}"
    before = spark.conf.get(setting)
    spark.conf.set(setting, _DYNAMIC[1])
    try:
        ordered.write.mode("overwrite").insertInto(target)
    finally:
        spark.conf.set(setting, before)


def write_batch(
    rows: DataFrame,
    batch_id: int,
    target: str,
    file_format: str = "parquet",
) -> int:
    """Writes one batch as its own partition of a folder (a target with a slash) or a named
    table, and returns its row count.

    A batch that runs again, because the stream stopped between the write and the commit,
    replaces itself, also when it has no rows any more. Batch IDs belong to one checkpoint, so a
    target does too. The count is taken while writing, not by running the batch a second time;
    an empty batch writes nothing and counts 0.
    """
    counted = Observation()
    stamped = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    stamped = stamped.observe(counted, F.count(F.lit(1)).alias("rows"))
    _overwrite_batches(stamped, target, file_format)
    written = counted.get.get("rows", 0)
    if not written:
        # Overwriting by partition leaves alone what the new rows don't name.
        _clear_batch(rows.sparkSession, batch_id, target)
    return written


def _clear_batch(spark: SparkSession, batch_id: int, target: str) -> None:
    if _is_path(target):
        delete_path(spark, f"{target}/batch_id={batch_id}")
    else:
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (batch_id = {batch_id})")


def read_batches(spark: SparkSession, target: str, file_format: str = "parquet") -> DataFrame:
    """What write_batch stored; the batch ID is a number again, whatever type the session
    reads folder names as."""
    stored = (
        spark.read.format(file_format).load(target) if _is_path(target) else spark.table(target)
    )
    return stored.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def rewrite_batches(rows: DataFrame, target: str, file_format: str = "parquet") -> None:
    """Replaces exactly the partitions of the batch IDs that `rows` holds."""
    _overwrite_batches(rows, target, file_format)


def write_each_batch(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "parquet",
) -> dict[int, int]:
    """Runs a stream to its end into `target`, each batch through `transform`; returns the
    rows written per batch."""
    written: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch)
        written[batch_id] = write_batch(rows, batch_id, target, file_format)

    run_to_end(stream.writeStream.foreachBatch(write), checkpoint)
    return written
