"""Meter readings as they arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.files import delete_path, path_exists
from wattledger.operators.meters import METER_KEY, dedup_intervals, flag_intervals
from wattledger.schemas import METER_INTERVAL
from wattledger.streaming.sinks import run_to_end

# Parts a reading's copies are thinned out in before they meet; see first_arrivals.
THINNING_PARTS = 16


def first_arrivals(reads: DataFrame, lateness: str = "1 day", thin: bool = True) -> DataFrame:
    """The first reading to arrive for each meter and instant.

    State is kept per reading until the watermark passes it, so it is bounded by the
    readings of `lateness`. Which copy is first depends on arrival; dedup_intervals gives
    the ranked choice in batch, and takes readings that were later than the watermark.
    With `thin`, copies are dropped per group of input tasks first, so that one reading sent
    over and over does not send every copy to one task. That costs a second state store; a
    feed that repeats little can do without.
    """
    timed = reads.withWatermark("timestamp", lateness)
    if thin:
        timed = (
            timed.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(THINNING_PARTS)))
            .dropDuplicatesWithinWatermark([*METER_KEY, "_part"])
            .drop("_part")
        )
    return flag_intervals(timed.dropDuplicatesWithinWatermark(list(METER_KEY)))


# The column, and folder, that a table of readings is cut by.
DAY = "reading_day"


def read_readings(spark: SparkSession, table: str) -> DataFrame:
    """A table that merge_readings keeps."""
    return spark.read.schema(METER_INTERVAL).parquet(table).select(*METER_INTERVAL.names)


def merge_readings(reads: DataFrame, batch_id: int, table: str, work: str) -> list[str]:
    """Merges a batch of readings, however late, into a folder of METER_INTERVAL rows, by the
    batch's own rule for the winner (dedup_intervals); returns the days it rewrote.

    Only days that the batch has readings of are read and written; the files of all others stay
    as they are. The days' names are the only rows that reach the driver, one for each.

    The merged days are written below `work` before they replace anything, and deleted when they
    have. A batch that runs again and finds them complete goes on from there, since the table may
    be half replaced; one that doesn't merges once more, which gives the same rows, the winner
    being a maximum.
    """
    spark = reads.sparkSession
    merged = f"{work}/batch_id={batch_id}"
    if not path_exists(spark, f"{merged}/_SUCCESS"):
        day = F.to_date("timestamp").cast("string").alias(DAY)
        dated = dedup_intervals(reads.dropna(subset=list(METER_KEY))).select("*", day)
        days = [row[0] for row in dated.select(DAY).distinct().collect()]
        kept = dated.drop("is_missing_kwh", "silver_ingestion_ts")
        if days and path_exists(spark, table):
            stored = spark.read.schema(f"{_columns()}, {DAY} string").parquet(table)
            old = stored.where(F.col(DAY).isin(days)).select(*kept.columns)
            kept = kept.unionByName(old)
        best = dedup_intervals(kept).select("*", day)
        best.write.mode("overwrite").partitionBy(DAY).parquet(merged)
    rows = spark.read.schema(f"{_columns()}, {DAY} string").parquet(merged)
    days = sorted(row[0] for row in rows.select(DAY).distinct().collect())
    if days:
        writer = rows.write.mode("overwrite").partitionBy(DAY)
        writer.option("partitionOverwriteMode", "dynamic").parquet(table)
    delete_path(spark, merged)
    return days


def _columns() -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in METER_INTERVAL)


def merge_stream(stream: DataFrame, table: str, work: str, checkpoint: str) -> dict[int, list[str]]:
    """Runs a feed to its end, each batch merged into `table`; the days rewritten per batch. No
    watermark and no state: a reading may be as late as it likes."""
    written: dict[int, list[str]] = {}

    def merge(batch: DataFrame, batch_id: int) -> None:
        written[batch_id] = merge_readings(batch, batch_id, table, work)

    run_to_end(stream.writeStream.foreachBatch(merge), checkpoint)
    return written
