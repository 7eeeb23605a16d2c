"""Files that change, go and come back at known paths: a log of what each snapshot changed.

A snapshot is a listing of metadata (FILE_REGISTRY rows). It is compared with what the log says
is there, on path, time and length; only differences are logged, one row for a file and
snapshot. A file rewritten with the same time and length looks unchanged.

The log is stored by snapshot number (`batch_id`), so taking a snapshot again replaces its own
rows. Elements of a changed file are stored under the number of the snapshot that found it;
rows of its earlier versions stay, and are closed by the log.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.files import path_exists
from wattledger.operators.elements import Parser
from wattledger.sources.landing import fetch_content, file_metadata, landed_files
from wattledger.streaming.sinks import read_batches, write_batch

_FACTS = ("utility_type", "vendor_id", "file_size_bytes", "modification_time")
CHANGES = ("ADDED", "CHANGED", "DELETED", "RETURNED")


def last_changes(log: DataFrame) -> DataFrame:
    """The last row of every path. A maximum of structs, taken in each task first: a file that
    changes in every snapshot moves as one row per task."""
    last = F.max(F.struct("batch_id", "change", *_FACTS)).alias("last")
    return log.groupBy("file_path").agg(last).select("file_path", "last.*")


def snapshot_changes(listed: DataFrame, log: DataFrame) -> DataFrame:
    """What is different in a listing from the state that a log of earlier snapshots gives:
    `file_path, change` and the file's facts (a deleted file's last ones)."""
    now = listed.select("file_path", *_FACTS).dropDuplicates(["file_path"])
    before = last_changes(log).select(
        "file_path", F.col("change").alias("_change"), *[F.col(f).alias(f"_{f}") for f in _FACTS]
    )
    known, gone = F.col("_change").isNotNull(), F.col("_change") == "DELETED"
    here = F.col("modification_time").isNotNull() | F.col("file_size_bytes").isNotNull()
    same = (F.col("modification_time") == F.col("_modification_time")) & (
        F.col("file_size_bytes") == F.col("_file_size_bytes")
    )
    change = (
        F.when(~here, F.when(~gone, "DELETED"))
        .when(~known, "ADDED")
        .when(gone, "RETURNED")
        .when(~F.coalesce(same, F.lit(False)), "CHANGED")
    )
    return (
        now.join(before, "file_path", "full")
        .withColumn("change", change)
        .where("change is not null")
        .select(
            "file_path", "change", *[F.when(here, F.col(f)).otherwise(F.col(f"_{f}")).alias(f) for f in _FACTS]
        )
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log so far, without rows before the first snapshot."""
    if not path_exists(spark, log):
        return spark.createDataFrame(
            [], "file_path string, change string, utility_type string, vendor_id string,"
            " file_size_bytes long, modification_time timestamp, batch_id long",
        )
    return read_batches(spark, log)


def record_snapshot(listed: DataFrame, snapshot: int, log: str) -> int:
    """Logs how a listing differs from the snapshots before it; how many files do. Snapshots are
    numbered upwards; one that is taken again sees what it saw."""
    earlier = read_log(listed.sparkSession, log).where(F.col("batch_id") < snapshot)
    return write_batch(snapshot_changes(listed, earlier), snapshot, log)


def snapshot_folder(spark: SparkSession, root: str, snapshot: int, log: str, glob: str = "*.pdf") -> int:
    """The same for the files below a folder; none is opened."""
    return record_snapshot(file_metadata(landed_files(spark, root, glob)), snapshot, log)


def file_versions(log: DataFrame) -> DataFrame:
    """Every version of every file: number, facts, the change that began it, the snapshots from
    which and before which it was there (`valid_to` null: it still is), and what ended it."""
    order = Window.partitionBy("file_path").orderBy("batch_id")
    return (
        log.withColumns(
            {
                "valid_to": F.lead("batch_id").over(order),
                "ended_by": F.lead("change").over(order),
                "version": F.count_if(F.col("change") != "DELETED").over(order),
            }
        )
        .where(F.col("change") != "DELETED")
        .select(
            "file_path", "version", "change", *_FACTS, F.col("batch_id").alias("valid_from"),
            "valid_to", "ended_by",
        )
    )


def parse_snapshot(
    spark: SparkSession, root: str, snapshot: int, log: str, elements: str, parser: Parser, glob: str = "*.pdf"
) -> int:
    """Parses the files that a snapshot found new, changed or back, and no others, into the
    snapshot's own batch of `elements`; returns element rows."""
    found = read_log(spark, log).where((F.col("batch_id") == snapshot) & (F.col("change") != "DELETED"))
    files = fetch_content(spark, root, found.select("file_path", "utility_type", "vendor_id"), glob)
    return write_batch(parser(files), snapshot, elements)


def element_versions(elements: DataFrame, log: DataFrame) -> DataFrame:
    """Element rows of parse_snapshot with the `version` of their file and the snapshot that
    closed it (`valid_to`; null for what is current)."""
    versions = file_versions(log).select(
        "file_path", F.col("valid_from").alias("batch_id"), "version", "valid_to"
    )
    return elements.join(versions, ["file_path", "batch_id"])
