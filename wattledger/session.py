"""Session settings, and the shared folder that streams and checkpoints work in."""

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Vendor folders such as vendor_id=007 stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state lives on local disk with a change log, not in the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir as the cluster names it.

    Only a local session without one (tests, a laptop) gets a temporary folder: on a cluster
    that would be another folder on every machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wattledger-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until Spark writes there."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read from there, for what is read several times:
    what made them then runs once. The shuffle files behind them are of no more use, and go from
    the disk when the JVM has collected what names them, which it is asked to do."""
    spark = rows.sparkSession
    folder, schema = new_folder(spark, label), rows.schema
    rows.write.parquet(folder)
    free_shuffles(spark)
    return spark.read.schema(schema).parquet(folder)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of what has ended; otherwise those of all steps of a
    job may stay on disk until the last one ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
