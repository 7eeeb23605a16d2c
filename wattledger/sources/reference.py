"""Reference tables and meter feeds read from files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wattledger.operators.joins import one_per_key
from wattledger.schemas import BUILDINGS, METER_FEED
from wattledger.sources.landing import ANY_AGE


def read_buildings(
    spark: SparkSession, path: str, schema: StructType = BUILDINGS, key: str = "store_id"
) -> DataFrame:
    """The building reference CSV, one row per key: a store listed twice would otherwise
    double its bills. The smallest building ID of a store is taken; ambiguous_buildings of
    building_rows names the stores with several."""
    return one_per_key(building_rows(spark, path, schema), key, "building_id")


def building_rows(spark: SparkSession, path: str, schema: StructType = BUILDINGS) -> DataFrame:
    """The building reference CSV as it is."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_meter_feed(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).schema(METER_FEED).load(path)


def meter_feed_stream(
    spark: SparkSession, path: str, file_format: str = "parquet", max_files: int = 1000
) -> DataFrame:
    return (
        spark.readStream.format(file_format)
        .schema(METER_FEED)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE)
        .load(path)
    )
