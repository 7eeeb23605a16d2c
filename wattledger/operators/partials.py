"""Reports kept up to date: partial sums per batch of bills, merged when they are read.

Sums and counts of a batch are stored under the batch's number. When a batch is written again,
its partial sums are made again from that batch alone and replace what they were, which takes
the old rows out of every report without knowing them. A report merges the partial sums: rows
for each group and batch, not bills.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.values import money
from wattledger.operators.joins import join_lookup, one_per_key
from wattledger.streaming.sinks import read_batches, write_batch

GROUP = ("store_id", "vendor_id", "commodity", "bill_month")
SUMS = ("consumption", "cost_usd", "tax")


def partial_sums(bills: DataFrame) -> DataFrame:
    """Bills, and sums of their amounts, for each store, vendor, commodity and month of start:
    the finest groups of the reports below."""
    month = F.trunc("bill_start_date", "month").alias("bill_month")
    return bills.groupBy("store_id", "vendor_id", "commodity", month).agg(
        F.count(F.lit(1)).alias("bills"), *[F.sum(money(F.col(name))).alias(name) for name in SUMS]
    )


def refresh(spark: SparkSession, bills: str, batch_ids: Sequence[int], partials: str) -> dict[int, int]:
    """Makes the partial sums of these batches of a bills target again; no other batch is read.
    A batch that has no bills any more loses its sums. Groups written per batch."""
    stored = read_batches(spark, bills)
    return {
        batch_id: write_batch(
            partial_sums(stored.where(F.col("batch_id") == batch_id)), batch_id, partials
        )
        for batch_id in batch_ids
    }


def _merged(partials: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in ("bills", *names)])


def merged_cost_by_month(partials: DataFrame) -> DataFrame:
    """reports.cost_by_month from partial sums."""
    return _merged(partials, ["commodity", "bill_month"], ["cost_usd", "tax"])


def merged_consumption_by_building(partials: DataFrame, buildings: DataFrame) -> DataFrame:
    """reports.consumption_by_building from partial sums."""
    names = ["consumption", "cost_usd"]
    by_store = _merged(partials, ["store_id", "commodity", "bill_month"], names)
    mapped = join_lookup(by_store, one_per_key(buildings, "store_id", "building_id"), "store_id")
    return _merged(mapped, ["building_id", "commodity", "bill_month"], names)


def merged_vendors(partials: DataFrame, vendors: DataFrame) -> DataFrame:
    """reports.compare_vendors from partial sums."""
    totals = _merged(partials, ["vendor_id", "commodity"], ["consumption", "cost_usd"])
    per_unit = F.try_divide(F.col("cost_usd").cast("double"), F.col("consumption").cast("double"))
    named = join_lookup(totals, one_per_key(vendors, "vendor_id", "vendor"), "vendor_id")
    return named.withColumn("cost_per_unit", F.round(per_unit, 4))
