"""Billing periods of a building and commodity beside each other: overlaps and gaps.

Both come from a sweep over the periods by start, which carries the latest end so far. Equal
periods are one row before the sweep, and the sweep has two levels: months of start first, of
which a building has few, then periods within a month, which start from what the months before
reached. So a building that holds much of the bills is swept by many tasks.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions.quality import valid_period

GROUP = ("building_id", "commodity")


def swept_periods(bills: DataFrame) -> DataFrame:
    """Each different valid period of a building and commodity, with its number of `bills`, the
    smallest `first_bill_id`, and `reached`: the latest end among periods before it, by start,
    then end. Bills without a building or commodity are left out."""
    periods = (
        bills.dropna(subset=list(GROUP))
        .where(valid_period())
        .groupBy(*GROUP, "bill_start_date", "bill_end_date")
        .agg(F.count(F.lit(1)).alias("bills"), F.min("bill_id").alias("first_bill_id"))
        .withColumn("_month", F.trunc("bill_start_date", "month"))
        # Valid periods have one. The join below would ask for it on one side only, and bills that
        # are filtered in two ways are made twice.
        .where(F.col("_month").isNotNull())
    )
    months = periods.groupBy(*GROUP, "_month").agg(F.max("bill_end_date").alias("_end"))
    by_month = Window.partitionBy(*GROUP).orderBy("_month")
    carried = months.select(
        *GROUP, "_month",
        F.max("_end").over(by_month.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
    )
    within = Window.partitionBy(*GROUP, "_month").orderBy("bill_start_date", "bill_end_date")
    before = F.max("bill_end_date").over(within.rowsBetween(Window.unboundedPreceding, -1))
    return (
        periods.withColumn("_within", before)
        .join(carried, [*GROUP, "_month"])
        .withColumn("reached", F.greatest("_carried", "_within"))
        .drop("_month", "_carried", "_within")
    )


def period_overlaps(bills: DataFrame) -> DataFrame:
    """Periods that begin before an earlier one of the building and commodity has ended, with the
    end that was `reached` and the days in common. (Equal periods: `duplicate_bills`.)"""
    common = F.datediff(F.least("reached", "bill_end_date"), "bill_start_date") + 1
    return (
        swept_periods(bills)
        .where(F.col("reached") >= F.col("bill_start_date"))
        .withColumn("days", common)
    )


def period_gaps(bills: DataFrame) -> DataFrame:
    """Days without a bill between the periods of a building and commodity: first and last day,
    their number, and the bill after them."""
    return (
        swept_periods(bills)
        .where(F.col("bill_start_date") > F.date_add("reached", 1))
        .select(
            *GROUP,
            F.date_add("reached", 1).alias("gap_start_date"),
            F.date_sub("bill_start_date", 1).alias("gap_end_date"),
            (F.datediff("bill_start_date", "reached") - 1).alias("days"),
            F.col("first_bill_id").alias("next_bill_id"),
        )
    )
