"""Meter intervals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.quality import valid_period
from wattledger.functions.values import flag, money
from wattledger.session import stored

METER_KEY = ("timestamp", "meter_id")


def dedup_intervals(reads: DataFrame) -> DataFrame:
    """One reading per meter and instant.

    A reading with a value beats one without, then the last source file wins, then the
    larger value and building, so the result never depends on row order. The best row is
    a maximum of structs, which is taken in each task before the shuffle: a reading sent
    over and over moves as one row per task.
    """
    ranked = F.struct(
        F.col("kwh").isNotNull().alias("has_value"), "source_file", "kwh", "building_id"
    )
    best = reads.groupBy(*METER_KEY).agg(F.max(ranked).alias("best"))
    return flag_intervals(best.select(*METER_KEY, "best.building_id", "best.kwh", "best.source_file"))


def flag_intervals(reads: DataFrame) -> DataFrame:
    """METER_INTERVAL rows."""
    return reads.select(
        "timestamp",
        "building_id",
        "meter_id",
        "kwh",
        "source_file",
        flag(F.col("kwh").isNull()).alias("is_missing_kwh"),
        F.current_timestamp().alias("silver_ingestion_ts"),
    )


def daily_usage(reads: DataFrame) -> DataFrame:
    """Energy, readings with a value and readings without one of a building and day, over all
    its meters. reads: one row per meter and instant."""
    return (
        reads.where("building_id is not null and timestamp is not null")
        .groupBy("building_id", F.to_date("timestamp").alias("day"))
        .agg(
            F.sum(money(F.col("kwh"))).alias("metered_kwh"),
            F.count("kwh").alias("readings"),
            F.count_if(F.col("kwh").isNull()).alias("missing_readings"),
        )
    )


def metered_periods(periods: DataFrame, reads: DataFrame) -> DataFrame:
    """What the meters of a building read in each period (building_id, bill_start_date,
    bill_end_date; both days included), for the periods with any reading.

    A join on points in intervals: readings are summed by day first, days and periods meet in
    the months that a period touches, so the join is on equal building and month, and one of
    its groups holds at most 31 days and the periods of one building that touch a month.
    """
    month = F.explode(
        F.sequence(
            F.trunc("bill_start_date", "month"),
            F.trunc("bill_end_date", "month"),
            F.expr("interval 1 month"),
        )
    )
    bounds = ("bill_start_date", "bill_end_date")
    buckets = periods.select("building_id", *bounds).distinct().withColumn("_month", month)
    days = daily_usage(reads).withColumn("_month", F.trunc("day", "month"))
    return (
        buckets.join(days, ["building_id", "_month"])
        .where(F.col("day").between(*[F.col(bound) for bound in bounds]))
        .groupBy("building_id", *bounds)
        .agg(
            F.sum("metered_kwh").alias("metered_kwh"),
            F.sum("readings").alias("readings"),
            F.sum("missing_readings").alias("missing_readings"),
            F.count(F.lit(1)).alias("metered_days"),
        )
    )


def metered_vs_billed(bills: DataFrame, reads: DataFrame) -> DataFrame:
    """Electricity bills of known buildings with a valid period, beside what the meters read in
    it: `metered_kwh` and the `difference` (billed less metered; both null without a reading),
    `readings`, `missing_readings` (0 without any) and `metered_days`.

    Bills of equal periods share one sum. The bills are read twice, so those that are meant are
    stored: Spark leaves out the others where they are made, before it shuffles any.
    """
    meant = bills.where(
        (F.col("commodity") == "electricity") & F.col("building_id").isNotNull() & valid_period()
    )
    billed = stored(meant, "billed")
    keys = ["building_id", "bill_start_date", "bill_end_date"]
    counts = ("readings", "missing_readings", "metered_days")
    joined = billed.join(metered_periods(billed.select(*keys), reads), keys, "left")
    return joined.withColumns(
        {
            "difference": money(F.col("consumption")) - F.col("metered_kwh"),
            **{name: F.coalesce(name, F.lit(0)) for name in counts},
        }
    )
