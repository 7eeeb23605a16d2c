"""The plans are the ones meant: what is read, what moves, and what happens to a hot key."""

import re

import pytest
from conftest import plan_text
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as driver
from wattledger.functions.values import AMOUNT
from wattledger.operators import bills as B
from wattledger.operators import reports as R
from wattledger.operators.meters import dedup_intervals
from wattledger.plans import inputs as I

BATCH_QUERIES = [
    "variant_elements", "text_elements", "html_elements", "rule_extract", "gold_pivot", "bill_extract",
    "bill_exact_dedup", "quarantine_split", "dq_summary", "duplicate_bills", "building_unmapped",
    "meter_dedup", "consumption_by_building_month", "vendor_comparison", "usage_trend",
    "consumption_anomaly", "gold_bills", "cost_by_commodity_month", "building_link", "period_overlaps",
    "period_gaps", "bill_months", "metered_vs_billed", "usage_trend_calendar", "lookup_guarded",
]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = plan_text(driver.queries()[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE"):
        if name == "dq_summary" and word.startswith("Single"):
            continue  # one row per task is all that meets
        assert word not in plan, word


def test_reports_read_only_their_columns(spark, sf_dir):
    totals = I.typed_bills(spark, sf_dir).groupBy("store_id").agg(F.sum("consumption"))
    read = [line for line in plan_text(totals).splitlines() if line.startswith("ReadSchema")]
    text = " ".join(read)
    assert "l_extendedprice" not in text and "l_shipdate" not in text and "l_quantity" in text


def test_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_text(I.table(spark, sf_dir, "lineitem").where("l_suppkey = 3").select("l_orderkey"))
    assert "EqualTo(l_suppkey,3)" in plan


@pytest.mark.parametrize("make", ["copies", "reads", "stores"])
def test_aggregates_are_partial_before_the_shuffle(spark, sf_dir, make):
    frame = {
        "copies": lambda: I.bills(spark, sf_dir),
        "reads": lambda: dedup_intervals(I.meter_reads(spark, sf_dir)),
        "stores": lambda: R.totals_by_store(I.bills(spark, sf_dir)),
    }[make]()
    plan = plan_text(frame, "simple")
    assert "partial_" in plan or plan.count("Aggregate(keys") >= 2


def hot_bills(spark):
    """A third of the rows share store, vendor, building and period."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 16).select(
        F.concat(F.lit("B"), F.col("id")).alias("bill_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("store_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("V"), F.col("id") % 500)).alias("vendor_id"),
        F.lit("gas").alias("commodity"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("H"), F.col("id") % 20_000)).alias("building_id"),
        F.lit("2025-01-01").cast("date").alias("bill_start_date"),
        F.lit("2025-02-01").cast("date").alias("bill_end_date"),
        (F.col("id") % 100).cast("double").alias("consumption"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("source_file"),
    )


def small_partitions(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def test_hot_store_is_split_in_the_lookup(spark, settings):
    small_partitions(settings)
    stores = spark.range(0, 60_000).select(F.concat(F.lit("S"), F.col("id")).alias("store_id"))
    stores = stores.union(spark.createDataFrame([("hot",)], "store_id string"))
    buildings = stores.withColumn("building_id", F.concat(F.lit("X"), F.col("store_id")))
    joined = B.add_buildings(hot_bills(spark).drop("building_id"), buildings)
    assert len(joined.where("building_id = 'Xhot'").collect()) == 20_000
    joined.collect()
    assert "skew=true" in plan_text(joined, "simple")


def test_hot_group_is_split_when_joined_back(spark, settings):
    small_partitions(settings)
    found = B.duplicate_bills(hot_bills(spark))
    rows = found.collect()
    assert sum(r.building_id == "hot" for r in rows) == 20_000
    assert "_part" in plan_text(found, "simple")
    assert "skew=true" in plan_text(found, "simple")


def test_figures_joined_back_without_windows(spark, sf_dir):
    plan = plan_text(R.unusual_consumption(I.bills(spark, sf_dir)), "simple")
    assert "Window" not in plan and "_part" in plan
    assert "Window" not in plan_text(B.duplicate_bills(hot_bills(spark)), "simple")


@pytest.mark.parametrize(
    "name", ["consumption_anomaly", "duplicate_bills", "clean_bills", "usage_trend", "dq_summary"]
)
def test_bills_are_made_once(spark, sf_dir, name):
    """Reports that join bills back to figures of the same bills read them stored."""
    frame = driver.queries()[name](spark, sf_dir)
    frame.collect()
    run = plan_text(frame, "simple").split("Initial Plan")[0]
    twice = name in ("consumption_anomaly", "duplicate_bills")
    assert run.count("lineitem.parquet") == (0 if twice else 1)


@pytest.mark.parametrize("name", ["period_gaps", "period_overlaps"])
def test_periods_read_their_bills_once(spark, sf_dir, name):
    """The sweep reads its periods twice; what made them is shuffled once."""
    frame = driver.queries()[name](spark, sf_dir)
    frame.collect()
    run = plan_text(frame, "simple").split("Initial Plan")[0]
    assert run.count("SortMergeJoin [l_orderkey") == 1


def test_an_amount_is_read_once(spark, sf_dir):
    plan = I.typed_bills(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(AMOUNT) == 4


def test_lookups_are_not_copied_for_the_join(spark, sf_dir):
    enriched = plan_text(I.enriched_bills(spark, sf_dir), "simple")
    assert "_part#" not in enriched and "explode(sequence(0, 7" not in enriched


def test_outliers_shuffle_whole_bills_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    bills = hot_bills(spark).select("vendor_id", "commodity", "source_file", "bill_id", "consumption")
    plan = plan_text(R.robust_outliers(bills))
    assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*source_file", plan)) == 1


def test_landed_files_are_moved_by_their_tasks(spark, tmp_path, monkeypatch):
    options, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda w, k, v: options.update({k: v}) or option(w, k, v))
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("text"), (F.col("id") % 2).alias("bill_type"), F.lit("v").alias("vendor_id")
    )
    for _ in range(2):
        I.land(spark, rows, f"{tmp_path}/files")
    assert sorted(int(r.value) for r in spark.read.text(f"{tmp_path}/files").collect()) == sorted([*range(30)] * 2)
    assert options["mapreduce.fileoutputcommitter.algorithm.version"] == 2


@pytest.mark.parametrize("name", ["bill_exact_dedup", "bill_extract", "extracted_layout", "quarantine_split"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, sf_dir, settings, name):
    """The JVM interprets methods of more than 8,000 bytes for ever."""
    settings(spark__sql__adaptive__enabled="false")
    plan = driver.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    assert sizes and max(sizes) < 8_000


def test_a_replayed_batch_reads_its_bills_stored(spark, sf_dir, monkeypatch):
    from wattledger.plans import queries as Q

    plans, write = [], Q.J.write_judged

    def spy(bills, *where):
        plans.append(plan_text(bills, "simple"))
        return write(bills, *where)

    monkeypatch.setattr(Q.J, "write_judged", spy)
    driver.queries()["quarantine_replay"](spark, sf_dir)
    assert len(plans) == 2 and not any("lineitem.parquet" in plan for plan in plans)


def test_a_batch_of_figures_is_read_by_several_tasks(spark, sf_dir, settings, monkeypatch):
    from wattledger.plans import queries as Q

    feeds, measure = [], Q.G.measure_each_batch

    def spy(feed, target, *rest):
        stored = spark.read.parquet(target.replace("/bills", "/feed"))
        feeds.append(len(stored.inputFiles()))
        return measure(feed, target, *rest)

    monkeypatch.setattr(Q.G, "measure_each_batch", spy)
    settings(spark__sql__files__maxPartitionBytes="50000")
    driver.queries()["batch_figures"](spark, sf_dir)
    assert feeds[0] >= 6


@pytest.mark.parametrize("hot", [True, False])
def test_months_are_cut_after_bills_were_gathered(spark, settings, hot):
    """Parts of bills are not shuffled; those of a store that holds much are not one task's."""
    from wattledger.operators.allocation import allocate_months
    from wattledger.operators.joins import gathered

    small_partitions(settings)
    bills = hot_bills(spark).drop("source_file").withColumn("bill_end_date", F.date_add("bill_start_date", 900))
    bills = bills if hot else bills.where("store_id != 'hot'").withColumn("store_id", F.substring("bill_id", 1, 4))
    parts = allocate_months(gathered(bills, "store_id", "commodity"))
    trend = R.usage_trend(parts)
    rows = trend.collect()
    plan = plan_text(trend, "simple").split("Initial Plan")[0]
    assert ("_dealt" in plan) == hot
    if hot:
        assert "skewed" in plan and len(rows) == 40_001 * 30
    else:
        assert len(re.findall(r"Exchange hash", plan)) == 1
    plain = {tuple(r) for r in R.usage_trend(allocate_months(bills)).collect()}
    assert {tuple(r) for r in rows} == plain


def test_duplicates_are_found_once(spark, settings, tmp_path):
    """The bills found are read twice, and what is joined to all bills is known to be small."""
    bills = hot_bills(spark).withColumn("building_id", F.col("bill_id")).unionAll(
        hot_bills(spark).limit(5).withColumns({"building_id": F.lit("B7"), "bill_id": F.lit("other")})
    )
    bills.write.parquet(f"{tmp_path}/bills")
    found = B.duplicate_bills(spark.read.parquet(f"{tmp_path}/bills"))
    assert {r.bill_id for r in found.collect()} == {"B7", "other"}
    assert f"{tmp_path}/bills" not in plan_text(found)


def test_only_bills_that_meters_read_are_stored(spark, sf_dir, monkeypatch):
    from wattledger.operators import meters

    kept, keep = [], meters.stored
    monkeypatch.setattr(meters, "stored", lambda rows, label: kept.append(rows) or keep(rows, label))
    driver.queries()["metered_vs_billed"](spark, sf_dir)
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    # Others are left out below the aggregate that drops copies.
    assert len(kept) == 1 and "electricity" in plan[plan.index("Aggregate") :].split("Filter", 1)[1]


def test_a_feed_is_cut_while_it_is_written(spark, sf_dir, monkeypatch):
    frame = type(spark.range(1))
    dealt, deal = [], frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda rows, *by: dealt.append(by) or deal(rows, *by))
    driver.queries()["batch_figures"](spark, sf_dir)
    assert not dealt
