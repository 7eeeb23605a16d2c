"""Meter readings, batch and stream."""

import os
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from wattledger.operators.meters import dedup_intervals, metered_vs_billed
from wattledger.schemas import METER_FEED, METER_INTERVAL
from wattledger.sources.reference import meter_feed_stream, read_meter_feed
from wattledger.streaming import meters as SM
from wattledger.streaming.meters import first_arrivals, merge_readings, merge_stream, read_readings
from wattledger.streaming.sinks import write_each_batch

START = datetime(2025, 1, 1)


def readings(n=600):
    """A third of the rows are copies of one reading; two meters share a building."""
    pick = random.Random(3)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        at = START if hot else START + timedelta(minutes=15 * pick.randrange(40))
        meter = "hot" if hot else f"m{pick.randrange(4)}"
        rows.append((at, "b", meter, pick.choice([None, 1.0, 2.0, 3.0]), f"f{pick.randrange(5)}"))
    return rows


@pytest.fixture
def feed(spark, tmp_path):
    path = f"{tmp_path}/feed"
    spark.createDataFrame(readings(), METER_FEED).repartition(6).write.parquet(path)
    return path


def test_dedup_brute_force(spark, feed):
    best = {}
    for at, building, meter, kwh, source in readings():
        rank = (kwh is not None, source, -1 if kwh is None else kwh)
        if (at, meter) not in best or rank > best[at, meter][0]:
            best[at, meter] = (rank, kwh, source)
    kept = dedup_intervals(read_meter_feed(spark, feed))
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in METER_INTERVAL]
    rows = kept.collect()
    assert {(r.timestamp, r.meter_id): (r.kwh, r.source_file) for r in rows} == {
        key: (kwh, source) for key, (_, kwh, source) in best.items()
    }
    assert len(rows) == len(best)
    assert all((r.is_missing_kwh == "true") == (r.kwh is None) for r in rows)


@pytest.mark.parametrize("thin", [False, True])
def test_stream_keeps_the_same_keys(spark, feed, tmp_path, thin):
    stream = meter_feed_stream(spark, feed, max_files=2)
    write_each_batch(first_arrivals(stream, "1 day", thin), f"{tmp_path}/out", f"{tmp_path}/cp")
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.timestamp, r.meter_id) for r in rows) == sorted({(r[0], r[2]) for r in readings()})


def test_stream_remembers_between_runs(spark, feed, tmp_path):
    stream = meter_feed_stream(spark, feed)

    def run():
        return sum(write_each_batch(first_arrivals(stream), f"{tmp_path}/out", f"{tmp_path}/cp").values())

    assert run() == len({(r[0], r[2]) for r in readings()})
    again = spark.createDataFrame(readings()[:50] + [(START, "b", "new", 1.0, "x")], METER_FEED)
    again.write.mode("append").parquet(feed)
    assert run() == 1


def kept(spark, table):
    return sorted(
        (r.timestamp, r.meter_id, r.kwh, r.source_file, r.is_missing_kwh)
        for r in read_readings(spark, table).collect()
    )


def files_of(table):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(table)
        for name in names
        if name.endswith(".parquet")
    }


def spread_readings(seed, days, n=300):
    pick = random.Random(seed)
    return [
        (START + timedelta(days=pick.choice(days), minutes=15 * pick.randrange(20)), "b", f"m{pick.randrange(3)}",
         pick.choice([None, 1.0, 2.0]), f"f{pick.randrange(4)}")
        for _ in range(n)
    ]


def test_merged_batches_equal_one_batch_and_leave_other_days_alone(spark, tmp_path):
    table, work = f"{tmp_path}/kept", f"{tmp_path}/work"
    batches = [spread_readings(1, range(10)), spread_readings(2, [3, 4]), spread_readings(3, [4, -4000])]
    odd = [(None, "b", "m0", 1.0, "f"), (START, "b", None, 1.0, "f")]
    for k, rows in enumerate(batches):
        before = files_of(table) if k else {}
        touched = merge_readings(spark.createDataFrame(rows + odd, METER_FEED), k, table, work)
        assert touched == sorted({str(r[0].date()) for r in rows})
        after = files_of(table)
        for path, at in before.items():
            same = not any(f"{SM.DAY}={day}/" in path for day in touched)
            assert (after.get(path) == at) == same
    everything = dedup_intervals(spark.createDataFrame(sum(batches, []), METER_FEED))
    assert kept(spark, table) == sorted(
        (r.timestamp, r.meter_id, r.kwh, r.source_file, r.is_missing_kwh) for r in everything.collect()
    )
    # Again, and with nothing.
    before = kept(spark, table)
    merge_readings(spark.createDataFrame(batches[1], METER_FEED), 1, table, work)
    assert merge_readings(spark.createDataFrame([], METER_FEED), 9, table, work) == []
    assert kept(spark, table) == before


def test_merge_that_stopped_half_way_is_finished(spark, tmp_path, monkeypatch):
    """A day's folder was deleted, and not yet written, when the batch stopped."""
    table, work = f"{tmp_path}/kept", f"{tmp_path}/work"
    first, second = spread_readings(5, [0, 1]), spread_readings(6, [1])
    merge_readings(spark.createDataFrame(first, METER_FEED), 0, table, work)
    with monkeypatch.context() as stopped:
        stopped.setattr(SM, "delete_path", lambda *_: None)
        merge_readings(spark.createDataFrame(second, METER_FEED), 1, table, work)
    whole = kept(spark, table)
    for path in files_of(f"{table}/{SM.DAY}={(START + timedelta(days=1)).date()}"):
        os.remove(path)
    assert kept(spark, table) != whole
    merge_readings(spark.createDataFrame(second, METER_FEED), 1, table, work)
    assert kept(spark, table) == whole


def test_merge_stream_takes_any_lateness(spark, tmp_path):
    for k, days in enumerate([range(20), [0, 5], [-3000]]):
        spark.createDataFrame(spread_readings(k, days, 60), METER_FEED).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/feed"
        )
    stream = meter_feed_stream(spark, f"{tmp_path}/feed", max_files=1)
    days = merge_stream(stream, f"{tmp_path}/kept", f"{tmp_path}/work", f"{tmp_path}/cp")
    assert len(days) == 3
    everything = dedup_intervals(read_meter_feed(spark, f"{tmp_path}/feed"))
    assert read_readings(spark, f"{tmp_path}/kept").count() == everything.count()


def test_metered_against_billed(spark):
    pick = random.Random(8)
    reads = [
        (START + timedelta(days=pick.randrange(90), minutes=pick.randrange(1440)), pick.choice(["a", "b", None]),
         f"m{pick.randrange(3)}", pick.choice([None, round(pick.uniform(0, 9), 4)]), "f")
        for _ in range(500)
    ]
    bills = []
    for k in range(60):
        start = date(2025, 1, 1) + timedelta(days=pick.randrange(-20, 100))
        end = start + timedelta(days=pick.choice([-1, 0, 5, 31, 70]))
        bills.append((f"B{k}", pick.choice(["a", "b", "c", None]), pick.choice(["electricity", "gas"]), start, end,
                      pick.choice([None, 12.5])))
    bills += bills[:10]
    frame = spark.createDataFrame(
        bills, "bill_id string, building_id string, commodity string, bill_start_date date, bill_end_date date,"
        " consumption double",
    )
    sums = defaultdict(lambda: [Decimal(0), 0, 0])
    for at, building, _, kwh, _ in reads:
        own = sums[building, at.date()]
        own[0] += Decimal(repr(kwh or 0))
        own[1] += kwh is not None
        own[2] += kwh is None
    expected = []
    for bill_id, building, commodity, start, end, used in bills:
        if commodity != "electricity" or building is None or end < start:
            continue
        days = [own for (b, day), own in sums.items() if b == building and start <= day <= end]
        readings = sum(own[1] for own in days)
        metered = sum(own[0] for own in days) if readings else None
        gap = None if metered is None or used is None else Decimal(repr(used)) - metered
        expected.append((bill_id, building, metered, gap, readings, sum(own[2] for own in days), len(days)))
    got = metered_vs_billed(frame, spark.createDataFrame(reads, METER_FEED))
    rows = [(r.bill_id, r.building_id, r.metered_kwh, r.difference, r.readings, r.missing_readings, r.metered_days)
            for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    text = plan_text(got.where(F.lit(True)))
    assert "NestedLoop" not in text and "Cartesian" not in text and "_month" in text
