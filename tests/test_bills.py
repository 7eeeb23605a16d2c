"""Typing, flags, copies, duplicates and reports against plain Python on small, skewed data."""

import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattledger.functions.values import standard_unit, to_date, to_number
from wattledger.operators import bills as B
from wattledger.operators import reports as R
from wattledger.plans import inputs as I
from wattledger.schemas import CLEAN_BILL
from wattledger.streaming.jobs import write_judged

BILL = (
    "bill_id string, store_id string, building_id string, commodity string, vendor_id string, "
    "vendor string, bill_start_date date, bill_end_date date, consumption_raw string, "
    "consumption double, unit string, subtotal double, tax double, cost_raw string, "
    "cost_usd double, source_file string, bill_type_partition string, ingestion_ts timestamp"
)


def bill(**changes):
    row = {
        "bill_id": "B1",
        "store_id": "S1",
        "building_id": "H1",
        "commodity": "gas",
        "vendor_id": "V1",
        "vendor": "Vendor",
        "bill_start_date": date(2025, 1, 1),
        "bill_end_date": date(2025, 1, 31),
        "consumption_raw": "10",
        "consumption": 10.0,
        "unit": "therms",
        "subtotal": 9.0,
        "tax": 1.0,
        "cost_raw": "10",
        "cost_usd": 10.0,
        "source_file": "f",
        "bill_type_partition": "gas",
        "ingestion_ts": None,
    }
    return tuple({**row, **changes}.values())


def bills(spark, *rows):
    return spark.createDataFrame(list(rows), BILL)


@pytest.mark.parametrize(
    "text, number",
    [
        ("12.50", 12.5),
        (" 12 ", 12.0),
        ("-3", -3.0),
        ("$1,234.50", 1234.5),
        ("1e3", 1000.0),
        ("N/A", None),
        ("", None),
        ("NaN", None),
        ("Infinity", None),
        ("1e13", 1e13),
        ("1000000000000", 1e12),
        ("1.234,56", None),
        ("12d", None),
        ("1,23", None),
        ("-$5.00", -5.0),
        ("(12.00)", -12.0),
        ("( $1,200.50 )", -1200.5),
        ("($5)", -5.0),
        ("12.00-", -12.0),
        ("$12.00 -", -12.0),
        ("5.00 CR", -5.0),
        ("5cr", -5.0),
        ("(5", None),
        ("5)", None),
        ("(-5)", None),
        ("-5-", None),
        ("CR", None),
        ("1e25", None),
        ("1e400", None),
        ("-1e24", None),
        ("9e23", 9e23),
        ("$-5", -5.0),
        (None, None),
    ],
)
def test_to_number(spark, text, number):
    frame = spark.createDataFrame([(text,)], "t string").select(to_number(F.col("t")))
    assert frame.first()[0] == number


@pytest.mark.parametrize(
    "text, day", [("2025-02-28", date(2025, 2, 28)), ("2025-02-30", None), ("x", None), (None, None)]
)
def test_to_date(spark, text, day):
    frame = spark.createDataFrame([(text,)], "t string").select(to_date(F.col("t")))
    assert frame.first()[0] == day


@pytest.mark.parametrize(
    "text, unit", [("KWH", "kWh"), (" Therms", "therms"), ("gallons", "gallons"), ("MWh ", "MWh"), (None, None)]
)
def test_standard_unit(spark, text, unit):
    frame = spark.createDataFrame([(text,)], "t string").select(standard_unit(F.col("t")))
    assert frame.first()[0] == unit


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, []),
        ({"consumption": -1.0}, []),
        ({"consumption": 0.0}, []),
        ({"bill_id": None}, ["missing_required_field"]),
        ({"vendor": None}, ["unknown_vendor"]),
        ({"bill_type_partition": "steam"}, ["unknown_utility_type"]),
        ({"bill_type_partition": None}, []),
        ({"bill_end_date": date(2024, 1, 1)}, ["invalid_period"]),
        ({"bill_end_date": None}, ["missing_required_field", "invalid_period"]),
        (
            {"consumption_raw": "N/A", "consumption": None},
            ["missing_required_field", "consumption_not_numeric"],
        ),
        ({"cost_raw": "x", "cost_usd": None}, ["missing_required_field", "charge_not_numeric"]),
        ({"unit": "kWh"}, ["wrong_unit"]),
        ({"cost_usd": 10.01}, ["wrong_total"]),
        ({"subtotal": 0.1, "tax": 0.2, "cost_usd": 0.3}, []),
        ({"building_id": None}, ["unmapped_building"]),
    ],
)
def test_reasons(spark, changes, reasons):
    frame = bills(spark, bill(**changes))
    assert B.add_reasons(frame).first().reasons == reasons
    valid, quarantined = B.split_quarantine(frame)
    assert (valid.count(), quarantined.count()) == ((0, 1) if reasons else (1, 0))
    counted = {r.reason: r.bills for r in B.quality_summary(frame).collect()}
    assert {name for name, n in counted.items() if n} == set(reasons)


def test_clean_bill_layout(spark):
    frame = B.clean_bills(
        bills(spark, bill(consumption=-2.0), bill(consumption=0.0), bill(consumption=None, vendor=None))
    )
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in CLEAN_BILL]
    negative, zero, missing = sorted(frame.collect(), key=lambda r: (r.consumption is None, r.consumption))
    assert negative.is_negative_consumption == "true" and negative.missing_fields is None
    assert zero.is_zero_consumption == "true" and zero.is_negative_consumption == "false"
    assert missing.is_zero_consumption == "false" and missing.is_negative_consumption == "false"
    assert missing.has_missing_required_field == "true" and missing.missing_fields == "consumption"
    assert missing.vendor == "V1"
    checked = spark.createDataFrame(frame.collect(), CLEAN_BILL)  # nothing required is null
    assert checked.count() == 3


def test_exact_copies(spark):
    hot = [bill(bill_id=None, source_file="hot")] * 500
    rows = hot + [bill(source_file="a"), bill(source_file="a", tax=2.0)]
    kept = B.drop_exact_copies(bills(spark, *rows).repartition(8)).collect()
    assert Counter(r.source_file for r in kept) == {"hot": 1, "a": 2}


def test_copies_keep_the_first_time(spark):
    frame = bills(spark, bill(), bill()).drop("ingestion_ts")
    timed = frame.withColumn("ingestion_ts", F.timestamp_seconds(F.monotonically_increasing_id() + 5))
    first = timed.agg(F.min("ingestion_ts")).first()[0]
    (kept,) = B.drop_exact_copies(timed).collect()
    assert kept.ingestion_ts == first


def skewed_rows(n=900):
    """A third of the bills in one group, the others spread."""
    pick = random.Random(7)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(
            bill(
                bill_id=None if pick.random() < 0.05 else f"B{pick.randrange(n)}",
                building_id="hot" if hot else (None if pick.random() < 0.1 else f"H{pick.randrange(60)}"),
                store_id="hot" if hot else f"S{pick.randrange(60)}",
                vendor_id="hot" if hot else f"V{pick.randrange(5)}",
                commodity="gas" if hot else pick.choice(["gas", "water"]),
                bill_start_date=date(2025, 1 if hot else pick.randrange(1, 4), 1),
                consumption=pick.choice([None, 5.0, 6.0, 7.0, 5.5, 300.0 if i % 50 == 0 else 6.5]),
                source_file=f"f{i}",
            )
        )
    return rows


def as_dicts(spark, rows):
    return [r.asDict() for r in bills(spark, *rows).collect()]


def test_duplicate_bills_brute_force(spark):
    rows = skewed_rows()
    groups = defaultdict(list)
    for r in as_dicts(spark, rows):
        key = tuple(r[k] for k in B.PERIOD_KEYS)
        if None not in key and r["bill_id"] is not None:
            groups[key].append(r)
    expected = Counter(
        (r["source_file"], min(x["bill_id"] for x in g), max(x["bill_id"] for x in g), len(g))
        for g in groups.values()
        if len({x["bill_id"] for x in g}) > 1
        for r in g
    )
    found = B.duplicate_bills(bills(spark, *rows).repartition(8)).collect()
    assert expected and expected == Counter(
        (r.source_file, r.first_bill_id, r.last_bill_id, r.bills_in_period) for r in found
    )


def test_unusual_consumption_brute_force(spark):
    rows = skewed_rows()
    groups = defaultdict(list)
    for r in as_dicts(spark, rows):
        if r["consumption"] is not None:
            groups[r["vendor_id"], r["commodity"]].append(r)
    expected = {}
    for group in groups.values():
        values = [r["consumption"] for r in group]
        if len(values) > 1 and statistics.stdev(values) > 0:
            for r in group:
                z = (r["consumption"] - statistics.mean(values)) / statistics.stdev(values)
                if abs(z) > 2:
                    expected[r["source_file"]] = z
    found = R.unusual_consumption(bills(spark, *rows).repartition(8)).collect()
    assert expected and {r.source_file for r in found} == set(expected)
    assert all(math.isclose(r.z_score, expected[r.source_file], abs_tol=1e-4) for r in found)


def test_usage_trend_brute_force(spark):
    rows = skewed_rows()
    monthly = defaultdict(dict)
    for r in as_dicts(spark, rows):
        months = monthly[r["store_id"], r["commodity"]]
        value = months.setdefault(r["bill_start_date"], None)
        if r["consumption"] is not None:
            months[r["bill_start_date"]] = (value or 0) + r["consumption"]
    expected = {}
    for key, months in monthly.items():
        number = {m.year * 12 + m.month: v for m, v in months.items() if m}
        for month, value in months.items():
            at = month and month.year * 12 + month.month
            window = [number.get(at - k) for k in range(3)] if month else []
            window = [v for v in window if v is not None]
            before = number.get(at - 1) if month else None
            expected[(*key, month)] = (value, before, sum(window) if window else None)
    found = {
        (r.store_id, r.commodity, r.bill_month): tuple(
            None if v is None else float(v) for v in (r.consumption, r.previous, r.last_three)
        )
        for r in R.usage_trend(bills(spark, *rows)).collect()
    }
    assert found == expected


def test_reports_keep_every_bill(spark):
    rows = skewed_rows()
    frame = bills(spark, *rows)
    buildings = spark.createDataFrame(
        [("hot", "H")] + [(f"S{i}", f"H{i % 7}") for i in range(40)], "store_id string, building_id string"
    )
    vendors = spark.createDataFrame([("hot", "Hot")], "vendor_id string, vendor string")
    for report in (
        R.totals_by_store(frame),
        R.cost_by_month(frame),
        R.consumption_by_building(frame.drop("building_id"), buildings),
        R.compare_vendors(frame.drop("vendor"), vendors),
    ):
        assert report.agg(F.sum("bills")).first()[0] == len(rows)
    per_building = R.consumption_by_building(frame.drop("building_id"), buildings)
    assert per_building.count() == per_building.select("building_id", "commodity", "bill_month").distinct().count()


def test_unmapped_stores(spark):
    rows = skewed_rows()
    buildings = spark.createDataFrame([("hot", "H")], "store_id string, building_id string")
    found = {r.store_id: r.bills for r in B.unmapped_stores(bills(spark, *rows), buildings).collect()}
    assert found == {k: n for k, n in Counter(r[1] for r in rows).items() if k != "hot"}


@pytest.mark.parametrize(
    "name, parts",
    [
        ("CPC001_STR-001_electricity_2025-01_BILL-1001.pdf", ("CPC001", "STR-001", "electricity", "2025-01", "BILL-1001")),
        ("a/b/REC002_STR-002_electricity_2025-01_BILL-1037.pdf", ("REC002", "STR-002", "electricity", "2025-01", "BILL-1037")),
        ("AMW001_STR-001_water_2025-01_A_B.pdf", ("AMW001", "STR-001", "water", "2025-01", "A_B")),
        ("AMW001_STR-001_water_2025_B.pdf", (None,) * 5),
        ("scan.pdf", (None,) * 5),
    ],
)
def test_file_name_tokens(spark, name, parts):
    row = B.file_name_tokens(bills(spark, bill(source_file=name))).first()
    assert tuple(row[f"name_{p}"] for p in B.FILE_NAME_PARTS) == parts


@hypothesis_settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_typing_never_fails(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    typed = frame.select(to_number(F.col("t")), to_date(F.col("t")), standard_unit(F.col("t")))
    assert len(typed.collect()) == len(texts)


def test_vendor_ids_do_not_collide(spark):
    ids = spark.range(0, 20_000).select(I._vendor_id("id").alias("v"))
    assert ids.distinct().count() == 20_000


def test_to_date_needs_a_day(spark):
    rows = [("2025-01-31",), (" 2025-01-31 ",), ("2025",), ("2025-01",), ("2025-02-30",), ("x",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(to_date(F.col("t")).cast("string")).collect()
    assert [r[0] for r in got] == ["2025-01-31", "2025-01-31", None, None, None, None, None]


def test_sums_of_large_amounts_do_not_overflow(spark):
    rows = [("s", "gas", "2025-01-05", 1e15, 2e15)] * 40
    frame = spark.createDataFrame(
        rows, "store_id string, commodity string, d string, consumption double, cost_usd double"
    )
    total = R.totals_by_store(frame).first()
    assert (float(total.consumption), float(total.cost_usd)) == (4e16, 8e16)


def test_outlier_beside_a_large_mean(spark):
    rows = [("v", "gas", f"f{k}", f"b{k}", 9e8 + (k % 3) * 0.1) for k in range(40)]
    rows.append(("v", "gas", "out", "out", 9e8 + 1.0))
    frame = spark.createDataFrame(
        rows, "vendor_id string, commodity string, source_file string, bill_id string, consumption double"
    )
    assert [r.bill_id for r in R.unusual_consumption(frame).collect()] == ["out"]


def test_trend_by_calendar_month(spark):
    rows = [("2025-01-05", 1.0), ("2025-02-01", 2.0), ("2025-04-09", 4.0), ("2025-05-01", 8.0), (None, 16.0)]
    frame = spark.createDataFrame([("s", "gas", d, c) for d, c in rows],
                                  "store_id string, commodity string, d string, consumption double")
    trend = R.usage_trend(frame.withColumn("bill_start_date", F.to_date("d"))).collect()
    got = {str(r.bill_month): (r.previous, r.last_three) for r in trend}
    assert {k: tuple(None if x is None else float(x) for x in v) for k, v in got.items()} == {
        "2025-01-01": (None, 1.0), "2025-02-01": (1.0, 3.0), "2025-04-01": (None, 6.0),
        "2025-05-01": (4.0, 12.0), "None": (None, None),
    }


def test_replayed_batch_after_reference_data_changed(spark, tmp_path):
    """Bills that change sides are on the new side only."""
    bills = I.bills(spark, "/root/testdata/sf0.001")
    mapped = B.add_buildings(bills, I.buildings(spark, "/root/testdata/sf0.001"))
    few = I.vendors(spark, "/root/testdata/sf0.001").limit(3)
    sides = []
    for vendors in (few, I.vendors(spark, "/root/testdata/sf0.001"), few.limit(0)):
        written = write_judged(B.add_vendors(mapped, vendors), 0, f"{tmp_path}/judged")
        stored = spark.read.parquet(f"{tmp_path}/judged")
        assert stored.count() == written == bills.count()
        sides.append(stored.where("destination = 'valid'").count())
    assert sides[2] == 0 < sides[0] < sides[1]


def test_lookups_that_list_a_key_twice_double_nothing(spark):
    """Two buildings for a store, two names for a vendor, and rows without a key."""
    rows = bills(spark, bill(source_file="a"), bill(source_file="b", store_id="S2"), bill(store_id=None))
    rows = rows.drop("building_id", "vendor")
    buildings = spark.createDataFrame(
        [("S1", "H9"), ("S1", "H1"), ("S1", "H1"), ("S2", "H2"), (None, "H3")], "store_id string, building_id string"
    )
    vendors = spark.createDataFrame([("V1", "Z"), ("V1", "A"), (None, "N")], "vendor_id string, vendor string")
    got = B.add_vendors(B.add_buildings(rows, buildings), vendors).collect()
    assert sorted((r.source_file, r.building_id, r.vendor) for r in got if r.store_id) == [("a", "H1", "A"), ("b", "H2", "A")]
    assert [r.building_id for r in got if not r.store_id] == [None] and len(got) == 3
    assert [tuple(r) for r in B.ambiguous_buildings(buildings).collect()] == [("S1", 2, "H1", "H9")]
    assert [tuple(r) for r in B.ambiguous_vendors(vendors).collect()] == [("V1", 2, "A", "Z")]
    report = R.consumption_by_building(rows, buildings).agg(F.sum("bills")).first()[0]
    assert report == 3
    assert R.compare_vendors(rows, vendors).agg(F.sum("bills")).first()[0] == 3


def test_amounts_too_large_for_money_are_quarantined_with_a_reason(spark):
    """Nothing drops out of a sum unnoticed."""
    rows = bills(spark, bill(cost_raw="1e25", cost_usd=None, consumption_raw="1e400", consumption=None))
    reasons = B.add_reasons(rows).first().reasons
    assert {"charge_not_numeric", "consumption_not_numeric"} <= set(reasons)
