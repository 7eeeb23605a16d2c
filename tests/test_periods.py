"""Overlaps, gaps, and bills cut at month ends, against plain Python."""

import calendar
import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import plan_text

from wattledger.operators import periods as P
from wattledger.operators import reports as R
from wattledger.operators.allocation import allocate_months

BILL = (
    "building_id string, store_id string, commodity string, bill_id string, bill_start_date date, "
    "bill_end_date date, consumption double, tax double, cost_usd double"
)
DAY = timedelta(days=1)


def some_bills(seed=1, count=400):
    """A third of the bills are one building's; some have no building, end or order of dates."""
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        building = "hot" if k % 3 == 0 else rng.choice(["a", "b", None])
        start = date(2023, 1, 1) + DAY * rng.randrange(1200)
        end = start + DAY * rng.randrange(-3, 45)
        start, end = rng.choice([(start, end)] * 9 + [(None, end), (start, None)][: rng.randrange(3)])
        amounts = [rng.choice([None, 0.0, round(rng.uniform(-500, 500), 4), 0.0001, -0.0002]) for _ in range(3)]
        rows.append((building, "S", rng.choice(["gas", "water", None]), f"B{k}", start, end, *amounts))
    return rows + rows[:20]


def valid(row):
    return row[4] is not None and row[5] is not None and row[5] >= row[4]


def swept(rows):
    groups = defaultdict(lambda: defaultdict(list))
    for row in rows:
        if valid(row) and row[0] is not None and row[2] is not None:
            groups[row[0], row[2]][row[4], row[5]].append(row[3])
    for key, periods in groups.items():
        reached = None
        for (start, end), ids in sorted(periods.items()):
            yield (*key, start, end, len(ids), min(ids), reached)
            reached = end if reached is None else max(reached, end)


def test_overlaps_and_gaps(spark):
    rows = some_bills()
    bills = spark.createDataFrame(rows, BILL).repartition(5)
    overlaps = {(r.building_id, r.commodity, r.bill_start_date, r.bill_end_date, r.bills, r.first_bill_id,
                 r.reached, r.days) for r in P.period_overlaps(bills).collect()}
    gaps = {tuple(r) for r in P.period_gaps(bills).collect()}
    found = [(s, s[6]) for s in swept(rows) if s[6] is not None]
    assert overlaps == {(*s, (min(r, s[3]) - s[2]).days + 1) for s, r in found if r >= s[2]}
    assert gaps == {
        (s[0], s[1], r + DAY, s[2] - DAY, (s[2] - r).days - 1, s[5]) for s, r in found if s[2] > r + DAY
    }
    assert overlaps and gaps


def test_sweep_starts_anew_each_month(spark):
    """No window holds all bills of a building: one runs over its months, one within a month."""
    text = plan_text(P.period_gaps(spark.createDataFrame(some_bills(), BILL)))
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert len(windows) == 2 and all("_month" in line for line in windows)


def month_parts(start, end):
    while start <= end:
        last = date(start.year, start.month, calendar.monthrange(start.year, start.month)[1])
        yield start, min(last, end)
        start = last + DAY


def dealt(amount, days):
    """Largest remainder in units of 1/10000."""
    if amount is None:
        return [None] * len(days)
    units = int((Decimal(repr(amount)) * 10_000).to_integral_value())
    size, total = abs(units), sum(days)
    shares = [size * n // total for n in days]
    largest = sorted(range(len(days)), key=lambda i: (-(size * days[i] % total), i))
    for i in largest[: size - sum(shares)]:
        shares[i] += 1
    return [Decimal(-s if units < 0 else s) / 10_000 for s in shares]


def expected_parts(rows):
    out = Counter()
    for row in rows:
        if not valid(row):
            amounts = [None if a is None else Decimal(repr(a)).quantize(Decimal("0.0001")) for a in row[6:]]
            out[(*row[:6], *amounts, None)] += 1
            continue
        parts = list(month_parts(row[4], row[5]))
        days = [(b - a).days + 1 for a, b in parts]
        shares = [dealt(a, days) for a in row[6:]]
        for k, (a, b) in enumerate(parts):
            out[(*row[:4], a, b, *[s[k] for s in shares], days[k])] += 1
    return out


def test_parts_add_up_exactly(spark):
    rows = some_bills(2) + [
        ("a", "S", "gas", "long", date(1900, 1, 15), date(2099, 12, 31), 1.0, 1e15, -1e15),
        ("a", "S", "gas", "day", date(2024, 2, 29), date(2024, 2, 29), 0.0003, -0.0001, 99.9999),
        ("a", "S", "gas", "turn", date(2024, 2, 29), date(2024, 3, 1), 0.0003, -0.0001, 99.9999),
        ("a", "S", "gas", "edge", date(2023, 12, 1), date(2023, 12, 31), 12.5, None, 0.0),
    ]
    parts = allocate_months(spark.createDataFrame(rows, BILL).repartition(3))
    assert Counter(tuple(r) for r in parts.collect()) == expected_parts(rows)


def test_reports_on_parts_sum_to_the_bills(spark):
    bills = spark.createDataFrame(some_bills(3), BILL)
    by_month = R.cost_by_month(allocate_months(bills)).groupBy().sum("cost_usd").first()[0]
    assert by_month == R.cost_by_month(bills).groupBy().sum("cost_usd").first()[0]


def test_allocation_shuffles_nothing(spark):
    assert "Exchange" not in plan_text(allocate_months(spark.createDataFrame(some_bills(), BILL)))


def test_parts_are_dealt_by_long_numbers(spark):
    """Lists hold long numbers, one list an amount; shares are made part by part, after the cut."""
    text = plan_text(allocate_months(spark.createDataFrame(some_bills(), BILL)))
    assert "posexplode" in text and "arrays_zip" not in text
    assert "array_sort(transform(" not in text and "concat(transform(" not in text


@pytest.mark.parametrize("columns", [BILL, "bill_start_date date, bill_end_date date, note string"])
def test_no_bills(spark, columns):
    parts = allocate_months(spark.createDataFrame([], columns))
    assert parts.count() == 0 and parts.columns[-1] == "days"
