"""Flags, statuses and validation rules of a typed bill. None of them drops a row."""

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.functions.values import UNLIKELY_AMOUNT, expected_unit, flag, money
from wattledger.schemas import EXPECTED_UNIT, REQUIRED_FIELDS


def missing_fields() -> Column:
    """Comma list of the required fields that are null; null when none is."""
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED_FIELDS]
    return F.nullif(F.array_join(F.array_compact(F.array(*names)), ","), F.lit(""))


def _missing(how: Callable[[Column, Column], Column]) -> Column:
    """Whether any (or_) or all (and_) of the required fields are null."""
    return reduce(how, [F.col(name).isNull() for name in REQUIRED_FIELDS])


def parse_status() -> Column:
    return (
        F.when(_missing(and_), F.lit("FAILED"))
        .when(_missing(or_), F.lit("PARTIAL"))
        .otherwise(F.lit("SUCCESS"))
    )


def parse_error() -> Column:
    return F.concat(F.lit("missing: "), missing_fields())


def quality_flags() -> dict[str, Column]:
    return {
        "is_negative_consumption": flag(F.col("consumption") < 0),
        "is_zero_consumption": flag(F.col("consumption") == 0),
        "has_missing_required_field": flag(_missing(or_)),
        "missing_fields": missing_fields(),
    }


def valid_period() -> Column:
    """Both ends present and in order; false, not null, when an end is missing."""
    return F.coalesce(F.col("bill_end_date") >= F.col("bill_start_date"), F.lit(False))


def wrong_unit() -> Column:
    """The unit is there but is not the one the commodity is billed in."""
    return F.col("unit") != expected_unit(F.col("commodity"))


def wrong_total() -> Column:
    """All three amounts are there and the total is not subtotal plus tax."""
    return money(F.col("cost_usd")) != money(F.col("subtotal")) + money(F.col("tax"))


def unlikely_amount() -> Column:
    """An amount so large that it is probably misread."""
    return F.greatest(F.abs("consumption"), F.abs("cost_usd")) >= UNLIKELY_AMOUNT


def known_utility_type(name: str = "bill_type_partition") -> Column:
    return F.col(name).isin(*EXPECTED_UNIT)


def unparsed(raw: str, typed: str) -> Column:
    """Text was there, but it is not a number (or date) of the kind the column needs."""
    return F.col(raw).isNotNull() & F.col(typed).isNull()


def quarantine_rules() -> dict[str, Column]:
    """Why a bill may not go on, by the name reported. Needs a bill enriched with
    `building_id` and `vendor`, null where the reference data has no match."""
    return {
        "missing_required_field": _missing(or_),
        "unknown_vendor": F.col("vendor").isNull(),
        "unknown_utility_type": ~known_utility_type(),
        "invalid_period": ~valid_period(),
        "consumption_not_numeric": unparsed("consumption_raw", "consumption"),
        "charge_not_numeric": unparsed("cost_raw", "cost_usd"),
        "unlikely_amount": unlikely_amount(),
        "wrong_unit": wrong_unit(),
        "wrong_total": wrong_total(),
        "unmapped_building": F.col("building_id").isNull(),
    }
