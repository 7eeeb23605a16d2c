"""Turning text read from a document into typed, standardised values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.schemas import EXPECTED_UNIT

# Digits in groups of three or in a row, a decimal point, an exponent.
_DIGITS = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?"
# An amount in full: a sign and a currency sign in either order before the digits. Anything
# else (`1.234,56`, `12d`) is not read as one.
AMOUNT = rf"^\s*(?:[-+]?\$?|\$[-+])\s*{_DIGITS}\s*$"
# A credit: in parentheses, or with a sign or CR behind.
CREDIT = rf"^\s*(?:\(\s*\$?\s*{_DIGITS}\s*\)|\$?\s*{_DIGITS}\s*(?:-|[cC][rR]))\s*$"
# What a money column (28 digits, 4 of them decimals) cannot hold is no amount.
AMOUNT_LIMIT = 1e24
DAY = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$"
# From here on an amount is flagged as unlikely; it is kept all the same.
UNLIKELY_AMOUNT = 1e12


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])


def to_number(text: Column) -> Column:
    """A double, or null for text that is not an amount as a whole, or is one too large for
    money; never an error. Credits are negative however they are printed."""
    return within_money(read_amount(text))


def within_money(amount: Column) -> Column:
    """The amount, or null if it is too large for money. It is named twice here, so where many
    rows are typed it should be a column of an earlier select: then it is read once."""
    return F.when(F.abs(amount) < AMOUNT_LIMIT, amount)


def read_amount(text: Column) -> Column:
    """to_number without its limit."""
    sign = F.when(text.rlike(AMOUNT), 1.0).when(text.rlike(CREDIT), -1.0)
    bare = F.regexp_replace(text, r"[$, ()]|(?i)(?:-|cr)\s*$", "")
    # Most amounts are printed without signs to be taken out.
    return F.coalesce(text.try_cast("double"), bare.try_cast("double")) * sign


def to_date(text: Column) -> Column:
    """A day written in full, or null; a year or a month alone is no day."""
    return F.when(text.rlike(DAY), text.try_cast("date"))


def standard_commodity(text: Column) -> Column:
    return F.lower(F.trim(text))


def standard_unit(text: Column) -> Column:
    """The contract's spelling of a known unit; an unknown one is kept as it came."""
    trimmed = F.trim(text)
    spelling = literal_map({unit.lower(): unit for unit in EXPECTED_UNIT.values()})
    return F.coalesce(F.try_element_at(spelling, F.lower(trimmed)), trimmed)


def expected_unit(commodity: Column) -> Column:
    return F.try_element_at(literal_map(EXPECTED_UNIT), commodity)


def money(amount: Column) -> Column:
    """Exact decimal form of an amount, so that sums do not depend on row order. Sums have
    ten digits more and don't overflow."""
    return amount.try_cast("decimal(28,4)")


def flag(condition: Column) -> Column:
    """The tables keep booleans as text; an unknown condition counts as false."""
    return F.when(condition, F.lit("true")).otherwise(F.lit("false"))
