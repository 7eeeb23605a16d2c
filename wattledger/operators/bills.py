"""Typed, cleansed and checked bills."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattledger.functions.paths import FILE_NAME_PARTS, file_name_part, last_segment
from wattledger.functions.quality import (
    known_utility_type,
    quality_flags,
    quarantine_rules,
    valid_period,
    wrong_total,
    wrong_unit,
)
from wattledger.functions.values import (
    expected_unit,
    flag,
    read_amount,
    standard_commodity,
    standard_unit,
    to_date,
    within_money,
)
from wattledger.operators.joins import (
    ambiguous_keys,
    dealt_anew,
    join_groups,
    join_lookup,
    one_per_key,
)
from wattledger.schemas import AMOUNTS, CLEAN_BILL, EXTRACTED_BILL
from wattledger.session import stored

INGESTION_TIMES = ("ingestion_ts", "silver_ingestion_ts")
PERIOD_KEYS = ("building_id", "commodity", "bill_start_date", "bill_end_date")


def type_bills(raw: DataFrame) -> DataFrame:
    """Dates and numbers from text (null when they are none), one spelling of commodity
    and unit. The raw text of the amounts and all lineage columns stay."""
    typed = raw.select(
        "bill_id",
        "store_id",
        standard_commodity(F.col("commodity_raw")).alias("commodity"),
        "vendor_id",
        to_date(F.col("bill_start_raw")).alias("bill_start_date"),
        to_date(F.col("bill_end_raw")).alias("bill_end_date"),
        "consumption_raw",
        read_amount(F.col("consumption_raw")).alias("consumption"),
        standard_unit(F.col("unit_raw")).alias("unit"),
        read_amount(F.col("subtotal_raw")).alias("subtotal"),
        read_amount(F.col("tax_raw")).alias("tax"),
        "cost_raw",
        read_amount(F.col("cost_raw")).alias("cost_usd"),
        "source_file",
        "bill_type_partition",
        "ingestion_ts",
    )
    return typed.withColumns({name: within_money(F.col(name)) for name in AMOUNTS})


def drop_exact_copies(bills: DataFrame) -> DataFrame:
    """One row for rows equal in everything but the ingestion times (the same file parsed
    twice); the earliest time is kept. Copies collapse in each task before the shuffle,
    so a row copied very often moves as one row per task."""
    times = [name for name in INGESTION_TIMES if name in bills.columns]
    rest = [name for name in bills.columns if name not in times]
    if not times:
        return bills.distinct()
    kept = bills.groupBy(*rest).agg(*[F.min(name).alias(name) for name in times])
    return kept.select(*bills.columns)


def bill_columns(bills: DataFrame) -> list[str]:
    """Columns that tell the bills of one key apart."""
    return [name for name in ("source_file", "file_path", "bill_id") if name in bills.columns]


def add_buildings(bills: DataFrame, buildings: DataFrame, key: str = "store_id") -> DataFrame:
    """`building_id` from the reference by store, or any other key; null where there is no
    match. A key that the reference gives several buildings has the smallest and is listed by
    ambiguous_buildings. (By what is printed on the bill: operators.linkage.)"""
    return join_lookup(bills, dealt_anew(one_per_key(buildings, key, "building_id")), key)


def ambiguous_buildings(buildings: DataFrame, key: str = "store_id") -> DataFrame:
    """Keys of the reference with several buildings: `values`, the one `taken`, the `last`."""
    return ambiguous_keys(buildings, key, "building_id")


def add_vendors(bills: DataFrame, vendors: DataFrame) -> DataFrame:
    """The vendor's name; null for an unknown vendor ID, the smallest of several names."""
    return join_lookup(bills, dealt_anew(one_per_key(vendors, "vendor_id", "vendor")), "vendor_id")


def ambiguous_vendors(vendors: DataFrame) -> DataFrame:
    return ambiguous_keys(vendors, "vendor_id", "vendor")


def unmapped_stores(bills: DataFrame, buildings: DataFrame) -> DataFrame:
    """Stores that no building is mapped to, with their bill count. Bills are counted per
    store first, so the join sees each store once."""
    stores = bills.groupBy("store_id").agg(F.count(F.lit(1)).alias("bills"))
    return stores.join(buildings.select("store_id"), "store_id", "left_anti")


def flag_bills(bills: DataFrame) -> DataFrame:
    return bills.withColumns(quality_flags())


def _in_layout(rows: DataFrame, layout: StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])


def extracted_layout(enriched: DataFrame) -> DataFrame:
    """EXTRACTED_BILL rows from extracted bills with `building_id` and `vendor` added. The
    layout wants a vendor on every row, so an unknown vendor is shown by its ID."""
    return _in_layout(
        enriched.withColumn("vendor", F.coalesce("vendor", "vendor_id")), EXTRACTED_BILL
    )


def clean_bills(enriched: DataFrame) -> DataFrame:
    """CLEAN_BILL rows from typed, copy-free, enriched bills, an unknown vendor again shown
    by its ID."""
    flagged = flag_bills(enriched).withColumns(
        {
            "vendor": F.coalesce("vendor", "vendor_id"),
            "silver_ingestion_ts": F.current_timestamp(),
        }
    )
    return _in_layout(flagged, CLEAN_BILL)


def partition_mismatches(bills: DataFrame) -> DataFrame:
    """Bills whose commodity is not the folder they came from."""
    return bills.where(F.col("commodity") != F.col("bill_type_partition"))


def unit_mismatches(bills: DataFrame) -> DataFrame:
    return bills.where(wrong_unit()).withColumn(
        "expected_unit", expected_unit(F.col("commodity"))
    )


def total_mismatches(bills: DataFrame) -> DataFrame:
    return bills.where(wrong_total())


def check_period(bills: DataFrame) -> DataFrame:
    return bills.withColumn("is_valid_period", flag(valid_period()))


def unknown_types(bills: DataFrame) -> DataFrame:
    return bills.where(~known_utility_type())


def file_name_tokens(bills: DataFrame, path: str = "source_file") -> DataFrame:
    """The parts of the file name, as a cross-check of lineage: the folder and the
    document stay the source of these values."""
    name = last_segment(F.col(path))
    return bills.withColumns(
        {f"name_{part}": file_name_part(name, part) for part in FILE_NAME_PARTS}
    )


def add_reasons(bills: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """`reasons`: names of the rules a bill breaks, empty for a valid one."""
    rules = quarantine_rules() if rules is None else rules
    names = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return bills.withColumn("reasons", F.array_compact(names))


def is_quarantined() -> Column:
    return F.size("reasons") > 0


def split_quarantine(bills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined). Every bill is in exactly one of them."""
    judged = add_reasons(bills)
    return judged.where(~is_quarantined()).drop("reasons"), judged.where(is_quarantined())


def quality_summary(bills: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Bills per broken rule, rules nobody breaks included. All counts come from one pass
    in which a task sends one row."""
    rules = quarantine_rules() if rules is None else rules
    counted = bills.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    pairs = [F.struct(F.lit(n).alias("reason"), F.col(n).alias("bills")) for n in rules]
    return counted.select(F.inline(F.array(*pairs)))


def duplicate_bills(bills: DataFrame, spread_by: Sequence[str] = ("bill_id",)) -> DataFrame:
    """Bills of one building, commodity and period that carry different bill IDs.

    Rows without a building, a date or an ID cannot be told apart and are left out. The
    groups are found by an aggregate (not a window, which would put a whole group into
    one task) and only the offending ones are joined back. They are stored first: Spark then knows
    how few they are, and shuffles all bills for them only if they are many. So are the bills found,
    which are read twice. The bills are read twice, too: pass a stored table.
    """
    known = bills.dropna(subset=[*PERIOD_KEYS, "bill_id"])
    # Numbers stand for the IDs, so that groups are kept in a hash table while they are counted;
    # the IDs themselves are compared among the few bills of the groups found.
    number = F.xxhash64("bill_id")
    groups = (
        known.groupBy(*PERIOD_KEYS)
        .agg(
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.count(F.lit(1)).alias("bills_in_period"),
        )
        .where(F.col("low") != F.col("high"))
        .drop("low", "high")
    )
    groups = stored(groups, "duplicate_groups")
    found = stored(join_groups(known, groups, PERIOD_KEYS, spread_by), "duplicates")
    ends = found.groupBy(*PERIOD_KEYS).agg(
        F.min("bill_id").alias("first_bill_id"), F.max("bill_id").alias("last_bill_id")
    )
    return join_groups(found, ends, PERIOD_KEYS, spread_by)
