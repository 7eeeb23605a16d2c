"""Table layouts and the fixed lookup values."""

from pyspark.sql.types import ArrayType, DataType, IntegerType, StructType


def _layout(**fields: str | DataType) -> StructType:
    """Columns by name and type; a type ending in ! is not null. (Layouts as DDL text could only
    be read once a session runs.)"""
    layout = StructType()
    for name, kind in fields.items():
        required = isinstance(kind, str) and kind.endswith("!")
        layout.add(name, kind.rstrip("!") if isinstance(kind, str) else kind, not required)
    return layout


# What the binaryFile source returns, plus the two directory columns. A streaming
# read needs the schema spelled out, and refuses any other type for these columns.
LANDED_FILE = _layout(
    path="string",
    modificationTime="timestamp",
    length="long",
    content="binary",
    bill_type="string",
    vendor_id="string",
)

# One row per registered file. modification_time lets the byte fetch prune its scan.
FILE_REGISTRY = _layout(
    file_path="string",
    file_name="string",
    utility_type="string",
    vendor_id="string",
    file_size_bytes="long",
    modification_time="timestamp",
    ingestion_timestamp="timestamp",
)

# One row per (document, position); a document that failed keeps one row.
ELEMENTS = _layout(
    file_path="string",
    utility_type="string",
    vendor_id="string",
    element_index="integer",
    element_type="string",
    content="string",
    confidence="double",
    bbox_coord=ArrayType(IntegerType()),
    page_id="integer",
    description="string",
    parse_status="string",
    parse_error="string",
)

# One row per parsed bill, the same layout for every commodity.
EXTRACTED_BILL = _layout(
    bill_id="string",
    building_id="string",
    commodity="string!",
    vendor="string!",
    vendor_id="string!",
    bill_start_date="date",
    bill_end_date="date",
    consumption="double",
    unit="string",
    cost_usd="double",
    source_file="string!",
    bill_type_partition="string!",
    ingestion_ts="timestamp!",
    parser_version="string!",
    parse_status="string!",
    parse_error="string",
)

# The cleansed bill: typed, without exact copies, flagged.
CLEAN_BILL = _layout(
    bill_id="string",
    building_id="string",
    commodity="string!",
    vendor="string!",
    vendor_id="string!",
    bill_start_date="date",
    bill_end_date="date",
    consumption="double",
    unit="string",
    cost_usd="double",
    source_file="string!",
    is_negative_consumption="string!",
    is_zero_consumption="string!",
    has_missing_required_field="string!",
    missing_fields="string",
    silver_ingestion_ts="timestamp!",
)

METER_FEED = _layout(
    timestamp="timestamp",
    building_id="string",
    meter_id="string",
    kwh="double",
    source_file="string",
)

METER_INTERVAL = _layout(
    timestamp="timestamp!",
    building_id="string!",
    meter_id="string!",
    kwh="double",
    source_file="string!",
    is_missing_kwh="string!",
    silver_ingestion_ts="timestamp!",
)

BUILDINGS = _layout(store_id="string", building_id="string")

# The unit each commodity is billed in.
EXPECTED_UNIT = {
    "electricity": "kWh",
    "gas": "therms",
    "water": "gallons",
}

# The extractor that reads each vendor's layout.
VENDOR_PARSER = {
    "CPC001": "parse_citypower",
    "REC002": "parse_regional_electric",
    "MGU001": "parse_metrogas",
    "NGS002": "parse_national_gas",
    "AMW001": "parse_aqua_municipal",
}

# A bill without any of these is FAILED, without some of them PARTIAL.
AMOUNTS = ("consumption", "subtotal", "tax", "cost_usd")
REQUIRED_FIELDS = ("bill_id", "bill_start_date", "bill_end_date", "consumption", "cost_usd")
