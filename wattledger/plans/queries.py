"""Every capability as a query over the test tables: name -> f(spark, sf_dir)."""

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.functions import quality
from wattledger.functions.values import to_number
from wattledger.operators import bills as B
from wattledger.operators import elements as E
from wattledger.operators import extract as X
from wattledger.operators import linkage as L
from wattledger.operators import layout as PL
from wattledger.operators import meters as M
from wattledger.operators import partials as PS
from wattledger.operators import periods as P
from wattledger.operators import reports as R
from wattledger.operators.allocation import allocate_months
from wattledger.operators.joins import gathered
from wattledger.operators.meters import dedup_intervals
from wattledger.plans import inputs as I
from wattledger.session import free_shuffles, new_folder
from wattledger.sources.landing import (
    fetch_content,
    file_metadata,
    unregistered_files,
)
from wattledger.sources.reference import (
    building_rows,
    meter_feed_stream,
    read_buildings,
    read_meter_feed,
)
from wattledger.sources import versions as V
from wattledger.streaming import figures as G
from wattledger.streaming import jobs as J
from wattledger.streaming import sinks as S
from wattledger.streaming.meters import first_arrivals, merge_readings, merge_stream, read_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Columns in types every engine prints alike: dates as text, exact sums as doubles,
    instants as microseconds, arrays as lists in text."""
    shown = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        elif isinstance(field.dataType, T.ArrayType):
            column = F.when(column.isNotNull(), F.concat_ws(",", column.cast("array<string>")))
        shown.append(column.alias(field.name))
    return rows.select(*shown)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The tables hold local times; read as UTC they are the same instants everywhere.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


# --- documents and elements


@query
def variant_elements(spark, sf_dir):
    return E.parse_document_json(I.json_files(spark, sf_dir))


@query
def variant_casts(spark, sf_dir):
    props = (
        F.when(F.col("event_id") % 41 == 0, F.lit('{"k": "x"}'))
        .when(F.col("event_id") % 43 == 0, F.lit("not json"))
        .otherwise(F.col("props"))
    )
    parsed = I.table(spark, sf_dir, "events").select("event_id", F.try_parse_json(props).alias("v"))
    return parsed.select(
        "event_id",
        F.try_variant_get("v", "$.k", "int").alias("k_number"),
        F.try_variant_get("v", "$.k", "string").alias("k_text"),
        F.try_variant_get("v", "$.k[0].x", "string").alias("k_inside"),
    )


@query
def text_elements(spark, sf_dir):
    rows = E.parse_lines(I.text_files(spark, sf_dir))
    return rows.select("file_path", "element_index", "element_type", "content", "parse_status")


@query
def html_elements(spark, sf_dir):
    rows = E.parse_html(I.html_files(spark, sf_dir))
    return rows.select("file_path", "element_index", "element_type", "content", "parse_status")


@query
def html_text_kept(spark, sf_dir):
    """The text of a page's elements, put together again without white space."""
    rows = E.parse_html(I.html_files(spark, sf_dir))
    pages = rows.groupBy("file_path").agg(
        F.array_sort(F.collect_list(F.struct("element_index", "content"))).alias("elements")
    )
    return pages.select(
        "file_path",
        F.regexp_replace(F.array_join("elements.content", ""), r"\s+", "").alias("visible"),
    )


# --- landing


@query
def landing_projection(spark, sf_dir):
    files = I.table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"),
        I.utility_of("page_id").alias("bill_type"),
        I.vendor_of("page_id").alias("vendor_id"),
        F.octet_length("html").cast("bigint").alias("length"),
        F.current_timestamp().alias("modificationTime"),
    )
    return file_metadata(files).drop("modification_time", "ingestion_timestamp")


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select(
        F.col("html").alias("text"),
        I.utility_of("page_id").alias("bill_type"),
        I.vendor_of("page_id").alias("vendor_id"),
        F.col("page_id"),
    )


def _landed(
    spark: SparkSession, sf_dir: str, label: str, goes: int = 1
) -> tuple[str, str, str]:
    """Pages landed and registered in one or several goes: (work folder, files, registry)."""
    work = new_folder(spark, label)
    root = f"{work}/files"
    registry = f"registry_{uuid.uuid4().hex}"
    pages = _page_files(spark, sf_dir)
    for go in range(goes):
        I.land(spark, pages.where(F.col("page_id") % goes == go).drop("page_id"), root)
        J.register_files(
            spark, root, registry, f"{work}/landing", "*.txt", path=f"{work}/registry"
        )
    return work, root, registry


@query
def landing_stream(spark, sf_dir):
    _, _, registry = _landed(spark, sf_dir, "landing_stream", goes=2)
    return spark.table(registry).select("utility_type", "vendor_id", "file_size_bytes")


@query
def landing_audit(spark, sf_dir):
    """Files that arrived after the registry was last brought up to date, per folder."""
    work, root, registry = _landed(spark, sf_dir, "landing_audit")
    later = _page_files(spark, sf_dir).where(F.col("page_id") % 10 == 7)
    I.land(spark, later.drop("page_id"), root)
    found = unregistered_files(spark, root, spark.table(registry), "*.txt")
    return found.select(
        F.regexp_extract("file_path", "bill_type=([^/]*)/", 1).alias("utility_type"),
        F.regexp_extract("file_path", "vendor_id=([^/]*)/", 1).alias("vendor_id"),
    ).groupBy("utility_type", "vendor_id").agg(F.count(F.lit(1)).alias("files"))


@query
def partition_discovery(spark, sf_dir):
    """Columns read from directory names, on a pruned read of written folders."""
    folder = new_folder(spark, "partition_discovery")
    events = I.table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    events.write.partitionBy("event_type").parquet(folder)
    read = spark.read.schema("event_id bigint, value double, event_type string").parquet(folder)
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,4)")).alias("value"),
    )


@query
def content_fetch(spark, sf_dir):
    """Bytes of registered files, one registry row in the tables' order having gone stale:
    for every file there is a second row whose file does not exist, and a repeated row."""
    _, root, registry = _landed(spark, sf_dir, "content_fetch")
    known = spark.table(registry)
    gone = known.withColumn("file_path", F.concat("file_path", F.lit(".gone")))
    fetched = fetch_content(spark, root, known.union(known).union(gone), "*.txt")
    return fetched.select(
        "utility_type", "vendor_id", F.md5("content").alias("digest"), "fetch_error"
    )


@query
def file_versions(spark, sf_dir):
    """Pages as files over three snapshots, the second taken twice: changed, gone, new, back."""
    log = f"{new_folder(spark, 'file_versions')}/log"
    for number in (1, 2, 2, 3):
        V.record_snapshot(I.page_snapshot(spark, sf_dir, number), number, log)
    return V.file_versions(V.read_log(spark, log))


def _element_columns(rows: DataFrame) -> DataFrame:
    return rows.select("utility_type", "vendor_id", "element_index", "element_type", "content")


@query
def element_stream(spark, sf_dir):
    """Both jobs in a row: files to registry, registry to elements."""
    work, root, registry = _landed(spark, sf_dir, "element_stream")
    J.parse_registered(
        spark, registry, root, f"{work}/elements", f"{work}/parsing", E.parse_html, "*.txt"
    )
    return _element_columns(spark.read.parquet(f"{work}/elements"))


@query
def element_stream_json(spark, sf_dir):
    """Both jobs on parsed documents: files to registry, VARIANT elements, failures kept."""
    work = new_folder(spark, "element_stream_json")
    root, registry = f"{work}/files", f"registry_{uuid.uuid4().hex}"
    I.land(spark, I.conversation_files(spark, sf_dir), root)
    J.register_files(spark, root, registry, f"{work}/landing", "*.txt", path=f"{work}/registry")
    elements = f"{work}/elements"
    J.parse_registered(
        spark, registry, root, elements, f"{work}/parsing", E.parse_document_json, "*.txt"
    )
    return spark.read.parquet(elements).select(
        "utility_type", "vendor_id", "element_index", "element_type", "content", "parse_status",
        "parse_error",
    )


@query
def reprocess_equals_stream(spark, sf_dir):
    """The same, but with an unfit parser first; its batches are parsed again."""
    work, root, registry = _landed(spark, sf_dir, "reprocess")
    elements = f"{work}/elements"
    written = J.parse_registered(
        spark, registry, root, elements, f"{work}/parsing", E.parse_lines, "*.txt"
    )
    J.reparse(spark, registry, root, elements, E.parse_html, list(written), "*.txt")
    return _element_columns(spark.read.parquet(elements))


# --- sinks


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = I.table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


@query
def registry_stream(spark, sf_dir):
    """A stream into a table, and a second stream off that table."""
    work = new_folder(spark, "registry_stream")
    name = f"events_{uuid.uuid4().hex}"
    S.run_to_table(_event_stream(spark, sf_dir), name, f"{work}/first", path=f"{work}/table")
    S.write_each_batch(spark.readStream.table(name), f"{work}/copy", f"{work}/second")
    return spark.read.parquet(f"{work}/copy").drop("batch_id")


@query
def idempotent_sink(spark, sf_dir):
    """A stream that stops once between writing a batch and committing it."""
    work = new_folder(spark, "idempotent_sink")
    stopped = []

    def write(batch: DataFrame, batch_id: int) -> None:
        S.write_batch(batch, batch_id, f"{work}/events")
        if not stopped:
            stopped.append(batch_id)
            raise RuntimeError("stopped after the write")

    events = _event_stream(spark, sf_dir)
    try:
        S.run_to_end(events.writeStream.foreachBatch(write), f"{work}/progress")
    except StreamingQueryException:
        S.run_to_end(events.writeStream.foreachBatch(write), f"{work}/progress")
    return spark.read.parquet(f"{work}/events").drop("batch_id")


@query
def batch_metrics(spark, sf_dir):
    """Rows per batch as reported by the write itself, beside what is stored."""
    work = new_folder(spark, "batch_metrics")
    written = S.write_each_batch(_event_stream(spark, sf_dir), f"{work}/events", f"{work}/progress")
    reported = spark.createDataFrame(list(written.items()), "batch_id bigint, reported bigint")
    stored = S.read_batches(spark, f"{work}/events").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("stored")
    )
    both = stored.join(reported, "batch_id", "full")
    return both.agg(F.sum("reported").alias("reported"), F.sum("stored").alias("stored"))


@query
def quarantine_sink(spark, sf_dir):
    """Judged bills written once, read back by destination."""
    folder = new_folder(spark, "quarantine_sink")
    J.write_judged(I.enriched_bills(spark, sf_dir), 0, folder)
    return spark.read.parquet(folder).select("destination", "source_file", "bill_id", "reasons")


@query
def quarantine_replay(spark, sf_dir):
    """The same batch written again after the vendors' table was mended: some bills change
    sides, each is there once."""
    folder = new_folder(spark, "quarantine_replay")
    mapped = B.add_buildings(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))
    mapped = I.stored(spark, mapped, "mapped_bills")
    vendors = I.vendors(spark, sf_dir)
    known = vendors.where(F.substring("vendor_id", -1, 1) != "1")
    J.write_judged(B.add_vendors(mapped, known), 0, folder)
    J.write_judged(B.add_vendors(mapped, vendors), 0, folder)
    return spark.read.parquet(folder).select("destination", "source_file", "bill_id", "reasons")


@query
def dotted_table(spark, sf_dir):
    """A stream into a table of a schema that isn't there yet."""
    work = new_folder(spark, "dotted_table")
    schema = f"layer_{uuid.uuid4().hex}"
    S.ensure_schema(spark, f"{schema}.events")
    S.run_to_table(_event_stream(spark, sf_dir), f"{schema}.events", f"{work}/progress", path=f"{work}/table")
    return spark.table(f"{schema}.events")


@query
def empty_batch(spark, sf_dir):
    """A batch without rows writes nothing and counts none; the one before it stays."""
    folder = new_folder(spark, "empty_batch")
    events = I.table(spark, sf_dir, "events")
    full = S.write_batch(events, 0, folder)
    empty = S.write_batch(events.where("false"), 1, folder)
    stored = S.read_batches(spark, folder)
    return stored.agg(
        F.count(F.lit(1)).alias("stored"), F.count_distinct("batch_id").alias("batches")
    ).withColumns({"full": F.lit(full).cast("long"), "empty": F.lit(empty).cast("long")})


@query
def replay_emptied(spark, sf_dir):
    """Two batches, of which the first runs again and has no rows any more."""
    folder = new_folder(spark, "replay_emptied")
    events = I.table(spark, sf_dir, "events")
    for batch in (0, 1):
        S.write_batch(events.where(F.col("event_id") % 2 == batch), batch, folder)
    S.write_batch(events.where("false"), 0, folder)
    return S.read_batches(spark, folder)


# --- extraction


URL_RULES = (
    X.Rule("host", r"^https?://([^/:?#]+)"),
    X.Rule("host", r"^https?://(?:www\.|m\.|blog\.)?([^/:?#]+)", "CPC001"),
    X.Rule("language", r"^https?://[^/]+/([a-z]{2})/"),
    X.Rule("number", r"/([0-9]+)(?:[/?#.].*)?$"),
    X.Rule("query", r"\?(.*)$", "AMW001"),
)


@query
def rule_extract(spark, sf_dir):
    urls = I.table(spark, sf_dir, "pages").select(
        "page_id", I.vendor_of("page_id").alias("vendor_id"), F.col("url").alias("content")
    )
    return X.match_rules(urls, URL_RULES).drop("content")


@query
def gold_pivot(spark, sf_dir):
    turns = I.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("role").alias("field"), F.col("text").alias("value")
    )
    return X.pivot_fields(turns, ["conv_id"], ["system", "user", "assistant"], "turn")


@query
def bill_extract(spark, sf_dir):
    """Printed bills of five vendor layouts to one typed row each."""
    return X.bills_of_files(I.bill_texts(spark, sf_dir)).drop(
        "consumption_raw", "cost_raw", "ingestion_ts", "bill_type_partition"
    )


@query
def bill_extract_elements(spark, sf_dir):
    """The same from the bills' lines as elements."""
    elements = E.parse_lines(I.bill_texts(spark, sf_dir))
    return X.extracted_bills(elements, by_runs=True).drop(
        "consumption_raw", "cost_raw", "ingestion_ts", "bill_type_partition"
    )


@query
def bill_extract_placed(spark, sf_dir):
    """The same from pages on which labels and values are elements beside each other."""
    # Pages are lists of whole elements: what bills are not read from is left out before.
    elements = I.placed_elements(spark, sf_dir).select(*X.READ_COLUMNS, *PL.PLACE_COLUMNS)
    return X.extracted_bills(PL.join_labels(elements)).drop(
        "consumption_raw", "cost_raw", "ingestion_ts", "bill_type_partition"
    )


@query
def extracted_layout(spark, sf_dir):
    """Extracted bills with their building and vendor, in the contract's layout."""
    bills = X.bills_of_files(I.bill_texts(spark, sf_dir))
    enriched = B.add_vendors(
        B.add_buildings(bills, I.buildings(spark, sf_dir)),
        spark.createDataFrame([(v, v.lower()) for v in I.VENDOR_CODES], "vendor_id string, vendor string"),
    )
    return B.extracted_layout(enriched).drop("ingestion_ts")


# --- reference data


@query
def buildings_csv(spark, sf_dir):
    """The building CSV, with a second building for some stores and rows without a store."""
    folder = new_folder(spark, "buildings_csv")
    rows = I.buildings(spark, sf_dir)
    double = rows.where(F.col("store_id").endswith("7")).withColumn("building_id", F.lit("Z"))
    nameless = rows.limit(1).withColumn("store_id", F.lit(None).cast("string"))
    rows.unionAll(double).unionAll(nameless).write.option("header", True).csv(folder)
    return read_buildings(spark, folder)


def _doubled_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.buildings(spark, sf_dir)
    return rows.unionAll(
        rows.where(F.col("store_id").endswith("7")).withColumn("building_id", F.lit("Z"))
    )


@query
def building_ambiguous(spark, sf_dir):
    """Stores that the building CSV lists with several buildings."""
    folder = new_folder(spark, "building_ambiguous")
    _doubled_buildings(spark, sf_dir).write.option("header", True).csv(folder)
    return B.ambiguous_buildings(building_rows(spark, folder))


@query
def lookup_guarded(spark, sf_dir):
    """Bills with their building and vendor, from lookups that list some keys twice: every bill
    is there once."""
    vendors = I.vendors(spark, sf_dir)
    twice = vendors.unionAll(vendors.withColumn("vendor", F.concat("vendor", F.lit(" Inc"))))
    mapped = B.add_buildings(I.bills(spark, sf_dir), _doubled_buildings(spark, sf_dir))
    return B.add_vendors(mapped, twice).select("source_file", "building_id", "vendor")


def _named_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = I.party_files(spark, sf_dir)
    return I.stored(spark, X.extract_texts(E.decode_text(files), X.PARTY_RULES), "named_bills")


@query
def building_link(spark, sf_dir):
    """Buildings by the customer and address that bills print, faults included."""
    return L.link_buildings(_named_bills(spark, sf_dir), I.parties(spark, sf_dir))


@query
def building_link_bills(spark, sf_dir):
    """Every bill with the building it was linked to."""
    linked = L.add_linked_buildings(_named_bills(spark, sf_dir), I.parties(spark, sf_dir))
    return linked.select("file_path", "building_id", "similarity", "candidates", "link")


# --- bills


@query
def credit_amounts(spark, sf_dir):
    """Prices as charges and in the notations of credits, some too large for money."""
    price = F.format_number("l_extendedprice", 2)
    notations = [
        F.concat(F.lit(before), price, F.lit(after))
        for before, after in (("(", ")"), ("", "-"), ("", " CR"), ("-$", ""), ("$", ""), ("($", ")"), ("", "e24"))
    ]
    case = (F.col("l_linenumber") % 7).cast("int")
    printed = F.get(F.array(*notations), case)
    return I.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", to_number(printed).alias("amount")
    )


@query
def bill_typed(spark, sf_dir):
    return I.typed_bills(spark, sf_dir).drop("ingestion_ts")


@query
def bill_exact_dedup(spark, sf_dir):
    return I.bills(spark, sf_dir)


@query
def quality_flags(spark, sf_dir):
    return B.flag_bills(I.bills(spark, sf_dir)).select(
        "source_file",
        "bill_id",
        "is_negative_consumption",
        "is_zero_consumption",
        "has_missing_required_field",
        "missing_fields",
    )


@query
def parse_status(spark, sf_dir):
    judged = I.bills(spark, sf_dir).select(
        quality.parse_status().alias("parse_status"),
        quality.missing_fields().alias("missing_fields"),
    )
    return judged.groupBy("parse_status").agg(
        F.count(F.lit(1)).alias("bills"),
        F.count_distinct("missing_fields").alias("kinds"),
    )


@query
def partition_crosscheck(spark, sf_dir):
    return B.partition_mismatches(I.bills(spark, sf_dir)).select(
        "source_file", "commodity", "bill_type_partition"
    )


@query
def unknown_utility_type(spark, sf_dir):
    return B.unknown_types(I.bills(spark, sf_dir)).select("source_file", "bill_type_partition")


@query
def unit_check(spark, sf_dir):
    return B.unit_mismatches(I.bills(spark, sf_dir)).select(
        "source_file", "commodity", "unit", "expected_unit"
    )


@query
def period_check(spark, sf_dir):
    return B.check_period(I.bills(spark, sf_dir)).select(
        "source_file", "bill_start_date", "bill_end_date", "is_valid_period"
    )


@query
def total_check(spark, sf_dir):
    return B.total_mismatches(I.bills(spark, sf_dir)).select(
        "source_file", "subtotal", "tax", "cost_usd"
    )


@query
def filename_tokens(spark, sf_dir):
    name = F.concat(
        F.lit("raw/"),
        F.concat_ws(
            "_",
            "vendor_id",
            "store_id",
            "commodity",
            F.date_format("bill_start_date", "yyyy-MM"),
            "bill_id",
        ),
        F.lit(".pdf"),
    )
    named = I.bills(spark, sf_dir).withColumn("path", name)
    return B.file_name_tokens(named, "path").select(
        "path",
        "name_vendor_id",
        "name_store_id",
        "name_commodity",
        "name_bill_month",
        "name_bill_id",
    )


@query
def building_enrich(spark, sf_dir):
    mapped = B.add_buildings(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))
    return mapped.select("source_file", "store_id", "building_id")


@query
def building_unmapped(spark, sf_dir):
    return B.unmapped_stores(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))


@query
def vendor_enrich(spark, sf_dir):
    named = B.add_vendors(I.bills(spark, sf_dir), I.vendors(spark, sf_dir))
    return named.select("source_file", "vendor_id", "vendor")


@query
def clean_bills(spark, sf_dir):
    return B.clean_bills(I.enriched_bills(spark, sf_dir)).drop("silver_ingestion_ts")


@query
def quarantine_split(spark, sf_dir):
    judged = B.add_reasons(I.enriched_bills(spark, sf_dir))
    return judged.select(
        "source_file",
        "bill_id",
        F.when(B.is_quarantined(), "quarantine").otherwise("valid").alias("destination"),
        "reasons",
    )


@query
def dq_summary(spark, sf_dir):
    return B.quality_summary(I.enriched_bills(spark, sf_dir))


@query
def batch_figures(spark, sf_dir):
    """Bills per broken rule, from the figures that a stream's batches left; the last batch
    runs twice."""
    work = new_folder(spark, "batch_figures")
    # A batch is a third of the bills, in files that grow in number with the line items.
    lines = I.table(spark, sf_dir, "lineitem")
    rows = -(-lines.count() // (3 * lines.rdd.getNumPartitions()))
    enriched = I.enriched_bills(spark, sf_dir)
    # Files are cut while they are written: bills are not shuffled once more for it.
    enriched.write.option("maxRecordsPerFile", max(rows, 1)).parquet(f"{work}/feed")
    free_shuffles(spark)
    written = spark.read.schema(enriched.schema).parquet(f"{work}/feed")
    files = -(-len(written.inputFiles()) // 3)
    feed = spark.readStream.schema(written.schema).option("maxFilesPerTrigger", max(files, 1))
    feed = feed.parquet(f"{work}/feed")
    kept, figures = f"{work}/figures", G.bill_figures()
    G.measure_each_batch(feed, f"{work}/bills", f"{work}/progress", kept, "bills", figures)
    last = S.read_batches(spark, f"{work}/bills")
    number = last.agg(F.max("batch_id")).first()[0]
    again = I.stored(spark, last.where(F.col("batch_id") == number).drop("batch_id"), "again")
    G.write_measured(again, number, f"{work}/bills", figures, kept, "bills")
    broken = G.read_figures(spark, kept).where(F.col("figure").startswith("broken: "))
    return broken.groupBy(F.substring("figure", 9, 100).alias("reason")).agg(F.sum("value").alias("bills"))


@query
def duplicate_bills(spark, sf_dir):
    mapped = B.add_buildings(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))
    needed = mapped.select(*B.PERIOD_KEYS, "bill_id", "source_file")
    return B.duplicate_bills(I.stored(spark, needed, "duplicate_bills")).select(
        *B.PERIOD_KEYS, "bill_id", "first_bill_id", "last_bill_id", "bills_in_period", "source_file"
    )


def _mapped_bills(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    mapped = B.add_buildings(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))
    return mapped.select("building_id", "commodity", "bill_start_date", "bill_end_date", "bill_id", *columns)


@query
def period_overlaps(spark, sf_dir):
    return P.period_overlaps(_mapped_bills(spark, sf_dir))


@query
def period_gaps(spark, sf_dir):
    return P.period_gaps(_mapped_bills(spark, sf_dir))


@query
def bill_months(spark, sf_dir):
    """Bills split over the calendar months of their periods."""
    return allocate_months(I.bills(spark, sf_dir)).select(
        "source_file", "bill_id", "bill_start_date", "bill_end_date", "days", "consumption", "cost_usd"
    )


# --- meters


@query
def metered_vs_billed(spark, sf_dir):
    needed = _mapped_bills(spark, sf_dir, "source_file", "consumption")
    reads = dedup_intervals(I.meter_history(spark, sf_dir))
    return M.metered_vs_billed(needed, reads).drop("commodity")


@query
def meter_dedup(spark, sf_dir):
    return dedup_intervals(I.meter_reads(spark, sf_dir)).drop("silver_ingestion_ts")


@query
def meter_feed(spark, sf_dir):
    """The readings as a feed of files, read by its layout."""
    folder = new_folder(spark, "meter_feed")
    I.meter_reads(spark, sf_dir).write.parquet(folder)
    return dedup_intervals(read_meter_feed(spark, folder)).drop("silver_ingestion_ts")


@query
def late_readings(spark, sf_dir):
    """Half the meters report again about readings of years ago, after the newer ones: far later
    than any watermark. They are merged into the stored days they belong to."""
    work = new_folder(spark, "late_readings")
    reads = I.meter_reads(spark, sf_dir)
    odd = F.col("meter_id").cast("long") % 2 == 1
    older = reads.where(odd).withColumn("timestamp", F.expr("timestamp - interval 4000 days"))
    days = []
    for go in (reads.where(~odd), older):
        go.write.mode("append").parquet(f"{work}/feed")
        feed = meter_feed_stream(spark, f"{work}/feed")
        merged = merge_stream(feed, f"{work}/kept", f"{work}/merged", f"{work}/progress")
        days.append(max(day for touched in merged.values() for day in touched))
    late = read_readings(spark, f"{work}/kept").where(F.to_date("timestamp") <= F.lit(days[-1]))
    return late.select("timestamp", "meter_id")


@query
def readings_merged(spark, sf_dir):
    """Readings of a feed in several batches, each of which touches most days: what is stored in
    the end is what a batch over all of them keeps."""
    work = new_folder(spark, "readings_merged")
    I.meter_reads(spark, sf_dir).repartition(3).write.parquet(f"{work}/feed")
    stream = meter_feed_stream(spark, f"{work}/feed", max_files=1)
    merge_stream(stream, f"{work}/kept", f"{work}/merged", f"{work}/progress")
    return read_readings(spark, f"{work}/kept").drop("silver_ingestion_ts")


@query
def meter_dedup_stream(spark, sf_dir):
    """Readings of a feed of files in several batches, first arrival kept for an hour; the feed
    is then merged over them, so those that came later than that are there, too."""
    work = new_folder(spark, "meter_dedup_stream")
    I.meter_reads(spark, sf_dir).repartition(4).write.parquet(f"{work}/feed")
    stream = meter_feed_stream(spark, f"{work}/feed", max_files=1)
    S.write_each_batch(first_arrivals(stream, "1 hour"), f"{work}/early", f"{work}/progress")
    merge_readings(spark.read.parquet(f"{work}/early"), 0, f"{work}/kept", f"{work}/seed")
    merge_stream(stream, f"{work}/kept", f"{work}/merged", f"{work}/merging")
    return read_readings(spark, f"{work}/kept").select("timestamp", "meter_id")


# --- reports


@query
def totals_by_store(spark, sf_dir):
    return R.totals_by_store(I.bills(spark, sf_dir))


@query
def cost_by_commodity_month(spark, sf_dir):
    return R.cost_by_month(I.bills(spark, sf_dir))


@query
def consumption_by_building_month(spark, sf_dir):
    return R.consumption_by_building(I.bills(spark, sf_dir), I.buildings(spark, sf_dir))


@query
def vendor_comparison(spark, sf_dir):
    return R.compare_vendors(I.bills(spark, sf_dir), I.vendors(spark, sf_dir))


@query
def usage_trend(spark, sf_dir):
    return R.usage_trend(I.bills(spark, sf_dir))


@query
def consumption_anomaly(spark, sf_dir):
    needed = I.bills(spark, sf_dir).select(
        "vendor_id", "commodity", "source_file", "bill_id", "consumption"
    )
    return R.unusual_consumption(I.stored(spark, needed, "consumption_anomaly"))


@query
def gold_bills(spark, sf_dir):
    return R.gold_bills(I.enriched_bills(spark, sf_dir))


@query
def cost_by_calendar_month(spark, sf_dir):
    return R.cost_by_month(allocate_months(I.bills(spark, sf_dir)))


def _gathered_bills(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """What reports on months of stores read of the bills."""
    keys = ("store_id", "commodity")
    needed = I.bills(spark, sf_dir).select(*keys, "bill_start_date", "bill_end_date", "consumption", *columns)
    return gathered(needed, *keys)


@query
def consumption_by_building_calendar_month(spark, sf_dir):
    parts = allocate_months(_gathered_bills(spark, sf_dir, "cost_usd"))
    return R.consumption_by_building(parts, I.buildings(spark, sf_dir))


@query
def usage_trend_calendar(spark, sf_dir):
    return R.usage_trend(allocate_months(_gathered_bills(spark, sf_dir)))


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial sums of bills in four batches, one of which came with wrong amounts at first and
    is replaced; only that one is read again."""
    work = new_folder(spark, "refreshed")
    batch = F.pmod(F.xxhash64("source_file"), F.lit(4))
    bills = I.stored(spark, I.bills(spark, sf_dir).withColumn("batch_id", batch), "refreshed_bills")
    wrong = F.when(F.col("batch_id") == 2, F.col("cost_usd") * 2).otherwise(F.col("cost_usd"))
    S.rewrite_batches(bills.withColumn("cost_usd", wrong), f"{work}/bills")
    PS.refresh(spark, f"{work}/bills", range(4), f"{work}/partials")
    S.rewrite_batches(bills.where("batch_id = 2"), f"{work}/bills")
    PS.refresh(spark, f"{work}/bills", [2], f"{work}/partials")
    return S.read_batches(spark, f"{work}/partials")


@query
def cost_by_month_refreshed(spark, sf_dir):
    return PS.merged_cost_by_month(_refreshed(spark, sf_dir))


@query
def consumption_by_building_refreshed(spark, sf_dir):
    partials = _refreshed(spark, sf_dir)
    return PS.merged_consumption_by_building(partials, I.buildings(spark, sf_dir))


@query
def vendor_comparison_refreshed(spark, sf_dir):
    return PS.merged_vendors(_refreshed(spark, sf_dir), I.vendors(spark, sf_dir))


@query
def consumption_outliers(spark, sf_dir):
    needed = I.bills(spark, sf_dir).select(
        "vendor_id", "commodity", "source_file", "bill_id", "consumption"
    )
    return R.robust_outliers(I.stored(spark, needed, "consumption_outliers"), 1.0)
