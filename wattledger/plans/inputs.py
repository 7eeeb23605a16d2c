"""Bills, reference tables, meter readings and documents derived from the test tables.

The tables are clean, so faults are put in by fixed rules on their keys (FIXTURES.md, part
B). Everything is a projection of the rows as they are: no rows are gathered to build a
document, and a copied row is made beside its original in the same scan.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import session
from wattledger.operators.bills import add_buildings, add_vendors, drop_exact_copies, type_bills
from wattledger.operators.elements import parse_lines

VENDOR_CODES = ("CPC001", "REC002", "MGU001", "NGS002", "AMW001")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_copies(rows: DataFrame, copied: Column, number: str) -> DataFrame:
    """Rows, and a second copy (number 1) of those that meet the condition."""
    copies = F.sequence(F.lit(0), F.when(copied, F.lit(1)).otherwise(F.lit(0)))
    return rows.withColumn(number, F.explode(copies))


def _vendor_id(key: str) -> Column:
    return F.format_string("V%03d", F.col(key))


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def _with_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Line items with their order. Orders grow with the line items, so they are never the
    broadcast side: both are shuffled under the join, where a hot order can be split."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))


def raw_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    joined = _with_orders(spark, sf_dir, lines)

    all_missing = _every("l_orderkey", 211)
    text_of = F.array(*[F.lit(name) for name in ("electricity", "gas", "water")])
    raw_text_of = F.array(*[F.lit(name) for name in (" Electricity", "GAS", "water")])
    unit_of = F.array(*[F.lit(name) for name in ("KWH", "Therms", "GALLONS")])
    kind = (F.col("l_partkey") % 3).cast("int")

    quantity = F.col("l_quantity").cast("int").cast("string")
    consumption = (
        F.when(F.col("l_quantity") == 13, F.lit("0"))
        .when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45), F.lit("N/A"))
        .when(
            (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 5),
            F.concat(F.lit("-"), quantity),
        )
        .otherwise(quantity)
    )
    subtotal = F.col("l_extendedprice").cast("decimal(18,2)")
    rate = F.col("l_tax").cast("decimal(4,2)")
    surplus = F.when(_every("l_orderkey", 59), F.lit(1)).otherwise(F.lit(0))
    cost = (subtotal * (F.lit(1) + rate) + surplus).cast("decimal(18,4)")
    start = F.col("o_orderdate").cast("date").cast("string")
    number = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")

    bills = joined.select(
        F.when(~(all_missing | _every("l_orderkey", 97)), F.concat(F.lit("BILL-"), number)).alias(
            "bill_id"
        ),
        F.concat(F.lit("STR-"), F.col("o_custkey")).alias("store_id"),
        F.get(raw_text_of, kind).alias("commodity_raw"),
        F.when(_every("l_partkey", 101), F.lit("steam"))
        .otherwise(F.get(text_of, kind))
        .alias("bill_type_partition"),
        _vendor_id("l_suppkey").alias("vendor_id"),
        F.when(~all_missing, F.when(_every("l_orderkey", 83), "not-a-date").otherwise(start)).alias(
            "bill_start_raw"
        ),
        F.when(~all_missing, F.col("l_shipdate").cast("date").cast("string")).alias("bill_end_raw"),
        F.when(~all_missing, consumption).alias("consumption_raw"),
        F.when(_every("l_partkey", 89), F.lit("MWh"))
        .otherwise(F.get(unit_of, kind))
        .alias("unit_raw"),
        subtotal.cast("string").alias("subtotal_raw"),
        (subtotal * rate).cast("decimal(18,4)").cast("string").alias("tax_raw"),
        F.when(~(all_missing | _every("l_orderkey", 61)), cost.cast("string")).alias("cost_raw"),
        F.concat(
            F.lit("bill_type=x/vendor_id="),
            F.col("l_suppkey"),
            F.lit("/"),
            F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey"),
            F.lit(".pdf"),
        ).alias("source_file"),
    )
    parsed_twice = F.coalesce(F.substring("bill_start_raw", 9, 2) == "15", F.lit(False))
    # The second copy was ingested later; it is the same row otherwise.
    return _with_copies(bills, parsed_twice, "_copy").select(
        *bills.columns,
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("_copy")).alias("ingestion_ts"),
    )


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store in ten has no building."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_custkey") % 10 != 9)
        .select(
            F.concat(F.lit("STR-"), F.col("c_custkey")).alias("store_id"),
            F.concat(F.lit("BLD-"), F.col("c_custkey")).alias("building_id"),
        )
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vendor in twenty is unknown."""
    return (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_suppkey") % 20 != 19)
        .select(_vendor_id("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor"))
    )


def typed_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_bills(raw_bills(spark, sf_dir))


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bills without exact copies."""
    return drop_exact_copies(typed_bills(spark, sf_dir))


def enriched_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = add_buildings(bills(spark, sf_dir), buildings(spark, sf_dir))
    return add_vendors(mapped, vendors(spark, sf_dir))


def stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read from there, for a report that reads its
    bills twice: what made them then runs once."""
    return session.stored(rows, label)


def meter_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a reading; one in 20 comes again, late and with another value."""
    return _readings(table(spark, sf_dir, "events"))


def _readings(events: DataFrame) -> DataFrame:
    late = F.col("_copy") == 1
    value = F.when(~_every("event_id", 37), F.col("value"))
    return _with_copies(events, _every("event_id", 20), "_copy").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("user_id") % 50).cast("string").alias("building_id"),
        F.col("user_id").cast("string").alias("meter_id"),
        F.when(late, F.col("value") + 1).otherwise(value).alias("kwh"),
        F.when(late, F.lit("late")).otherwise(F.col("event_type")).alias("source_file"),
    )


def vendor_of(key: str) -> Column:
    return F.get(F.array(*[F.lit(c) for c in VENDOR_CODES]), (F.col(key) % 5).cast("int"))


def utility_of(key: str) -> Column:
    kinds = F.array(*[F.lit(name) for name in ("electricity", "gas", "water")])
    return F.get(kinds, (F.col(key) % 3).cast("int"))


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents.text as the bytes of one file per document."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("file_path"),
        utility_of("doc_id").alias("utility_type"),
        vendor_of("doc_id").alias("vendor_id"),
        F.col("text").cast("binary").alias("content"),
    )


def html_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page/"), F.col("page_id")).alias("file_path"),
        utility_of("page_id").alias("utility_type"),
        vendor_of("page_id").alias("vendor_id"),
        F.col("html").cast("binary").alias("content"),
    )


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines as the parser's JSON. By line number: odd shapes in single
    elements; by document: no list, an empty one, the wrong type, broken JSON."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.to_json(
            F.struct(
                i.alias("id"),
                F.when(i % 7 == 3, F.lit("3")).otherwise(F.lit("text")).alias("type"),
                line.alias("content"),
                F.when(i % 5 == 4, F.lit("x"))
                .otherwise(F.format_string("0.%d", 1 + i % 9))
                .alias("confidence"),
                F.when(i % 6 == 5, F.array().cast("array<struct<coord:array<double>,page_id:int>>"))
                .otherwise(
                    F.array(
                        F.struct(
                            F.array(
                                i.cast("double"), F.lit(3.7), F.lit(20.0), (i + 10).cast("double")
                            ).alias("coord"),
                            F.floor(i / 10).cast("int").alias("page_id"),
                        )
                    )
                )
                .alias("bbox"),
                F.when(i % 4 == 0, F.lit("lead")).alias("description"),
            )
        ),
    )
    good = F.concat(
        F.lit('{"document":{"elements":['), F.concat_ws(",", lines), F.lit("]}}")
    )
    case = F.col("doc_id") % 50
    text = (
        F.when(case == 0, F.lit('{"document":{}}'))
        .when(case == 1, F.lit('{"document":{"elements":[]}}'))
        .when(case == 2, F.lit('{"document":{"elements":"x"}}'))
        .when(case == 3, F.concat(F.lit("{"), good))
        .otherwise(good)
    )
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("file_path"),
        utility_of("doc_id").alias("utility_type"),
        vendor_of("doc_id").alias("vendor_id"),
        text.cast("binary").alias("content"),
    )


def bill_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bill line item printed in the wording of its vendor, as a text file. One in 97
    has no number, one in 83 no period, one in 211 is an empty form, one in 71 names a second
    total."""
    lines = _with_orders(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    number = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wording = [
        F.concat(F.lit(before), number, F.lit(after))
        for before, after in (
            ("Invoice No: ", ""),
            ("Statement # ", ""),
            ("Your statement ", " is ready"),
            ("| Bill Number | ", " |"),
            ("Account bill: ", ""),
        )
    ]
    which = (F.col("l_suppkey") % 5).cast("int")
    subtotal = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = (subtotal * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)")
    unit_of = F.array(*[F.lit(name) for name in ("kWh", "THERMS", "gallons")])
    kind = (F.col("l_partkey") % 3).cast("int")
    shipped = F.col("l_shipdate").cast("date")
    printed = F.concat_ws(
        "\n",
        F.lit("Utility bill"),
        F.when(~_every("l_orderkey", 97), F.get(F.array(*wording), which)),
        F.when(
            ~_every("l_orderkey", 83),
            F.concat(
                F.lit("Service period: "),
                F.date_sub(shipped, 30).cast("string"),
                F.lit(" to "),
                shipped.cast("string"),
            ),
        ),
        F.concat(
            F.lit("Usage: "),
            F.col("l_quantity").cast("int").cast("string"),
            F.lit(" "),
            F.get(unit_of, kind),
        ),
        F.concat(F.lit("Subtotal: $"), subtotal.cast("string")),
        F.concat(F.lit("Tax: $"), tax.cast("string")),
        F.concat(F.lit("Total due: $"), (subtotal + tax).cast("string")),
        F.when(_every("l_orderkey", 71), F.lit("Total due: $1.00")),
        F.concat(F.lit("Account No: ACC-"), F.col("o_custkey").cast("string")),
        F.concat(F.lit("Customer: STR-"), F.col("o_custkey").cast("string")),
    )
    return lines.select(
        # A few numbers occur twice; quantity and price tell their files apart.
        F.concat(
            number,
            F.lit("-"),
            F.col("l_quantity").cast("int").cast("string"),
            F.lit("-"),
            (subtotal * 100).cast("bigint").cast("string"),
            F.lit(".pdf"),
        ).alias("file_path"),
        F.get(
            F.array(*[F.lit(name) for name in ("electricity", "gas", "water")]), kind
        ).alias("utility_type"),
        F.get(F.array(*[F.lit(c) for c in VENDOR_CODES]), which).alias("vendor_id"),
        F.when(_every("l_orderkey", 211), F.lit("Utility bill"))
        .otherwise(printed)
        .cast("binary")
        .alias("content"),
    )


# What bill_texts prints before a value.
_PRINTED_LABEL = (
    r"^(Invoice No:|Statement #|Account bill:|Service period:|Usage:|Subtotal:|Tax:|Total due:"
    r"|Account No:|Customer:)\s*(\S.*)$"
)


def placed_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of printed bills, four a page, with labels and values as elements of their own:
    the value right of its label in even lines, below it in odd ones. In the order of reading all
    labels come first."""
    lines = parse_lines(bill_texts(spark, sf_dir))
    line, label = F.col("element_index"), F.regexp_extract("content", _PRINTED_LABEL, 1)
    top = F.lit(100) * (line % 4)
    whole = F.array(F.lit(20), top, F.lit(400), top + 20)
    aside = F.array(F.lit(140), top + 2, F.lit(260), top + 22)
    under = F.array(F.lit(20), top + 30, F.lit(140), top + 50)

    def element(index: Column, content: Column, box: Column) -> Column:
        return F.struct(
            index.cast("int").alias("element_index"), content.alias("content"),
            box.cast("array<int>").alias("bbox_coord"),
        )

    value = F.regexp_extract("content", _PRINTED_LABEL, 2)
    parts = F.when(
        label != "",
        F.array(
            element(line, label, F.array(F.lit(20), top, F.lit(120), top + 20)),
            element(line + 1000, value, F.when(line % 2 == 0, aside).otherwise(under)),
        ),
    ).otherwise(F.array(element(line, F.col("content"), whole)))
    split = lines.withColumn("page_id", F.floor(line / 4).cast("int")).select(
        *[c for c in lines.columns if c not in ("element_index", "content", "bbox_coord", "page_id")],
        "page_id", F.inline(parts),
    )
    return split.select(*lines.columns)


def page_snapshot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Metadata of the pages as files at one of three times. In the second, one in five is
    longer and newer, one in five is gone, and one in five is new; in the third the gone ones
    are back."""
    key = F.col("page_id")
    fifth, changed = key % 5, F.lit(number >= 2)
    rows = table(spark, sf_dir, "pages")
    rows = rows.where(fifth != 4) if number == 1 else rows
    rows = rows.where(fifth != 1) if number == 2 else rows
    longer = F.when((fifth == 0) & changed, 1).otherwise(0)
    return rows.select(
        F.concat(F.lit("page/"), key).alias("file_path"),
        utility_of("page_id").alias("utility_type"),
        vendor_of("page_id").alias("vendor_id"),
        (F.octet_length("html") + longer).cast("long").alias("file_size_bytes"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key + 86_400 * longer).alias("modification_time"),
    )


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings with the customer and the address they are billed under; one in 20 customers
    has a second building that nothing printed tells apart."""
    key = F.col("c_custkey")
    number = F.concat(F.lit("BLD-"), key)
    ids = F.when(key % 20 == 7, F.array(number, F.concat(number, F.lit("-B")))).otherwise(F.array(number))
    return table(spark, sf_dir, "customer").where(key % 10 != 9).select(
        F.explode(ids).alias("building_id"), *_party()
    )


def _party() -> list[Column]:
    key = F.col("c_custkey")
    name = F.concat_ws(
        " ", F.initcap("c_mktsegment"), F.concat(F.lit("Nation"), "c_nationkey"), F.lit("Trading Co"), key
    )
    address = F.concat_ws(
        " ", key % 97 + 1, F.concat(F.lit("Elm"), key % 53), F.lit("Street"),
        F.concat(F.lit("City"), key % 31),
    )
    return [name.alias("customer_name"), address.alias("service_address")]


def party_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bill line item as a text file that names its customer and address, by rule in other
    letters and signs, with the two exchanged, a word left out, one word or several misspelt,
    without the name, or without either."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", *_party())
    lines = _with_orders(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    rows = lines.join(customers.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    case = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    name, address = F.col("customer_name"), F.col("service_address")
    printed_name = (
        F.when(case == 1, F.concat(F.upper(F.replace(name, F.lit(" "), F.lit(", "))), F.lit(".")))
        .when(case == 2, address)
        .when(case == 3, F.replace(name, F.lit(" Trading"), F.lit("")))
        .when(case.isin(4, 5), F.replace(name, F.lit(" Nation"), F.lit("x Nation")))
        .when(case < 4, name)
    )
    printed_address = (
        F.when(case == 2, name)
        .when(case == 5, F.replace(F.replace(address, F.lit("Elm"), F.lit("Alm")), F.lit("City"), F.lit("Zity")))
        .when(case != 7, address)
    )
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("file_path"),
        utility_of("l_partkey").alias("utility_type"),
        vendor_of("l_suppkey").alias("vendor_id"),
        F.concat_ws(
            "\n",
            F.lit("Utility bill"),
            F.concat(F.lit("Customer name: "), printed_name),
            F.concat(F.lit("Service address: "), printed_address),
            F.concat(F.lit("Account No: ACC-"), F.col("o_custkey")),
        ).cast("binary").alias("content"),
    )


def meter_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings dealt over the years that bills are from, a building for each meter."""
    days = "8037 + (event_id * 7) % 2556"
    events = table(spark, sf_dir, "events").withColumn(
        "ts", F.expr(f"cast(ts AS timestamp) - make_dt_interval(cast({days} AS int))")
    )
    return _readings(events).withColumn("building_id", F.concat(F.lit("BLD-"), "meter_id"))


def conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as the parser's JSON, one text file each: turns are the elements. One in
    10 has none, one in 7 is broken."""
    turn = F.struct(
        "turn", F.to_json(F.struct(F.col("role").alias("type"), F.col("text").alias("content"))).alias("element")
    )
    good = F.concat(
        F.lit('{"document":{"elements":['),
        F.array_join(F.array_sort(F.collect_list(turn))["element"], ","),
        F.lit("]}}"),
    )
    key = F.col("conv_id")
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(good.alias("good"))
        .select(
            F.when(key % 10 == 1, F.lit('{"document":{"elements":[]}}'))
            .when(key % 7 == 3, F.concat(F.lit("{"), F.col("good")))
            .otherwise(F.col("good"))
            .alias("text"),
            utility_of("conv_id").alias("bill_type"),
            vendor_of("conv_id").alias("vendor_id"),
        )
    )


def land(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    """Adds `text, bill_type, vendor_id` rows as one text file each (with a line end after
    it) below bill_type=/vendor_id= folders. Opening files is the cost, so the rows are
    dealt out evenly over all cores first, and each task moves its own files into place: by
    default the driver moves all of them, one after the other."""
    cores = spark.sparkContext.defaultParallelism
    (
        rows.repartition(cores)
        .write.mode("append")
        .partitionBy("bill_type", "vendor_id")
        .option("maxRecordsPerFile", 1)
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        .text(folder)
    )
