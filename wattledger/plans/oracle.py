"""The SQL each query must agree with, over the same tables read by another engine."""

from wattledger.schemas import VENDOR_PARSER


def _utility(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'electricity' WHEN 1 THEN 'gas' ELSE 'water' END"


def _vendor(key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 0 THEN 'CPC001' WHEN 1 THEN 'REC002' WHEN 2 THEN 'MGU001' "
        f"WHEN 3 THEN 'NGS002' ELSE 'AMW001' END"
    )


_TYPED = """
raw AS (
  SELECT *,
    l_orderkey % 211 = 0 AS all_missing,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS sub,
    CAST(l_tax AS DECIMAL(4,2)) AS rate,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
    l_orderkey || '-' || l_linenumber || '-' || l_partkey AS num
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
texts AS (
  SELECT
    CASE WHEN all_missing OR l_orderkey % 97 = 0 THEN NULL ELSE 'BILL-' || num END AS bill_id,
    'STR-' || o_custkey AS store_id,
    CASE l_partkey % 3 WHEN 0 THEN 'electricity' WHEN 1 THEN 'gas' ELSE 'water' END AS commodity,
    CASE WHEN l_partkey % 101 = 0 THEN 'steam' WHEN l_partkey % 3 = 0 THEN 'electricity'
         WHEN l_partkey % 3 = 1 THEN 'gas' ELSE 'water' END AS bill_type_partition,
    printf('V%03d', l_suppkey) AS vendor_id,
    CASE WHEN all_missing THEN NULL WHEN l_orderkey % 83 = 0 THEN 'not-a-date'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS bill_start_raw,
    CASE WHEN all_missing THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS bill_end_raw,
    CASE WHEN all_missing THEN NULL
         WHEN l_quantity = 13 THEN '0'
         WHEN l_linenumber = 7 AND l_quantity > 45 THEN 'N/A'
         WHEN l_returnflag = 'R' AND l_quantity < 5 THEN '-' || qty
         ELSE qty END AS consumption_raw,
    CASE WHEN l_partkey % 89 = 0 THEN 'MWh' WHEN l_partkey % 3 = 0 THEN 'kWh'
         WHEN l_partkey % 3 = 1 THEN 'therms' ELSE 'gallons' END AS unit,
    CAST(sub AS DOUBLE) AS subtotal,
    CAST(CAST(sub * rate AS DECIMAL(18,4)) AS DOUBLE) AS tax,
    CASE WHEN all_missing OR l_orderkey % 61 = 0 THEN NULL
         ELSE CAST(CAST(sub * (1 + rate) AS DECIMAL(18,4))
              + CASE WHEN l_orderkey % 59 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4)) END AS cost,
    'bill_type=x/vendor_id=' || l_suppkey || '/' || l_orderkey || '_' || l_linenumber || '_'
      || l_partkey || '.pdf' AS source_file
  FROM raw
),
single AS (
  SELECT bill_id, store_id, commodity, vendor_id,
    TRY_CAST(bill_start_raw AS DATE) AS bill_start_date,
    TRY_CAST(bill_end_raw AS DATE) AS bill_end_date,
    consumption_raw, TRY_CAST(consumption_raw AS DOUBLE) AS consumption,
    unit, subtotal, tax,
    CAST(cost AS VARCHAR) AS cost_raw, CAST(cost AS DOUBLE) AS cost_usd,
    source_file, bill_type_partition, bill_start_raw
  FROM texts
),
typed AS (
  SELECT * EXCLUDE (bill_start_raw) FROM single
  UNION ALL
  SELECT * EXCLUDE (bill_start_raw) FROM single WHERE substr(bill_start_raw, 9, 2) = '15'
)
"""

_REFERENCE = """
buildings AS (
  SELECT 'STR-' || c_custkey AS store_id, 'BLD-' || c_custkey AS building_id
  FROM customer WHERE c_custkey % 10 <> 9
),
vendors AS (
  SELECT printf('V%03d', s_suppkey) AS vendor_id, s_name AS vendor
  FROM supplier WHERE s_suppkey % 20 <> 19
)
"""

_MISSING = """nullif(concat_ws(',',
  CASE WHEN bill_id IS NULL THEN 'bill_id' END,
  CASE WHEN bill_start_date IS NULL THEN 'bill_start_date' END,
  CASE WHEN bill_end_date IS NULL THEN 'bill_end_date' END,
  CASE WHEN consumption IS NULL THEN 'consumption' END,
  CASE WHEN cost_usd IS NULL THEN 'cost_usd' END), '')"""

_STATUS = """CASE
  WHEN coalesce(bill_id, CAST(bill_start_date AS VARCHAR), CAST(bill_end_date AS VARCHAR),
       CAST(consumption AS VARCHAR), CAST(cost_usd AS VARCHAR)) IS NULL THEN 'FAILED'
  WHEN bill_id IS NULL OR bill_start_date IS NULL OR bill_end_date IS NULL
       OR consumption IS NULL OR cost_usd IS NULL THEN 'PARTIAL'
  ELSE 'SUCCESS' END"""

_FLAGS = f"""
  CASE WHEN consumption < 0 THEN 'true' ELSE 'false' END AS is_negative_consumption,
  CASE WHEN consumption = 0 THEN 'true' ELSE 'false' END AS is_zero_consumption,
  CASE WHEN {_MISSING} IS NULL THEN 'false' ELSE 'true' END AS has_missing_required_field,
  {_MISSING} AS missing_fields
"""

_EXPECTED = "CASE commodity WHEN 'electricity' THEN 'kWh' WHEN 'gas' THEN 'therms' WHEN 'water' THEN 'gallons' END"


def _money(name: str) -> str:
    return f"CAST({name} AS DECIMAL(18,4))"


_WRONG_TOTAL = f"{_money('cost_usd')} <> {_money('subtotal')} + {_money('tax')}"

_BROKEN = {
    "missing_required_field": f"{_MISSING} IS NOT NULL",
    "unknown_vendor": "vendor IS NULL",
    "unknown_utility_type": "bill_type_partition NOT IN ('electricity', 'gas', 'water')",
    "invalid_period": "NOT coalesce(bill_end_date >= bill_start_date, false)",
    "consumption_not_numeric": "consumption_raw IS NOT NULL AND consumption IS NULL",
    "charge_not_numeric": "cost_raw IS NOT NULL AND cost_usd IS NULL",
    "unlikely_amount": "greatest(abs(consumption), abs(cost_usd)) >= 1000000000000",
    "wrong_unit": f"unit <> {_EXPECTED}",
    "wrong_total": _WRONG_TOTAL,
    "unmapped_building": "building_id IS NULL",
}

_REASONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _BROKEN.items()
) + ")"


def _on_typed(select: str) -> str:
    return f"WITH {_TYPED} {select}"


def _on_bills(select: str) -> str:
    return f"WITH {_TYPED}, bills AS (SELECT DISTINCT * FROM typed) {select}"


def _on_enriched(select: str) -> str:
    return f"""WITH {_TYPED}, bills AS (SELECT DISTINCT * FROM typed), {_REFERENCE},
enriched AS (
  SELECT b.*, building_id, vendor FROM bills b
  LEFT JOIN buildings USING (store_id) LEFT JOIN vendors USING (vendor_id)
) {select}"""


_MONTH = "CAST(date_trunc('month', bill_start_date) AS DATE)"
_TOTALS = f"""count(*) AS bills, CAST(sum({_money('consumption')}) AS DOUBLE) AS consumption,
  CAST(sum({_money('cost_usd')}) AS DOUBLE) AS cost_usd"""


_BILL_COLUMNS = """bill_id, store_id, commodity, vendor_id,
  CAST(bill_start_date AS VARCHAR) AS bill_start_date, CAST(bill_end_date AS VARCHAR) AS bill_end_date,
  consumption_raw, consumption, unit, subtotal, tax, cost_raw, cost_usd, source_file,
  bill_type_partition"""

_BILLS_BY_DESTINATION = f"""
SELECT CASE WHEN {_REASONS} = '' THEN 'valid' ELSE 'quarantine' END AS destination,
  source_file, bill_id, {_REASONS} AS reasons FROM enriched"""


# --- documents

_LINES = f"""
SELECT doc_id, 'doc/' || doc_id AS file_path, {_utility('doc_id')} AS utility_type,
  {_vendor('doc_id')} AS vendor_id, unnest(string_split(text, chr(10))) AS content,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
FROM documents"""

_VARIANT_ELEMENTS = f"""
WITH lines AS ({_LINES})
SELECT file_path, utility_type, vendor_id, CAST(i AS INTEGER) AS element_index,
  CASE WHEN i % 7 = 3 THEN '3' ELSE 'text' END AS element_type,
  content,
  CASE WHEN i % 5 <> 4 THEN CAST('0.' || (1 + i % 9) AS DOUBLE) END AS confidence,
  CASE WHEN i % 6 <> 5 THEN i || ',3,20,' || (i + 10) END AS bbox_coord,
  CASE WHEN i % 6 <> 5 THEN CAST(i // 10 AS INTEGER) END AS page_id,
  CASE WHEN i % 4 = 0 THEN 'lead' END AS description,
  'SUCCESS' AS parse_status, CAST(NULL AS VARCHAR) AS parse_error
FROM lines WHERE doc_id % 50 > 3
UNION ALL
SELECT 'doc/' || doc_id, {_utility('doc_id')}, {_vendor('doc_id')}, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, 'FAILED',
  CASE WHEN doc_id % 50 = 3 THEN 'document is not valid JSON' ELSE 'document has no elements' END
FROM documents WHERE doc_id % 50 <= 3"""

_LINE_TAGS = (
    "title|h1|h2|h3|h4|h5|h6|p|div|pre|blockquote|li|th|td|caption|figcaption|html|head|body|header"
    "|footer|main|section|article|aside|nav|address|form|fieldset|legend|figure|details|summary"
    "|table|thead|tbody|tfoot|tr|ul|ol|menu|dl|dt|dd|option|noscript"
)


def _characters(text: str) -> str:
    """Named characters of the test pages."""
    for name, character in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
        ("&middot;", "·"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{name}', '{character}')"
    return text


# Tags that begin or end a block become a mark of two control characters around their name,
# all others go; the page is then cut at the marks.
_HTML = rf"""
WITH visible AS (
  SELECT page_id, regexp_replace(regexp_replace(html,
    '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
    '(?i)</?(br|hr|img|input|wbr)([\s/][^>]*)?>', ' ', 'g') AS page FROM pages
),
marked AS (
  SELECT page_id, regexp_replace(regexp_replace(page, '(?i)<(/?)({_LINE_TAGS})([\s/][^>]*)?>',
    chr(1) || '\1\2' || chr(2), 'g'), '<[^>]*>', '', 'g') AS page FROM visible
),
blocks AS (
  SELECT page_id, unnest(m) AS block, generate_subscripts(m, 1) AS place
  FROM (SELECT page_id, string_split('body' || chr(2) || page, chr(1)) AS m FROM marked)
),
read AS (
  SELECT page_id, place, lower(string_split(block, chr(2))[1]) AS tag,
    trim(regexp_replace({_characters("string_split(block, chr(2))[2]")}, '\s+', ' ', 'g')) AS content
  FROM blocks
),
found AS (
  SELECT p.page_id, r.content, r.tag,
    CASE WHEN r.page_id IS NOT NULL
         THEN row_number() OVER (PARTITION BY p.page_id ORDER BY r.place) - 1 END AS place
  FROM pages p LEFT JOIN (SELECT * FROM read WHERE content <> '') r ON p.page_id = r.page_id
),
elements AS (
  SELECT page_id, 'page/' || page_id AS file_path, {_utility('page_id')} AS utility_type,
    {_vendor('page_id')} AS vendor_id, CAST(place AS INTEGER) AS element_index,
    CASE WHEN place IS NULL THEN NULL WHEN tag = 'title' THEN 'title'
      WHEN tag IN ('h1', 'h2', 'h3', 'h4', 'h5', 'h6') THEN 'section_header'
      WHEN tag = 'li' THEN 'list_item' WHEN tag IN ('th', 'td') THEN 'table_cell'
      WHEN tag IN ('caption', 'figcaption') THEN 'caption' ELSE 'text' END AS element_type, content,
    CASE WHEN place IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS parse_status
  FROM found
)"""

_VISIBLE_TEXT = rf"""
SELECT 'page/' || page_id AS file_path, regexp_replace({_characters(r"""
  regexp_replace(regexp_replace(html,
    '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')""")},
  '\s+', '', 'g') AS visible
FROM pages"""

_LANDED_ELEMENTS = (
    f"{_HTML} SELECT utility_type, vendor_id, element_index, element_type, content FROM elements"
)

_EVENTS = "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events"

_EXTRACTORS = " ".join(f"WHEN '{v}' THEN '{name}_v1'" for v, name in VENDOR_PARSER.items())

_PRINTED = f"""
WITH printed AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS num,
    {_utility('l_partkey')} AS commodity, {_vendor('l_suppkey')} AS vendor_id,
    l_orderkey % 211 = 0 AS blank, l_orderkey % 97 = 0 AS unnumbered, l_orderkey % 83 = 0 AS undated,
    CAST(l_shipdate AS DATE) AS shipped, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
    CASE l_partkey % 3 WHEN 0 THEN 'kWh' WHEN 1 THEN 'therms' ELSE 'gallons' END AS unit_name,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS sub,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax2,
    'STR-' || o_custkey AS store, 'ACC-' || o_custkey AS account, l_orderkey % 71 = 0 AS doubled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
merged AS (
  SELECT num || '-' || qty || '-' || CAST(sub * 100 AS BIGINT) || '.pdf' AS source_file,
    commodity, vendor_id,
    max(CASE WHEN NOT blank AND NOT unnumbered THEN num END) AS bill_id,
    max(CASE WHEN NOT blank THEN store END) AS store_id,
    max(CASE WHEN NOT blank THEN account END) AS account_number,
    max(CASE WHEN NOT blank AND doubled AND sub + tax2 <> 1 THEN 'conflicting: cost_usd' END) AS conflict,
    max(CASE WHEN NOT blank AND NOT undated THEN shipped - 30 END) AS bill_start_date,
    max(CASE WHEN NOT blank AND NOT undated THEN shipped END) AS bill_end_date,
    CAST(max(CASE WHEN NOT blank THEN qty END) AS DOUBLE) AS consumption,
    max(CASE WHEN NOT blank THEN unit_name END) AS unit,
    CAST(max(CASE WHEN NOT blank THEN CAST(sub AS VARCHAR) END) AS DOUBLE) AS subtotal,
    CAST(max(CASE WHEN NOT blank THEN CAST(tax2 AS VARCHAR) END) AS DOUBLE) AS tax,
    CAST(max(CASE WHEN NOT blank THEN CAST(sub + tax2 AS VARCHAR) END) AS DOUBLE) AS cost_usd
  FROM printed GROUP BY 1, commodity, vendor_id
)
SELECT * EXCLUDE (conflict) REPLACE (strftime(bill_start_date, '%Y-%m-%d') AS bill_start_date,
                  strftime(bill_end_date, '%Y-%m-%d') AS bill_end_date),
  CASE vendor_id {_EXTRACTORS} END AS parser_version,
  {_STATUS} AS parse_status,
  nullif(concat_ws('; ', 'missing: ' || {_MISSING}, conflict), '') AS parse_error
FROM merged"""

_METER = """
WITH reads AS (
  SELECT ts, user_id, CASE WHEN event_id % 37 <> 0 THEN value END AS kwh, event_type AS source_file
  FROM events
  UNION ALL
  SELECT ts, user_id, value + 1, 'late' FROM events WHERE event_id % 20 = 0
)"""


def _trend(source: str) -> str:
    return f"""
    , monthly AS (
      SELECT store_id, commodity, {_MONTH} AS bill_month, sum({_money('consumption')}) AS used
      FROM {source} GROUP BY ALL)
    SELECT m.store_id, m.commodity, CAST(m.bill_month AS VARCHAR) AS bill_month,
      CAST(m.used AS DOUBLE) AS consumption,
      CAST(any_value(p.used) FILTER (WHERE p.bill_month = m.bill_month - INTERVAL 1 MONTH)
           AS DOUBLE) AS previous,
      CAST(m.used - any_value(p.used) FILTER (
           WHERE p.bill_month = m.bill_month - INTERVAL 1 MONTH) AS DOUBLE) AS change,
      CAST(sum(p.used) AS DOUBLE) AS last_three
    FROM monthly m LEFT JOIN monthly p ON m.store_id = p.store_id
      AND m.commodity = p.commodity AND p.bill_month <= m.bill_month
      AND p.bill_month >= m.bill_month - INTERVAL 2 MONTH
    GROUP BY m.store_id, m.commodity, m.bill_month, m.used"""


_PARTY = """
parties AS (
  SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Nation' || c_nationkey
      || ' Trading Co ' || c_custkey AS name,
    (c_custkey % 97 + 1) || ' Elm' || (c_custkey % 53) || ' Street City' || (c_custkey % 31) AS address
  FROM customer
),
cases AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS file_path,
    (l_orderkey + l_linenumber) % 8 AS c, name, address
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN parties ON c_custkey = o_custkey
),
printed AS (
  SELECT file_path, CASE
      WHEN c = 2 THEN address || ' ' || name
      WHEN c = 3 THEN replace(name, ' Trading', '') || ' ' || address
      WHEN c = 4 THEN replace(name, ' Nation', 'x Nation') || ' ' || address
      WHEN c = 5 THEN replace(replace(replace(name || ' ' || address, ' Nation', 'x Nation'),
        'Elm', 'Alm'), 'City', 'Zity')
      WHEN c = 6 THEN address
      WHEN c < 2 THEN name || ' ' || address END AS whole
  FROM cases
),
bill_parties AS (
  SELECT file_path, list_sort(list_distinct(string_split(lower(whole), ' '))) AS words FROM printed
),
known AS (
  SELECT unnest(CASE WHEN c_custkey % 20 = 7 THEN ['BLD-' || c_custkey, 'BLD-' || c_custkey || '-B']
      ELSE ['BLD-' || c_custkey] END) AS building_id,
    list_sort(list_distinct(string_split(lower(name || ' ' || address), ' '))) AS words
  FROM parties WHERE c_custkey % 10 <> 9
),
names AS (SELECT DISTINCT words FROM bill_parties WHERE words IS NOT NULL),
shared AS (
  SELECT n.words, k.building_id, any_value(len(k.words)) AS size, count(*) AS common
  FROM (SELECT words, unnest(words) AS word FROM names) n
  JOIN (SELECT building_id, words, unnest(words) AS word FROM known) k USING (word)
  GROUP BY n.words, k.building_id
),
scored AS (
  SELECT words, building_id, common / (len(words) + size - common) AS similarity FROM shared
  WHERE common / (len(words) + size - common) >= 0.7
),
best AS (
  SELECT words, max(similarity) AS similarity, count(*) AS candidates, min(building_id) AS building_id
  FROM (SELECT *, max(similarity) OVER (PARTITION BY words) AS top FROM scored)
  WHERE similarity = top GROUP BY words
),
linked AS (
  SELECT words, array_to_string(words, ' ') AS party,
    CASE WHEN candidates = 1 THEN building_id END AS building_id, similarity,
    coalesce(candidates, 0) AS candidates,
    CASE WHEN candidates = 1 THEN 'LINKED' WHEN candidates > 1 THEN 'AMBIGUOUS' ELSE 'UNMATCHED' END
      AS link
  FROM names LEFT JOIN best USING (words)
)"""

_PERIODS = """
, periods AS (
  SELECT building_id, commodity, bill_start_date, bill_end_date, count(*) AS bills,
    min(bill_id) AS first_bill_id
  FROM enriched WHERE building_id IS NOT NULL AND bill_end_date >= bill_start_date GROUP BY ALL),
swept AS (
  SELECT *, max(bill_end_date) OVER (PARTITION BY building_id, commodity
    ORDER BY bill_start_date, bill_end_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM periods)"""


def _dealt(name: str) -> str:
    """The share of an amount that a part of a bill gets, in columns to be selected in turn."""
    return f"""
    dealt_{name} AS (
      SELECT *, abs(u_{name}) * n // total AS b_{name}, abs(u_{name}) * n % total AS r_{name}
      FROM before_{name}),
    ranked_{name} AS (
      SELECT *, CAST(CASE WHEN u_{name} < 0 THEN -1 ELSE 1 END * (b_{name} + CASE WHEN
          row_number() OVER (PARTITION BY row ORDER BY r_{name} DESC, part_start)
          <= abs(u_{name}) - sum(b_{name}) OVER (PARTITION BY row) THEN 1 ELSE 0 END) AS DECIMAL(24,0))
          * CAST(0.0001 AS DECIMAL(4,4)) AS p_{name}
      FROM dealt_{name})"""


_AMOUNTS = ("consumption", "subtotal", "tax", "cost_usd")
_UNITS = ", ".join(f"CAST({_money(a)} * 10000 AS HUGEINT) AS u_{a}" for a in _AMOUNTS)
_MONTH_PARTS = f"""
, numbered AS (SELECT *, row_number() OVER () AS row, {_UNITS} FROM enriched),
months AS (
  SELECT *, unnest(generate_series(date_trunc('month', bill_start_date),
      date_trunc('month', bill_end_date), INTERVAL 1 MONTH)) AS month
  FROM numbered WHERE bill_end_date >= bill_start_date),
cut AS (
  SELECT *, greatest(month::DATE, bill_start_date) AS part_start,
    least(last_day(month::DATE), bill_end_date) AS part_end,
    bill_end_date - bill_start_date + 1 AS total FROM months),
before_consumption AS (SELECT *, part_end - part_start + 1 AS n FROM cut),
{_dealt("consumption")},
before_subtotal AS (FROM ranked_consumption), {_dealt("subtotal")},
before_tax AS (FROM ranked_subtotal), {_dealt("tax")},
before_cost_usd AS (FROM ranked_tax), {_dealt("cost_usd")},
parts AS (
  SELECT source_file, bill_id, store_id, building_id, commodity, part_start AS bill_start_date,
    part_end AS bill_end_date, n AS days, {", ".join(f"p_{a} AS {a}" for a in _AMOUNTS)}
  FROM ranked_cost_usd
  UNION ALL
  SELECT source_file, bill_id, store_id, building_id, commodity, bill_start_date, bill_end_date,
    NULL, {", ".join(f"{_money(a)} AS {a}" for a in _AMOUNTS)}
  FROM numbered WHERE NOT coalesce(bill_end_date >= bill_start_date, false))"""


ORACLE_SQL: dict[str, str] = {
    "variant_elements": _VARIANT_ELEMENTS,
    "variant_casts": """
        SELECT event_id,
          CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN NULL
               ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k_number,
          CASE WHEN event_id % 41 = 0 THEN 'x' WHEN event_id % 43 = 0 THEN NULL
               ELSE json_extract_string(props, '$.k') END AS k_text,
          CAST(NULL AS VARCHAR) AS k_inside
        FROM events""",
    "text_elements": f"""
        SELECT file_path, CAST(i AS INTEGER) AS element_index, 'text' AS element_type, content,
          'SUCCESS' AS parse_status FROM ({_LINES})""",
    "html_elements": f"""{_HTML}
        SELECT file_path, element_index, element_type, content, parse_status FROM elements""",
    "html_text_kept": _VISIBLE_TEXT,
    "landing_projection": f"""
        SELECT url AS file_path, string_split(url, '/')[-1] AS file_name,
          {_utility('page_id')} AS utility_type, {_vendor('page_id')} AS vendor_id,
          octet_length(encode(html)) AS file_size_bytes FROM pages""",
    "landing_stream": f"""
        SELECT {_utility('page_id')} AS utility_type, {_vendor('page_id')} AS vendor_id,
          octet_length(encode(html)) + 1 AS file_size_bytes FROM pages""",
    "landing_audit": f"""
        SELECT {_utility('page_id')} AS utility_type, {_vendor('page_id')} AS vendor_id,
          count(*) AS files FROM pages WHERE page_id % 10 = 7 GROUP BY ALL""",
    "partition_discovery": """
        SELECT event_type, count(*) AS events,
          CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value FROM events GROUP BY event_type""",
    "content_fetch": f"""
        SELECT {_utility('page_id')} AS utility_type, {_vendor('page_id')} AS vendor_id,
          md5(html || chr(10)) AS digest, CAST(NULL AS VARCHAR) AS fetch_error FROM pages
        UNION ALL
        SELECT {_utility('page_id')}, {_vendor('page_id')}, NULL, 'file not found' FROM pages""",
    "element_stream": _LANDED_ELEMENTS,
    "reprocess_equals_stream": _LANDED_ELEMENTS,
    "registry_stream": _EVENTS,
    "idempotent_sink": _EVENTS,
    "batch_metrics": "SELECT count(*) AS reported, count(*) AS stored FROM events",
    "quarantine_sink": _on_enriched(_BILLS_BY_DESTINATION),
    "rule_extract": f"""
        WITH urls AS (SELECT page_id, {_vendor('page_id')} AS vendor_id, url FROM pages),
        found AS (
          SELECT page_id, vendor_id, 'host' AS field, CASE WHEN vendor_id = 'CPC001'
            THEN regexp_extract(url, '^https?://(?:www\\.|m\\.|blog\\.)?([^/:?#]+)', 1)
            ELSE regexp_extract(url, '^https?://([^/:?#]+)', 1) END AS value FROM urls
          UNION ALL
          SELECT page_id, vendor_id, 'language', regexp_extract(url, '^https?://[^/]+/([a-z]{{2}})/', 1)
          FROM urls
          UNION ALL
          SELECT page_id, vendor_id, 'number', regexp_extract(url, '/([0-9]+)(?:[/?#.].*)?$', 1) FROM urls
          UNION ALL
          SELECT page_id, vendor_id, 'query', regexp_extract(url, '\\?(.*)$', 1) FROM urls
          WHERE vendor_id = 'AMW001'
        )
        SELECT * FROM found WHERE value <> ''""",
    "gold_pivot": """
        SELECT conv_id,
          coalesce(string_agg(text, ',' ORDER BY turn) FILTER (WHERE role = 'system'), '') AS system,
          coalesce(string_agg(text, ',' ORDER BY turn) FILTER (WHERE role = 'user'), '') AS "user",
          coalesce(string_agg(text, ',' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')
            AS assistant
        FROM conversations GROUP BY conv_id""",
    "bill_extract_elements": _PRINTED,
    "extracted_layout": f"""
        SELECT bill_id, building_id, commodity, lower(vendor_id) AS vendor, vendor_id,
          bill_start_date, bill_end_date, consumption, unit, cost_usd, source_file,
          commodity AS bill_type_partition, parser_version, parse_status, parse_error
        FROM ({_PRINTED}) LEFT JOIN (
          SELECT 'STR-' || c_custkey AS store_id, 'BLD-' || c_custkey AS building_id
          FROM customer WHERE c_custkey % 10 <> 9) USING (store_id)""",
    "buildings_csv": """
        SELECT 'STR-' || c_custkey AS store_id, 'BLD-' || c_custkey AS building_id
        FROM customer WHERE c_custkey % 10 <> 9""",
    "dotted_table": _EVENTS,
    "empty_batch": """
        SELECT count(*) AS stored, 1 AS batches, count(*) AS "full", 0 AS empty FROM events""",
    "quarantine_replay": _on_enriched(_BILLS_BY_DESTINATION),
    "element_stream_json": f"""
        WITH turns AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, role, text
          FROM conversations WHERE conv_id % 10 <> 1 AND conv_id % 7 <> 3)
        SELECT {_utility('conv_id')} AS utility_type, {_vendor('conv_id')} AS vendor_id,
          CAST(place AS INTEGER) AS element_index, role AS element_type, text AS content,
          'SUCCESS' AS parse_status, CAST(NULL AS VARCHAR) AS parse_error FROM turns
        UNION ALL
        SELECT {_utility('conv_id')}, {_vendor('conv_id')}, NULL, NULL, NULL, 'FAILED',
          CASE WHEN conv_id % 10 = 1 THEN 'document has no elements'
               ELSE 'document is not valid JSON' END
        FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 10 = 1 OR conv_id % 7 = 3)""",
    "bill_extract": _PRINTED,
    "bill_typed": _on_typed(f"SELECT {_BILL_COLUMNS} FROM typed"),
    "bill_exact_dedup": _on_bills(
        f"SELECT {_BILL_COLUMNS}, 1700000000000000 AS ingestion_ts FROM bills"
    ),
    "quality_flags": _on_bills(f"SELECT source_file, bill_id, {_FLAGS} FROM bills"),
    "parse_status": _on_bills(f"""
        SELECT {_STATUS} AS parse_status, count(*) AS bills, count(DISTINCT {_MISSING}) AS kinds
        FROM bills GROUP BY 1"""),
    "partition_crosscheck": _on_bills("""
        SELECT source_file, commodity, bill_type_partition FROM bills
        WHERE commodity <> bill_type_partition"""),
    "unknown_utility_type": _on_bills("""
        SELECT source_file, bill_type_partition FROM bills
        WHERE bill_type_partition NOT IN ('electricity', 'gas', 'water')"""),
    "unit_check": _on_bills(f"""
        SELECT source_file, commodity, unit, {_EXPECTED} AS expected_unit FROM bills
        WHERE unit <> {_EXPECTED}"""),
    "period_check": _on_bills("""
        SELECT source_file, CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date,
          CASE WHEN bill_end_date >= bill_start_date THEN 'true' ELSE 'false' END AS is_valid_period
        FROM bills"""),
    "total_check": _on_bills(
        f"SELECT source_file, subtotal, tax, cost_usd FROM bills WHERE {_WRONG_TOTAL}"
    ),
    "filename_tokens": _on_bills("""
        , named AS (
          SELECT 'raw/' || concat_ws('_', vendor_id, store_id, commodity,
            strftime(bill_start_date, '%Y-%m'), bill_id) || '.pdf' AS path,
            vendor_id, store_id, commodity, strftime(bill_start_date, '%Y-%m') AS m, bill_id,
            bill_start_date IS NOT NULL AND bill_id IS NOT NULL AS whole
          FROM bills)
        SELECT path, CASE WHEN whole THEN vendor_id END AS name_vendor_id,
          CASE WHEN whole THEN store_id END AS name_store_id,
          CASE WHEN whole THEN commodity END AS name_commodity,
          CASE WHEN whole THEN m END AS name_bill_month,
          CASE WHEN whole THEN bill_id END AS name_bill_id FROM named"""),
    "building_enrich": _on_enriched("SELECT source_file, store_id, building_id FROM enriched"),
    "building_unmapped": _on_enriched("""
        SELECT store_id, count(*) AS bills FROM enriched WHERE building_id IS NULL
        GROUP BY store_id"""),
    "vendor_enrich": _on_enriched("SELECT source_file, vendor_id, vendor FROM enriched"),
    "clean_bills": _on_enriched(f"""
        SELECT bill_id, building_id, commodity, coalesce(vendor, vendor_id) AS vendor, vendor_id,
          CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date,
          consumption, unit, cost_usd, source_file, {_FLAGS} FROM enriched"""),
    "quarantine_split": _on_enriched(_BILLS_BY_DESTINATION),
    "dq_summary": _on_enriched(" UNION ALL ".join(
        f"SELECT '{name}' AS reason, count(*) AS bills FROM enriched WHERE {broken}"
        for name, broken in _BROKEN.items()
    )),
    "duplicate_bills": _on_enriched("""
        , known AS (
          SELECT * FROM enriched WHERE building_id IS NOT NULL AND bill_id IS NOT NULL
            AND bill_start_date IS NOT NULL AND bill_end_date IS NOT NULL),
        grouped AS (
          SELECT *, min(bill_id) OVER g AS first_bill_id, max(bill_id) OVER g AS last_bill_id,
            count(*) OVER g AS bills_in_period FROM known
          WINDOW g AS (PARTITION BY building_id, commodity, bill_start_date, bill_end_date))
        SELECT building_id, commodity, CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date, bill_id, first_bill_id, last_bill_id,
          bills_in_period, source_file
        FROM grouped WHERE first_bill_id <> last_bill_id"""),
    "meter_dedup": f"""{_METER}
        SELECT epoch_us(ts) AS timestamp, CAST(user_id % 50 AS VARCHAR) AS building_id,
          CAST(user_id AS VARCHAR) AS meter_id, kwh, source_file,
          CASE WHEN kwh IS NULL THEN 'true' ELSE 'false' END AS is_missing_kwh
        FROM (SELECT *, row_number() OVER (PARTITION BY ts, user_id
                ORDER BY kwh IS NOT NULL DESC, source_file DESC, kwh DESC) AS place FROM reads)
        WHERE place = 1""",
    "meter_feed": f"""{_METER}
        SELECT epoch_us(ts) AS timestamp, CAST(user_id % 50 AS VARCHAR) AS building_id,
          CAST(user_id AS VARCHAR) AS meter_id, kwh, source_file,
          CASE WHEN kwh IS NULL THEN 'true' ELSE 'false' END AS is_missing_kwh
        FROM (SELECT *, row_number() OVER (PARTITION BY ts, user_id
                ORDER BY kwh IS NOT NULL DESC, source_file DESC, kwh DESC) AS place FROM reads)
        WHERE place = 1""",
    "late_readings": """
        SELECT DISTINCT epoch_us(ts - INTERVAL 4000 DAY) AS timestamp,
          CAST(user_id AS VARCHAR) AS meter_id
        FROM events WHERE user_id % 2 = 1""",
    "meter_dedup_stream": """
        SELECT DISTINCT epoch_us(ts) AS timestamp, CAST(user_id AS VARCHAR) AS meter_id FROM events""",
    "totals_by_store": _on_bills(f"SELECT store_id, commodity, {_TOTALS} FROM bills GROUP BY ALL"),
    "cost_by_commodity_month": _on_bills(f"""
        SELECT commodity, CAST({_MONTH} AS VARCHAR) AS bill_month, count(*) AS bills,
          CAST(sum({_money('cost_usd')}) AS DOUBLE) AS cost_usd,
          CAST(sum({_money('tax')}) AS DOUBLE) AS tax
        FROM bills GROUP BY 1, 2"""),
    "consumption_by_building_month": _on_enriched(f"""
        SELECT building_id, commodity, CAST({_MONTH} AS VARCHAR) AS bill_month, {_TOTALS}
        FROM enriched GROUP BY 1, 2, 3"""),
    "vendor_comparison": _on_enriched(f"""
        , totals AS (SELECT vendor_id, vendor, commodity, {_TOTALS} FROM enriched GROUP BY ALL)
        SELECT *, round(CASE WHEN consumption <> 0 THEN cost_usd / consumption END, 4)
          AS cost_per_unit FROM totals"""),
    "usage_trend": _on_bills(_trend("bills")),
    "consumption_anomaly": _on_bills("""
        , figures AS (
          SELECT vendor_id, commodity, avg(consumption) AS mean,
            stddev_samp(consumption) AS deviation
          FROM bills WHERE consumption IS NOT NULL GROUP BY ALL)
        SELECT vendor_id, commodity, source_file, bill_id, consumption,
          round((consumption - mean) / deviation, 4) AS z_score
        FROM bills JOIN figures USING (vendor_id, commodity)
        WHERE deviation > 0 AND abs((consumption - mean) / deviation) > 2"""),
    "gold_bills": _on_enriched("""
        SELECT building_id, coalesce(vendor, vendor_id) AS vendor, commodity AS utility_type,
          strftime(bill_start_date, '%Y-%m') AS billing_period,
          CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date, consumption, unit AS usage_unit,
          subtotal AS charges, tax AS taxes, cost_usd AS total_amount, bill_id, source_file
        FROM enriched"""),
    "replay_emptied": "SELECT *, 1 AS batch_id FROM (SELECT event_id, epoch_us(ts) AS ts, user_id,"
        " event_type, value, props FROM events) WHERE event_id % 2 = 1",
    "building_ambiguous": """
        SELECT 'STR-' || c_custkey AS store_id, 2 AS "values", 'BLD-' || c_custkey AS taken, 'Z' AS last
        FROM customer WHERE c_custkey % 10 = 7""",
    "lookup_guarded": _on_enriched("SELECT source_file, building_id, vendor FROM enriched"),
    "building_link": f"""WITH {_PARTY}
        SELECT party, building_id, similarity, candidates, link FROM linked""",
    "building_link_bills": f"""WITH {_PARTY}
        SELECT file_path, building_id, similarity, coalesce(candidates, 0) AS candidates,
          coalesce(link, 'UNMATCHED') AS link FROM bill_parties LEFT JOIN linked USING (words)""",
    "credit_amounts": """
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 7 = 6 THEN NULL
          WHEN l_linenumber % 7 = 4 THEN round(l_extendedprice, 2) ELSE -round(l_extendedprice, 2) END AS amount
        FROM lineitem""",
    "period_overlaps": _on_enriched(f"""{_PERIODS}
        SELECT building_id, commodity, CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date, bills, first_bill_id,
          CAST(reached AS VARCHAR) AS reached, least(reached, bill_end_date) - bill_start_date + 1 AS days
        FROM swept WHERE reached >= bill_start_date"""),
    "period_gaps": _on_enriched(f"""{_PERIODS}
        SELECT building_id, commodity, CAST(reached + 1 AS VARCHAR) AS gap_start_date,
          CAST(bill_start_date - 1 AS VARCHAR) AS gap_end_date, bill_start_date - reached - 1 AS days,
          first_bill_id AS next_bill_id
        FROM swept WHERE bill_start_date > reached + 1"""),
    "bill_months": _on_enriched(f"""{_MONTH_PARTS}
        SELECT source_file, bill_id, CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date, days,
          CAST(consumption AS DOUBLE) AS consumption, CAST(cost_usd AS DOUBLE) AS cost_usd FROM parts"""),
    "cost_by_calendar_month": _on_enriched(f"""{_MONTH_PARTS}
        SELECT commodity, CAST({_MONTH} AS VARCHAR) AS bill_month, count(*) AS bills,
          CAST(sum(cost_usd) AS DOUBLE) AS cost_usd, CAST(sum(tax) AS DOUBLE) AS tax
        FROM parts GROUP BY 1, 2"""),
    "consumption_by_building_calendar_month": _on_enriched(f"""{_MONTH_PARTS}
        SELECT building_id, commodity, CAST({_MONTH} AS VARCHAR) AS bill_month, {_TOTALS}
        FROM parts GROUP BY 1, 2, 3"""),
    "metered_vs_billed": _on_enriched("""
        , reads AS (
          SELECT event_id, user_id, ts - to_days(CAST(8037 + (event_id * 7) % 2556 AS INTEGER)) AS ts,
            -- Of a reading and its late copy the one with a value counts, then the last source.
            CASE WHEN event_id % 20 = 0 AND (event_id % 37 = 0 OR event_type < 'late') THEN value + 1
                 WHEN event_id % 37 <> 0 THEN value END AS kwh
          FROM events),
        days AS (
          SELECT 'BLD-' || user_id AS building_id, CAST(ts AS DATE) AS day, count(*) AS held,
            count(kwh) AS readings, sum(CAST(kwh AS DECIMAL(28,4))) AS kwh
          FROM reads GROUP BY ALL),
        billed AS (
          SELECT *, row_number() OVER () AS row FROM enriched
          WHERE commodity = 'electricity' AND building_id IS NOT NULL AND bill_end_date >= bill_start_date)
        SELECT b.building_id, CAST(bill_start_date AS VARCHAR) AS bill_start_date,
          CAST(bill_end_date AS VARCHAR) AS bill_end_date, bill_id, source_file, consumption,
          CAST(sum(kwh) AS DOUBLE) AS metered_kwh,
          CAST(CAST(consumption AS DECIMAL(28,4)) - sum(kwh) AS DOUBLE) AS difference,
          CAST(coalesce(sum(readings), 0) AS BIGINT) AS readings,
          CAST(coalesce(sum(held - readings), 0) AS BIGINT) AS missing_readings,
          count(day) AS metered_days
        FROM billed b LEFT JOIN days d
          ON d.building_id = b.building_id AND day BETWEEN bill_start_date AND bill_end_date
        GROUP BY row, b.building_id, bill_start_date, bill_end_date, bill_id, source_file, consumption"""),
}
ORACLE_SQL["readings_merged"] = ORACLE_SQL["meter_dedup"]
ORACLE_SQL["usage_trend_calendar"] = _on_enriched(_MONTH_PARTS + _trend("parts"))
ORACLE_SQL["bill_extract_placed"] = _PRINTED
ORACLE_SQL["batch_figures"] = ORACLE_SQL["dq_summary"]
ORACLE_SQL["cost_by_month_refreshed"] = ORACLE_SQL["cost_by_commodity_month"]
ORACLE_SQL["consumption_by_building_refreshed"] = ORACLE_SQL["consumption_by_building_month"]
ORACLE_SQL["vendor_comparison_refreshed"] = ORACLE_SQL["vendor_comparison"]
ORACLE_SQL["consumption_outliers"] = _on_bills("""
    , medians AS (
      SELECT vendor_id, commodity, quantile_disc(consumption, 0.5) AS median
      FROM bills WHERE consumption IS NOT NULL GROUP BY ALL),
    away AS (
      SELECT vendor_id, commodity, source_file, bill_id, consumption, median,
        abs(consumption - median) AS away
      FROM bills JOIN medians USING (vendor_id, commodity) WHERE consumption IS NOT NULL),
    deviations AS (
      SELECT vendor_id, commodity, quantile_disc(away, 0.5) AS deviation FROM away GROUP BY ALL)
    SELECT vendor_id, commodity, source_file, bill_id, consumption, median, deviation,
      round(away / (deviation * 1.4826), 4) AS score
    FROM away JOIN deviations USING (vendor_id, commodity)
    WHERE deviation > 0 AND away / (deviation * 1.4826) > 1""")
ORACLE_SQL["file_versions"] = f"""
    WITH files AS (
      SELECT page_id, page_id % 5 AS fifth, 'page/' || page_id AS file_path,
        {_utility('page_id')} AS utility_type, {_vendor('page_id')} AS vendor_id,
        octet_length(encode(html)) AS size, (1700000000 + page_id) * 1000000 AS micros FROM pages),
    versions(fifth, version, change, more, valid_from, valid_to, ended_by) AS (VALUES
      (0, 1, 'ADDED', 0, 1, 2, 'CHANGED'), (0, 2, 'CHANGED', 1, 2, NULL, NULL),
      (1, 1, 'ADDED', 0, 1, 2, 'DELETED'), (1, 2, 'RETURNED', 0, 3, NULL, NULL),
      (2, 1, 'ADDED', 0, 1, NULL, NULL), (3, 1, 'ADDED', 0, 1, NULL, NULL),
      (4, 1, 'ADDED', 0, 2, NULL, NULL))
    SELECT file_path, version, change, utility_type, vendor_id, size + more AS file_size_bytes,
      micros + more * 86400000000 AS modification_time, valid_from, valid_to, ended_by
    FROM files JOIN versions USING (fifth)"""
