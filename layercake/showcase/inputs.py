"""Deterministic input faults injected into the driver tables.

The driver tables contain no NULLs, blanks, bad dates or duplicates, so each
showcase query first injects some with plain SQL expressions over the
**whole** table (no rows are dropped). The expressions are written in the
subset of SQL that Spark and DuckDB parse identically, so the same input
feeds both the Spark operator and the SQL oracle; the operator logic itself
is never shared.
"""

from __future__ import annotations

# orders with NULLs in three columns
ORDERS_WITH_NULLS = (
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
    "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice",
    "CAST(o_orderdate AS DATE) AS o_orderdate",
    "NULLIF(o_orderpriority, '2-HIGH') AS o_orderpriority",
)

# orders with padded and blank text
ORDERS_PADDED = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN '   ' "
    "WHEN o_orderkey % 7 = 1 THEN concat('  ', o_orderpriority, ' ') "
    "WHEN o_orderkey % 7 = 2 THEN '' ELSE o_orderpriority END AS o_orderpriority",
    "CASE WHEN o_orderkey % 5 = 0 THEN concat(' ', o_orderstatus) ELSE o_orderstatus END AS o_orderstatus",
)

# order status with case/space variants and NULLs
ORDERS_STATUS_VARIANTS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL "
    "WHEN o_orderkey % 4 = 0 THEN lower(o_orderstatus) "
    "WHEN o_orderkey % 4 = 1 THEN concat(' ', o_orderstatus, ' ') ELSE o_orderstatus END AS o_orderstatus",
)

# brand number as text, some corrupted
PART_BRAND_TEXT = (
    "p_partkey",
    "CASE WHEN p_partkey % 9 = 0 THEN concat(substr(p_brand, 7), '.5') "
    "WHEN p_partkey % 9 = 1 THEN concat(' ', substr(p_brand, 7), ' ') "
    "WHEN p_partkey % 9 = 2 THEN concat('x', substr(p_brand, 7)) "
    "WHEN p_partkey % 9 = 3 THEN concat('+', substr(p_brand, 7)) "
    "WHEN p_partkey % 9 = 4 THEN '' ELSE substr(p_brand, 7) END AS brand_text",
)

# composite product keys XX-YY-rest, some without prefix, some padded
PART_COMPOSITE_KEY = (
    "p_partkey",
    "CASE WHEN p_partkey % 6 = 0 THEN concat('P', CAST(p_partkey AS STRING)) "
    "WHEN p_partkey % 6 = 1 THEN concat(' ', substr(p_type, 1, 2), '-', substr(p_name, 1, 2), '-', "
    "CAST(p_partkey AS STRING), ' ') "
    "ELSE concat(lower(substr(p_type, 1, 2)), '-', substr(p_name, 1, 2), '-', CAST(p_partkey AS STRING)) "
    "END AS product_key",
)

# customers as raw CRM text rows
CUSTOMER_RAW = (
    "CASE WHEN c_custkey % 50 = 0 THEN 'n/a' WHEN c_custkey % 50 = 1 THEN concat(' ', CAST(c_custkey AS STRING), ' ') "
    "ELSE CAST(c_custkey AS STRING) END AS cst_id",
    "CASE WHEN c_custkey % 41 = 0 THEN ' ' "
    "WHEN c_custkey % 3 = 0 THEN concat('AW-', lpad(CAST(c_custkey AS STRING), 8, '0')) "
    "WHEN c_custkey % 3 = 1 THEN concat('aw', lpad(CAST(c_custkey AS STRING), 8, '0')) "
    "ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END AS cst_key",
    "concat(' ', split_part(c_name, '#', 1), ' ') AS cst_firstname",
    "split_part(c_name, '#', 2) AS cst_lastname",
    "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'm' WHEN 'BUILDING' THEN ' S ' WHEN 'MACHINERY' THEN 'Married' "
    "WHEN 'FURNITURE' THEN '' ELSE 'x' END AS cst_marital_status",
    "CASE WHEN c_nationkey % 3 = 0 THEN 'F' WHEN c_nationkey % 3 = 1 THEN ' male' ELSE NULL END AS cst_gndr",
    "CASE WHEN c_custkey % 37 = 0 THEN 'not a date' "
    "ELSE concat('20', lpad(CAST(10 + c_nationkey % 10 AS STRING), 2, '0'), '-', "
    "lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) "
    "END AS cst_create_date",
)

# customer names and business keys with CRM-style prefixes
CUSTOMER_KEYS = (
    "c_custkey",
    "c_name",
    CUSTOMER_RAW[1].replace(" AS cst_key", " AS customer_key"),
)

# a second record for every customer (duplicate ids): newer than the first
# for five nations, older for the rest, undated for every fourth customer
CUSTOMER_RAW_UPDATES = (
    "CAST(c_custkey AS STRING) AS cst_id",
    "concat('AW', lpad(CAST(c_custkey AS STRING), 8, '0')) AS cst_key",
    "split_part(c_name, '#', 1) AS cst_firstname",
    "concat(split_part(c_name, '#', 2), '-b') AS cst_lastname",
    "CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'M' END AS cst_marital_status",
    "'F' AS cst_gndr",
    "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_nationkey < 5 THEN '2021-06-30' ELSE '2001-01-01' END "
    "AS cst_create_date",
)

# customer-dimension rows with PII for masking
CUSTOMER_PII = (
    "c_custkey AS customer_id",
    "lpad(CAST(c_custkey AS STRING), 8, '0') AS customer_key",
    "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE split_part(c_name, '#', 1) END AS firstname",
    "split_part(c_name, '#', 2) AS lastname",
    "c_mktsegment AS marital_status",
    "c_nationkey AS country_code",
)

# order/fact rows with injected bad and NULL customer keys
ORDERS_BAD_KEYS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS o_custkey",
)
LINEITEM_BAD_KEYS = (
    "CASE WHEN l_orderkey % 13 = 0 THEN l_orderkey + 1000000000 WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey",
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "CAST(l_shipdate AS DATE) AS l_shipdate",
)
ORDERS_BAD_AND_NULL_KEYS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000 "
    "WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
)

# customers pointing at a nation that does not exist (lookup gaps)
CUSTOMER_NATION_GAPS = (
    "c_custkey",
    "c_name",
    "CASE WHEN c_custkey % 23 = 0 THEN 99 ELSE c_nationkey END AS c_nationkey",
)

# parts with a category id; parts named blue* point at a missing category
PART_WITH_CATEGORY = (
    "p_partkey",
    "p_name",
    "CASE WHEN p_name LIKE 'blue%' THEN 'ZZ' ELSE upper(substr(p_type, 1, 2)) END AS category_id",
)

# purchase events with some undated rows
PURCHASES = (
    "event_id",
    "user_id",
    "CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS event_date",
)

# parts as raw product rows: composite keys shared by several parts (versions),
# text costs and dates, blank/padded product lines, some bad ids and dates
PART_AS_PRODUCTS = (
    "CASE WHEN p_partkey % 97 = 0 THEN concat('x', CAST(p_partkey AS STRING)) "
    "ELSE CAST(p_partkey AS STRING) END AS prd_id",
    "CASE WHEN p_partkey % 31 = 0 THEN '' ELSE concat(' ', upper(substr(p_type, 1, 2)), '-', "
    "upper(substr(p_name, 1, 2)), '-', p_brand) END AS prd_key",
    "p_name AS prd_nm",
    "CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN 'n/a' "
    "ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) END AS prd_cost",
    "CASE p_size % 5 WHEN 0 THEN 'R ' WHEN 1 THEN ' M' WHEN 2 THEN '' ELSE 'S' END AS prd_line",
    "CASE WHEN p_partkey % 23 = 0 THEN 'soon' ELSE concat('20', lpad(CAST(10 + p_size % 5 AS STRING), 2, '0'), '-', "
    "lpad(CAST(1 + p_size % 12 AS STRING), 2, '0'), '-01') END AS prd_start_dt",
    "'2000-01-01' AS prd_end_dt",
)


def _yyyymmdd(col: str) -> str:
    return (f"concat(CAST(year({col}) AS STRING), lpad(CAST(month({col}) AS STRING), 2, '0'), "
            f"lpad(CAST(day({col}) AS STRING), 2, '0'))")


# line items joined with their orders as raw sales rows (yyyyMMdd text dates)
SALES_FROM_LINEITEM = (
    "concat('SO', CAST(l_orderkey AS STRING)) AS sls_ord_num",
    "CAST(l_partkey AS STRING) AS sls_prd_key",
    "CASE WHEN l_orderkey % 101 = 0 THEN concat('c', CAST(o_custkey AS STRING)) "
    "ELSE CAST(o_custkey AS STRING) END AS sls_cust_id",
    f"CASE WHEN l_linenumber = 7 THEN '0' ELSE {_yyyymmdd('o_orderdate')} END AS sls_order_dt",
    f"{_yyyymmdd('l_shipdate')} AS sls_ship_dt",
    f"CASE WHEN l_orderkey % 11 = 0 THEN '20991301' ELSE {_yyyymmdd('l_shipdate')} END AS sls_due_dt",
    "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS sls_sales",
    "CAST(CAST(l_quantity AS BIGINT) AS STRING) AS sls_quantity",
    "CASE WHEN l_linenumber = 3 THEN NULL "
    "ELSE CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS STRING) END AS sls_price",
)

# ---- raw retail sources for the whole pipeline (run_batch) -----------------
# ERP demographics keyed like the CRM customers, some future/bad birth dates
STAR_CUST_AZ12 = (
    "CASE c_custkey % 3 WHEN 0 THEN concat('NASAW', lpad(CAST(c_custkey AS STRING), 8, '0')) "
    "WHEN 1 THEN concat('AW-', lpad(CAST(c_custkey AS STRING), 8, '0')) "
    "ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END AS CID",
    "CASE WHEN c_custkey % 43 = 0 THEN '2999-01-01' WHEN c_custkey % 47 = 0 THEN '?' "
    "ELSE concat(CAST(1950 + c_custkey % 50 AS STRING), '-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', "
    "lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) END AS BDATE",
    "CASE c_nationkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' male ' WHEN 2 THEN 'FEMALE' ELSE NULL END AS GEN",
)

# ERP locations: country codes in several spellings, some blank
STAR_LOC_A101 = (
    "CASE WHEN c_custkey % 2 = 0 THEN concat('AW', lpad(CAST(c_custkey AS STRING), 8, '0')) "
    "ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END AS CID",
    "CASE c_nationkey WHEN 7 THEN 'DE' WHEN 24 THEN 'us' WHEN 23 THEN ' USA' WHEN 3 THEN '' "
    "ELSE concat('N', CAST(c_nationkey AS STRING)) END AS CNTRY",
)

# CRM products: one business key per brand, versions starting 1995..2001
STAR_PRD_INFO = (
    "CAST(p_partkey AS STRING) AS prd_id",
    "concat(upper(substr(p_type, 1, 2)), '-', upper(substr(p_name, 1, 2)), '-', p_brand) AS prd_key",
    "p_name AS prd_nm",
    "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) END AS prd_cost",
    "CASE p_size % 4 WHEN 0 THEN 'R ' WHEN 1 THEN 'M' WHEN 2 THEN '' ELSE 'T' END AS prd_line",
    "concat(CAST(1995 + p_size % 7 AS STRING), '-', lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0'), '-01') "
    "AS prd_start_dt",
    "CAST(NULL AS STRING) AS prd_end_dt",
)

# ERP categories, one row per type/name prefix (grouped from the parts)
STAR_PX_CAT_GROUP = "concat(upper(substr(p_type, 1, 2)), '_', upper(substr(p_name, 1, 2)))"
STAR_PX_CAT = (
    f"{STAR_PX_CAT_GROUP} AS ID",
    "max(p_type) AS CAT",
    "min(p_name) AS SUBCAT",
    "CASE WHEN count(*) > 40 THEN 'Yes' ELSE 'No' END AS MAINTENANCE",
)

# CRM sales: line items of orders, product key = the part's brand key
STAR_SALES = (
    "concat('SO', CAST(l_orderkey AS STRING)) AS sls_ord_num",
    "p_brand AS sls_prd_key",
    "CAST(o_custkey AS STRING) AS sls_cust_id",
    f"CASE WHEN l_linenumber = 7 THEN '0' ELSE {_yyyymmdd('o_orderdate')} END AS sls_order_dt",
    f"{_yyyymmdd('l_shipdate')} AS sls_ship_dt",
    f"{_yyyymmdd('l_shipdate')} AS sls_due_dt",
    "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS sls_sales",
    "CAST(CAST(l_quantity AS BIGINT) AS STRING) AS sls_quantity",
    "CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS STRING) AS sls_price",
)

# whole lineitem rows, two columns with NULLs; every 50th order's rows once more
LINEITEM_WITH_NULLS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity",
    "l_extendedprice", "l_discount", "l_tax",
    "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag",
    "l_linestatus", "l_shipdate",
)
LINEITEM_COPIED = "l_orderkey % 50 = 0"

# documents as text that a careless CSV export changes: padding, quotes, line breaks, '' and NULL
DOCUMENTS_MESSY = (
    "doc_id",
    "CASE WHEN doc_id % 6 = 0 THEN '' WHEN doc_id % 6 = 1 THEN NULL "
    "WHEN doc_id % 6 = 2 THEN concat('  ', text, ' \"q\"  ') "
    "WHEN doc_id % 6 = 3 THEN concat('\"', chr(13), chr(10), text, chr(10), chr(9)) "
    "WHEN doc_id % 6 = 4 THEN concat(text, ',', chr(92), '\"') ELSE text END AS text",
)

# purchases with a timestamp and with a zero-padded text key
PURCHASES_STAMPED = ("event_id", "user_id", "ts AS event_time")
PURCHASES_TEXT_KEY = (
    "event_id",
    "CASE WHEN event_id % 9 = 0 THEN concat('u', CAST(user_id AS STRING)) WHEN event_id % 9 = 1 THEN NULL "
    "ELSE concat('00', CAST(user_id AS STRING)) END AS user_key",
    "CAST(ts AS DATE) AS event_date",
)

# documents as CSV lines: a field missing, one too many, an unreadable number
DOCUMENT_LINE = (
    "concat(CASE WHEN doc_id % 29 = 0 THEN 'x' ELSE '' END, CAST(doc_id AS STRING), ',', lang, ',', hex(text), "
    "CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat(',', CAST(n_chars AS STRING)) END, "
    "CASE WHEN doc_id % 23 = 0 THEN ',more' ELSE '' END)"
)
