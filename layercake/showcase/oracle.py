"""DuckDB SQL oracles for the showcase queries (same keys as ``QUERIES``).

Each statement recomputes the operator's result with plain SQL over the
pre-registered views; only the injected input faults (``inputs``) are
shared with the Spark side.
"""

from __future__ import annotations

import json

from layercake.showcase import inputs as I


def _from(table: str, exprs, where: str | None = None) -> str:
    w = f" WHERE {where}" if where else ""
    return f"(SELECT {', '.join(exprs)} FROM {table}{w})"


ORDERS_NULLS = _from("orders", I.ORDERS_WITH_NULLS)
ORDERS_NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

ORDER_DATE_TEXT = (
    "(SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN '0' "
    "WHEN o_orderkey % 13 = 1 THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) "
    "WHEN o_orderkey % 13 = 2 THEN '20111301' ELSE strftime(o_orderdate, '%Y%m%d') END AS order_date_text FROM orders)"
)

SPLIT_PREFIX = "regexp_extract(trim(product_key), '^([A-Za-z0-9]{2}-[A-Za-z0-9]{2})-', 1)"

RAW_CUSTOMERS = (
    f"({_from('customer', I.CUSTOMER_RAW)[1:-1]} UNION ALL "
    f"{_from('customer', I.CUSTOMER_RAW_UPDATES)[1:-1]})"
)
CUSTOMER_RAW_COLS = ["cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr",
                     "cst_create_date"]


def _int_text(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({x}) AS INTEGER) END"


CLEAN_CUSTOMER = f"""(
WITH t AS (SELECT {', '.join(f"NULLIF(trim({c}), '') AS {c}" for c in CUSTOMER_RAW_COLS)} FROM {RAW_CUSTOMERS}),
r AS (SELECT cst_id, regexp_replace(cst_key, '(?i)^AW-?', '') AS cst_key, cst_firstname, cst_lastname,
             cst_marital_status, cst_gndr, cst_create_date FROM t),
m AS (SELECT cst_id, cst_key, cst_firstname, cst_lastname,
             CASE lower(trim(cst_marital_status)) WHEN 'm' THEN 'Married' WHEN 's' THEN 'Single'
                  WHEN 'married' THEN 'Married' WHEN 'single' THEN 'Single' ELSE cst_marital_status END
                  AS cst_marital_status,
             CASE lower(trim(cst_gndr)) WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female'
                  WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' ELSE cst_gndr END AS cst_gndr,
             TRY_CAST(cst_create_date AS DATE) AS cst_create_date FROM r),
c AS (SELECT {_int_text('cst_id')} AS cst_id, cst_key, cst_firstname, cst_lastname,
             coalesce(cst_marital_status, 'missing') AS cst_marital_status, coalesce(cst_gndr, 'missing') AS cst_gndr,
             cst_create_date FROM m),
d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC NULLS LAST,
             cst_key ASC NULLS LAST, cst_firstname ASC NULLS LAST, cst_lastname ASC NULLS LAST,
             cst_marital_status ASC NULLS LAST, cst_gndr ASC NULLS LAST) = 1)
SELECT cst_id AS customer_id, cst_key AS customer_key, cst_firstname AS firstname, cst_lastname AS lastname,
       cst_marital_status AS marital_status, cst_gndr AS gender, cst_create_date AS creation_date
FROM d WHERE cst_id IS NOT NULL AND cst_key IS NOT NULL)"""
CLEAN_CUSTOMER_COLS = ["customer_id", "customer_key", "firstname", "lastname", "marital_status", "gender",
                       "creation_date"]

_OTHER = [c for c in CUSTOMER_RAW_COLS if c != "cst_id"]
CLEAN_CUSTOMER_LEGACY = f"""(
WITH d AS (SELECT * FROM {RAW_CUSTOMERS} QUALIFY row_number() OVER (PARTITION BY cst_id ORDER BY
             {', '.join(f"{c} ASC NULLS LAST" for c in _OTHER)}) = 1),
k AS (SELECT cst_id, regexp_replace(trim(cst_key), '^AW', '') AS cst_key, cst_firstname, cst_lastname,
             cst_marital_status, cst_gndr, cst_create_date FROM d),
t AS (SELECT {', '.join(f"trim({c}) AS {c}" for c in CUSTOMER_RAW_COLS)} FROM k),
f AS (SELECT cst_id, cst_key, cst_firstname, cst_lastname,
             coalesce(cst_marital_status, 'missing') AS cst_marital_status, coalesce(cst_gndr, 'missing') AS cst_gndr,
             strftime(coalesce(TRY_CAST(cst_create_date AS DATE), DATE '2000-01-01'), '%d/%m/%Y') AS cst_create_date
      FROM t),
c AS (SELECT {_int_text('cst_id')} AS cst_id, {_int_text('cst_key')} AS cst_key, cst_firstname, cst_lastname,
             cst_marital_status, cst_gndr, cst_create_date FROM f)
SELECT cst_id AS id, cst_key AS key, cst_firstname AS firstname, cst_lastname AS lastname,
       cst_marital_status AS marital_status, cst_gndr, cst_create_date AS creation_date
FROM c WHERE cst_id IS NOT NULL AND cst_key IS NOT NULL)"""

PRD_COLS = ["prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]
_PFX = "regexp_extract(prd_key, '^([A-Za-z0-9]{2}-[A-Za-z0-9]{2})-', 1)"
def clean_products_sql(raw: str) -> str:
    return f"""(
WITH t AS (SELECT {', '.join(f"NULLIF(trim({c}), '') AS {c}" for c in PRD_COLS)} FROM {raw}),
s AS (SELECT prd_id, regexp_replace(trim(prd_key), '^[A-Za-z0-9]{{2}}-[A-Za-z0-9]{{2}}-', '') AS prd_key, prd_nm,
             prd_cost, prd_line, prd_start_dt, prd_end_dt,
             CASE WHEN length({_PFX.replace('prd_key', 'trim(prd_key)')}) > 0
                  THEN upper(replace({_PFX.replace('prd_key', 'trim(prd_key)')}, '-', '_')) END AS category_id FROM t),
d AS (SELECT {_int_text('prd_id')} AS prd_id, prd_key, prd_nm, {_int_text('prd_cost')} AS prd_cost, prd_line,
             TRY_CAST(prd_start_dt AS DATE) AS prd_start_dt, category_id FROM s),
e AS (SELECT *, lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt ASC NULLS LAST,
             prd_id ASC NULLS LAST) - 1 AS prd_end_dt FROM d)
SELECT prd_id AS product_id, prd_key AS product_key, prd_nm AS product_name, prd_cost AS cost,
       coalesce(prd_line, 'missing') AS product_line, prd_start_dt AS start_date, prd_end_dt AS end_date, category_id
FROM e WHERE prd_id IS NOT NULL AND prd_key IS NOT NULL)"""


CLEAN_PRODUCTS = clean_products_sql(_from("part", I.PART_AS_PRODUCTS))

SLS_COLS = ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales",
            "sls_quantity", "sls_price"]
def clean_sales_sql(raw_sql: str) -> str:
    return f"""(
WITH raw AS {raw_sql},
t AS (SELECT {', '.join(f"NULLIF(trim({c}), '') AS {c}" for c in SLS_COLS)} FROM raw),
d AS (SELECT sls_ord_num, sls_prd_key, {_int_text('sls_cust_id')} AS sls_cust_id,
             {', '.join(f"CAST(try_strptime({c}, '%Y%m%d') AS DATE) AS {c}" for c in ('sls_order_dt', 'sls_ship_dt', 'sls_due_dt'))},
             {', '.join(f"{_int_text(c)} AS {c}" for c in ('sls_sales', 'sls_quantity', 'sls_price'))} FROM t),
q AS (SELECT * FROM d WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY sls_ord_num, sls_prd_key ORDER BY
      {', '.join(f"{c} ASC NULLS LAST" for c in SLS_COLS[2:])}) = 1)
SELECT sls_ord_num AS order_number, sls_prd_key AS product_key, sls_cust_id AS customer_id,
       sls_order_dt AS order_date, sls_ship_dt AS ship_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
       sls_quantity AS quantity, sls_price AS price
FROM q WHERE sls_cust_id IS NOT NULL AND sls_sales IS NOT NULL AND sls_quantity IS NOT NULL)"""


CLEAN_SALES = clean_sales_sql(
    f"(SELECT {', '.join(I.SALES_FROM_LINEITEM)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)

SIGNUP_VERSIONS = """(WITH s AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS start_date FROM events
                   WHERE event_type = 'signup')
SELECT user_id, start_date, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) - 1 AS end_date FROM s)"""

ORDER_PERIODS = """(SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS end_date FROM orders)"""

_PURCHASE = "event_type = 'purchase'"
PURCHASES = _from("events", I.PURCHASES, _PURCHASE)

SALES = """(SELECT l.l_orderkey AS order_number, l.l_partkey AS product_key, o.o_custkey AS customer_id,
       CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date,
       CAST(l.l_shipdate AS DATE) + 30 AS due_date, l.l_extendedprice AS sales_amount, l.l_quantity AS quantity,
       l.l_extendedprice AS price, l.l_linenumber AS line_number, l.l_suppkey AS supplier_key,
       l.l_discount AS discount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
SALES_COLS = ["order_number", "product_key", "customer_id", "order_date", "ship_date", "due_date", "sales_amount",
              "quantity", "price", "line_number", "supplier_key", "discount"]
SALES_RULES = {
    "ship_before_order": "ship_date IS NOT NULL AND order_date IS NOT NULL AND ship_date < order_date",
    "non_positive_quantity": "quantity <= 0",
    "negative_price": "price < 0",
    "high_discount": "discount > 0.08",
}


def _pct(part: str, whole: str, digits: int, empty: str) -> str:
    return (f"CASE WHEN {whole} = 0 THEN {empty} "
            f"ELSE round(CAST(100.0 AS DOUBLE) * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE), {digits}) END")


def _null_counts(src: str, cols: list[str]) -> str:
    parts = ", ".join(f"count(*) - count({c}) AS n_{i}" for i, c in enumerate(cols))
    return f"(SELECT count(*) AS n, {parts} FROM {src})"


def null_profile_sql(src: str, cols: list[str], table: str, only_nulls: bool = False) -> str:
    m = _null_counts(src, cols)
    sels = []
    for i, c in enumerate(cols):
        if only_nulls:
            sels.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, n_{i} AS null_count, "
                        f"{_pct(f'n_{i}', 'n', 4, 'CAST(0.0 AS DOUBLE)')} AS null_percentage FROM m WHERE n_{i} > 0")
        else:
            sels.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {i + 1} AS ordinal_position, "
                        f"n AS row_count, n_{i} AS null_count, "
                        f"{_pct(f'n_{i}', 'n', 4, 'CAST(0.0 AS DOUBLE)')} AS null_percentage FROM m")
    return f"WITH m AS {m} " + " UNION ALL ".join(sels)


def _completeness_select(cols: list[str]) -> str:
    k = len(cols)
    total = " + ".join(f"n_{i}" for i in range(k))
    with_nulls = " + ".join(f"CASE WHEN n_{i} > 0 THEN 1 ELSE 0 END" for i in range(k))
    return (f"n AS row_count, CAST({k} AS BIGINT) AS column_count, CAST({total} AS BIGINT) AS total_null_values, "
            f"CAST({with_nulls} AS BIGINT) AS columns_with_nulls, "
            f"{_pct(f'n * {k} - ({total})', f'n * {k}', 4, 'CAST(100.0 AS DOUBLE)')} AS completeness_percentage")


def _details_json(cols: list[str], style: str) -> str:
    items = []
    for i, c in sorted(enumerate(cols), key=lambda t: t[1]):
        key = json.dumps(c) + ": "
        if style == "counts":
            val = f"CAST(n_{i} AS VARCHAR)"
        else:
            pct = _pct(f"n_{i}", "n", 4, "CAST(0.0 AS DOUBLE)")
            val = (f"'{{\"null_count\": ' || CAST(n_{i} AS VARCHAR) || ', \"null_percentage\": ' || "
                   f"CAST({pct} AS VARCHAR) || '}}'")
        items.append(f"CASE WHEN n_{i} > 0 THEN '{key}' || {val} END")
    return "'{' || concat_ws(', ', " + ", ".join(items) + ") || '}'"


def profile_row_sql(src: str, cols: list[str], table: str) -> str:
    return (f"SELECT '{table}' AS table_name, {_completeness_select(cols)}, "
            f"{_details_json(cols, 'counts')} AS null_details FROM {_null_counts(src, cols)}")


def _distinct_rows(src: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {src}))"


def _dup_keys(src: str, keys: list[str]) -> str:
    return (f"(SELECT CAST(count_if(k > 1) AS BIGINT) AS g, CAST(coalesce(sum(CASE WHEN k > 1 THEN k - 1 END), 0) AS BIGINT) AS r "
            f"FROM (SELECT count(*) AS k FROM {src} GROUP BY {', '.join(keys)}))")


def layer_row_sql(src_name: str, src: str, tgt_name: str, tgt: str, cols: list[str], keys: list[str]) -> str:
    dk = _dup_keys(tgt, keys)
    return (
        f"SELECT '{tgt_name}' AS table_name, '{src_name}' AS source_table, "
        f"(SELECT count(*) FROM {src}) AS source_row_count, n AS row_count, "
        f"(SELECT count(*) FROM {src}) - n AS rows_removed, "
        + _completeness_select(cols).split("n AS row_count, ", 1)[1]
        + f", n - {_distinct_rows(tgt)} AS exact_duplicate_rows, (SELECT g FROM {dk}) AS duplicate_key_groups, "
        f"(SELECT r FROM {dk}) AS duplicate_key_rows, '{json.dumps(keys)}' AS dedupe_keys, "
        f"{_details_json(cols, 'shares')} AS null_details FROM {_null_counts(tgt, cols)}"
    )


# --------------------------------------------------------- quality report
def _check(table, name, ctype, cols, total, failed, details="NULL") -> str:
    cc = f"'{json.dumps(cols)}'" if cols is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{ctype}' AS check_type, {cc} AS columns_checked, "
            f"CAST({total} AS BIGINT) AS total_rows, CAST({failed} AS BIGINT) AS failed_rows, "
            f"CAST({details} AS VARCHAR) AS details")


FLAGSHIP = {
    "customer": dict(
        src="customer", cols=["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        keys=[["c_custkey"], ["c_name"]], required=["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        rules={"negative_balance": "c_acctbal < 0"},
        refs=[("c_nationkey", "nation", "n_nationkey", "nation_referential_integrity")],
    ),
    "part": dict(
        src="part", cols=["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        keys=[["p_partkey"], ["p_name", "p_brand"]],
        required=["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        rules={"non_positive_price": "p_retailprice <= 0", "oversized": "p_size > 45"}, refs=[],
    ),
    "sales": dict(
        src=SALES, cols=SALES_COLS, keys=[["order_number", "line_number"]],
        required=["order_number", "product_key", "customer_id", "order_date", "ship_date", "quantity", "price"],
        rules=SALES_RULES,
        refs=[("product_key", "part", "p_partkey", "product_referential_integrity"),
              ("customer_id", "customer", "c_custkey", "customer_referential_integrity"),
              ("supplier_key", "supplier", "s_suppkey", "supplier_referential_integrity")],
    ),
}


def quality_checks_sql() -> str:
    parts = []
    for t, s in FLAGSHIP.items():
        src = s["src"]
        n = f"(SELECT count(*) FROM {src})"
        parts.append(_check(t, "table_exists", "existence", None, 1, 0,
                            f"'Table exists with ' || CAST({n} AS VARCHAR) || ' rows.'"))
        parts.append(_check(t, "table_not_empty", "row_count", None, f"greatest({n}, 1)",
                            f"CASE WHEN {n} = 0 THEN 1 ELSE 0 END", f"'Row count: ' || CAST({n} AS VARCHAR)"))
        parts.append(_check(t, "exact_duplicate_rows", "duplication", s["cols"], n, f"{n} - {_distinct_rows(src)}"))
        for c in s["required"]:
            parts.append(_check(t, f"required_not_null:{c}", "nullability", [c], n,
                                f"(SELECT count(*) - count({c}) FROM {src})"))
        for r, cond in s["rules"].items():
            parts.append(_check(t, r, "business_rule", None, n, f"(SELECT count_if({cond}) FROM {src})"))
        for keys in s["keys"]:
            parts.append(_check(t, "unique_key:" + ",".join(keys), "uniqueness", keys, n,
                                f"(SELECT r FROM {_dup_keys(src, keys)})"))
        for col, dim, dcol, name in s["refs"]:
            orphans = f"(SELECT count(*) FROM {src} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dcol} = f.{col}))"
            parts.append(_check(t, name, "referential_integrity", [col], n, orphans))
    parts.append(_check("supplier_dim", "table_exists", "existence", None, 1, 1, "'Table not found: supplier_dim'"))
    win = "PARTITION BY user_id ORDER BY start_date ASC NULLS LAST"
    overlaps = (f"(SELECT count(*) FROM (SELECT *, lag(start_date) OVER ({win}) AS ps, lag(end_date) OVER ({win}) AS pe "
                f"FROM {SIGNUP_VERSIONS}) WHERE ps IS NOT NULL AND (pe IS NULL OR start_date <= pe))")
    misses = (f"(SELECT count(*) FROM {PURCHASES} f WHERE f.event_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM "
              f"{SIGNUP_VERSIONS} v WHERE v.user_id = f.user_id AND v.start_date <= f.event_date AND "
              f"(v.end_date IS NULL OR f.event_date <= v.end_date)))")
    for t, src, cols, keys, required in (
        ("signups", SIGNUP_VERSIONS, ["user_id", "start_date", "end_date"], ["user_id", "start_date"],
         ["user_id", "start_date"]),
        ("purchases", PURCHASES, ["event_id", "user_id", "event_date"], ["event_id"],
         ["event_id", "user_id", "event_date"]),
    ):
        n = f"(SELECT count(*) FROM {src})"
        parts.append(_check(t, "table_exists", "existence", None, 1, 0,
                            f"'Table exists with ' || CAST({n} AS VARCHAR) || ' rows.'"))
        parts.append(_check(t, "table_not_empty", "row_count", None, f"greatest({n}, 1)",
                            f"CASE WHEN {n} = 0 THEN 1 ELSE 0 END", f"'Row count: ' || CAST({n} AS VARCHAR)"))
        parts.append(_check(t, "exact_duplicate_rows", "duplication", cols, n, f"{n} - {_distinct_rows(src)}"))
        for c in required:
            parts.append(_check(t, f"required_not_null:{c}", "nullability", [c], n,
                                f"(SELECT count(*) - count({c}) FROM {src})"))
        parts.append(_check(t, "unique_key:" + ",".join(keys), "uniqueness", keys, n,
                            f"(SELECT r FROM {_dup_keys(src, keys)})"))
    parts.append(_check("signups", "signup_validity_overlap", "temporal_integrity",
                        ["user_id", "start_date", "end_date"], f"(SELECT count(*) FROM {SIGNUP_VERSIONS})", overlaps))
    parts.append(_check("purchases", "active_signup_match", "temporal_integrity", ["user_id", "event_date"],
                        f"(SELECT count(event_date) FROM {PURCHASES})", misses))
    return " UNION ALL ".join(parts)


def quality_report_sql() -> str:
    return f"""SELECT table_name, check_name, check_type, columns_checked, total_rows, failed_rows,
  CASE WHEN total_rows = 0 THEN CASE WHEN failed_rows = 0 THEN 100.0 ELSE 0.0 END
       ELSE round(CAST(100.0 AS DOUBLE) * CAST(total_rows - failed_rows AS DOUBLE) / CAST(total_rows AS DOUBLE), 3)
  END AS pass_percentage,
  CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status, details
FROM ({quality_checks_sql()}) ORDER BY table_name, check_type, check_name"""


# ------------------------------------------------------------ inventories
TABLE_SCHEMAS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}


_NO_TEXT = "CAST(NULL AS VARCHAR)"


def table_inventory_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {_NO_TEXT} AS layer, {_NO_TEXT} AS domain, {_NO_TEXT} AS classification, {_NO_TEXT} AS table_type, "
        f"{_NO_TEXT} AS comment, count(*) AS row_count, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count FROM {t}"
        for t in TABLE_SCHEMAS
    )


#: Spark's names of the types that DuckDB reports (fixed values).
_TYPE_NAMES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT[]": "array<float>",
}


def _described(table: str, column: str) -> str:
    """Type (by Spark's name) and nullability of a column as DuckDB reads the file."""
    names = " ".join(f"WHEN '{d}' THEN '{n}'" for d, n in _TYPE_NAMES.items())
    return (f"(SELECT CASE column_type {names} ELSE column_type END FROM (DESCRIBE {table}) WHERE column_name = '{column}') AS data_type, "
            f"(SELECT \"null\" FROM (DESCRIBE {table}) WHERE column_name = '{column}') AS is_nullable")


def column_inventory_sql() -> str:
    sels = []
    for t, cols in TABLE_SCHEMAS.items():
        for i, (c, _) in enumerate(cols):
            sels.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i + 1} AS ordinal_position, {_described(t, c)}, "
                f"count(*) AS row_count, count(*) - count({c}) AS null_count FROM {t}"
            )
    return " UNION ALL ".join(sels)


#: Comment and classification of the customer dimension, and its types (fixed values).
_CUSTOMER_COLUMNS = (
    ("customer_id", "int", "Internal customer identifier", "internal_identifier"),
    ("customer_key", "string", "Business customer key", "internal_identifier"),
    ("firstname", "string", "Customer first name", "pii_name"),
    ("lastname", "string", "Customer last name", "pii_name"),
    ("marital_status", "string", "Customer marital status", "sensitive_demographic"),
    ("gender", "string", "Customer gender value from source system", "sensitive_demographic"),
    ("country", "string", "Customer country", "geographic"),
    ("birth_date", "date", "Customer date of birth", "pii_birth_date"),
    ("creation_date", "date", "Customer record creation date", "operational_metadata"),
)


def governed_tables_sql() -> str:
    return (
        "SELECT 'gold_dim_customers' AS table_name, 'gold' AS layer, 'customer' AS domain, 'confidential' AS classification, "
        f"'MANAGED' AS table_type, 'Customer dimension' AS comment, count(*) AS row_count, CAST(9 AS BIGINT) AS column_count FROM {DIM_CUSTOMERS} "
        f"UNION ALL SELECT 'governed_nation_view', 'governed', NULL, NULL, 'TEMPORARY', NULL, count(*), 3 FROM nation "
        "UNION ALL SELECT 'region', NULL, NULL, NULL, NULL, 'World regions', count(*), 2 FROM region"
    )


def governed_columns_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT 'gold_dim_customers' AS table_name, '{n}' AS column_name, {i + 1} AS ordinal_position, '{t}' AS data_type, '{comment}' AS comment, "
        f"'{label}' AS classification, count(*) AS row_count, count(*) - count({n}) AS null_count FROM {DIM_CUSTOMERS}"
        for i, (n, t, comment, label) in enumerate(_CUSTOMER_COLUMNS)
    )


SECRET_PATTERNS = {
    "platform_token": r"\bdapi[a-zA-Z0-9]{20,}\b",
    "cloud_access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "hex_token_assignment": r"token\s*=\s*\"[0-9a-f]{40}\"",
}


def _mask_source() -> str:
    exprs = list(I.CUSTOMER_PII) + [
        "CASE WHEN c_custkey % 29 = 0 THEN NULL "
        "ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) END AS birth_date"
    ]
    return _from("customer", exprs)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["trim_nullify"] = (f"SELECT o_orderkey, NULLIF(trim(o_orderpriority), '') AS o_orderpriority, "
                         f"NULLIF(trim(o_orderstatus), '') AS o_orderstatus FROM {_from('orders', I.ORDERS_PADDED)}")
    q["regex_rules"] = (f"SELECT c_custkey, regexp_replace(c_name, '(?i)^customer#0*', '') AS c_name, "
                        f"regexp_replace(customer_key, '(?i)^AW-?', '') AS customer_key "
                        f"FROM {_from('customer', I.CUSTOMER_KEYS)}")
    q["value_map"] = (f"SELECT o_orderkey, CASE lower(trim(o_orderstatus)) WHEN 'o' THEN 'Open' WHEN 'f' THEN 'Filled' "
                      f"ELSE o_orderstatus END AS o_orderstatus FROM {_from('orders', I.ORDERS_STATUS_VARIANTS)}")
    q["safe_cast"] = (f"SELECT p_partkey, brand_text, {_int_text('brand_text')} AS brand_number "
                      f"FROM {_from('part', I.PART_BRAND_TEXT)}")
    q["safe_date"] = (f"SELECT o_orderkey, order_date_text, CAST(try_strptime(order_date_text, '%Y%m%d') AS DATE) "
                      f"AS order_date FROM {ORDER_DATE_TEXT}")
    q["date_default_format"] = (
        f"SELECT o_orderkey, order_date_text, strftime(coalesce(CAST(try_strptime(order_date_text, '%Y%m%d') AS DATE), "
        f"DATE '2000-01-01'), '%d/%m/%Y') AS order_date FROM {ORDER_DATE_TEXT}")
    q["split_key"] = (
        f"SELECT p_partkey, regexp_replace(trim(product_key), '^[A-Za-z0-9]{{2}}-[A-Za-z0-9]{{2}}-', '') AS product_key, "
        f"CASE WHEN length({SPLIT_PREFIX}) > 0 THEN upper(replace({SPLIT_PREFIX}, '-', '_')) END AS category_id "
        f"FROM {_from('part', I.PART_COMPOSITE_KEY)}")
    q["null_future_dates"] = (f"SELECT o_orderkey, CASE WHEN o_orderdate > DATE '2000-01-01' THEN NULL "
                              f"ELSE o_orderdate END AS o_orderdate FROM {ORDERS_NULLS}")
    q["fill_nulls"] = (f"SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, 'missing') AS o_orderstatus, "
                       f"coalesce(o_totalprice, CAST(0.0 AS DOUBLE)) AS o_totalprice, o_orderdate, "
                       f"coalesce(o_orderpriority, 'missing') AS o_orderpriority FROM {ORDERS_NULLS}")
    q["require_not_null"] = (f"SELECT * FROM {ORDERS_NULLS} "
                             f"WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL")
    q["rename_strict"] = (f"SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus, o_totalprice, "
                          f"o_orderdate AS order_date, o_orderpriority FROM {ORDERS_NULLS}")
    q["clean_table"] = f"SELECT * FROM {CLEAN_CUSTOMER}"
    q["clean_table_legacy"] = f"SELECT * FROM {CLEAN_CUSTOMER_LEGACY}"
    q["clean_products"] = f"SELECT * FROM {CLEAN_PRODUCTS}"
    q["clean_sales"] = f"SELECT * FROM {CLEAN_SALES}"
    q["star_report"] = star_report_sql()
    q["star_customers_secure"] = (
        "SELECT customer_id, customer_key, CASE WHEN firstname IS NULL THEN NULL ELSE concat(substr(firstname, 1, 1), "
        "'***') END AS firstname, CASE WHEN lastname IS NULL THEN NULL ELSE concat(substr(lastname, 1, 1), '***') END "
        "AS lastname, marital_status, gender, country, CASE WHEN birth_date IS NULL THEN NULL ELSE "
        f"make_date(CAST(year(birth_date) AS INTEGER), 1, 1) END AS birth_date, creation_date FROM {DIM_CUSTOMERS}")
    q["dedupe_latest"] = (
        "SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS "
        "o_orderdate, o_orderpriority FROM orders) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY "
        "o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS LAST, o_orderstatus ASC NULLS LAST, "
        "o_totalprice ASC NULLS LAST, o_orderpriority ASC NULLS LAST) = 1")
    q["dedupe_any"] = (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM (SELECT * FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey ASC NULLS LAST, "
        "l_suppkey ASC NULLS LAST, l_quantity ASC NULLS LAST, l_extendedprice ASC NULLS LAST, "
        "l_discount ASC NULLS LAST, l_tax ASC NULLS LAST, l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS LAST, "
        "l_shipdate ASC NULLS LAST) = 1)")
    q["derive_end_date"] = f"SELECT * FROM {SIGNUP_VERSIONS}"
    win = "PARTITION BY o_custkey ORDER BY start_date ASC NULLS LAST, o_orderkey ASC NULLS LAST"
    q["overlapping_versions"] = (
        f"SELECT o_custkey, o_orderkey, start_date, end_date FROM (SELECT *, lag(start_date) OVER ({win}) AS ps, "
        f"lag(end_date) OVER ({win}) AS pe FROM {ORDER_PERIODS}) WHERE ps IS NOT NULL AND "
        f"(pe IS NULL OR start_date <= pe)")
    frame = f"{win} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    q["overlapping_versions_any"] = (
        f"SELECT o_custkey, o_orderkey, start_date, end_date FROM (SELECT *, max(CASE WHEN start_date IS NOT NULL AND "
        f"end_date IS NULL THEN 1 ELSE 0 END) OVER ({frame}) AS ob, max(CASE WHEN start_date IS NOT NULL THEN end_date "
        f"END) OVER ({frame}) AS me FROM {ORDER_PERIODS}) WHERE ob = 1 OR start_date <= me")
    miss = ("SELECT f.event_id, f.user_id, f.event_date FROM {f} f WHERE f.event_date IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM {v} v WHERE v.user_id = f.user_id AND v.start_date <= f.event_date AND "
            "(v.end_date IS NULL OR f.event_date <= v.end_date))")
    q["version_misses"] = miss.format(f=PURCHASES, v=SIGNUP_VERSIONS)
    q["version_misses_asof"] = q["version_misses"]
    closed = ("(SELECT user_id, CAST(ts AS DATE) AS start_date, CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) "
              "AS end_date FROM events WHERE event_type = 'signup')")
    q["version_misses_timestamps"] = (
        f"SELECT f.event_id, f.user_id, f.event_time FROM {_from('events', I.PURCHASES_STAMPED, _PURCHASE)} f "
        "WHERE NOT EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'signup' AND v.user_id = f.user_id AND v.ts <= f.event_time "
        "AND (v.event_id % 3 = 0 OR f.event_time <= v.ts + INTERVAL 36 HOUR))")
    q["version_misses_mixed_keys"] = (
        f"SELECT f.event_id, f.user_key, f.event_date FROM {_from('events', I.PURCHASES_TEXT_KEY, _PURCHASE)} f WHERE NOT EXISTS "
        f"(SELECT 1 FROM {SIGNUP_VERSIONS} v WHERE v.user_id = TRY_CAST(f.user_key AS BIGINT) AND v.start_date <= f.event_date "
        "AND (v.end_date IS NULL OR f.event_date <= v.end_date))")
    q["version_misses_closed"] = miss.format(f=PURCHASES, v=closed)
    orphan = ("SELECT o_orderkey, o_custkey FROM {f} f WHERE {extra}NOT EXISTS "
              "(SELECT 1 FROM customer c WHERE c.c_custkey = f.o_custkey)")
    q["orphan_rows"] = orphan.format(f=_from("orders", I.ORDERS_BAD_KEYS), extra="")
    q["orphan_rows_nulls"] = orphan.format(f=_from("orders", I.ORDERS_BAD_AND_NULL_KEYS), extra="")
    q["orphan_rows_ignore_nulls"] = orphan.format(f=_from("orders", I.ORDERS_BAD_AND_NULL_KEYS),
                                                  extra="f.o_custkey IS NOT NULL AND ")
    q["dim_customer"] = (
        f"SELECT b.c_custkey, b.c_name, b.c_nationkey, n.n_name AS nation_name, r.r_name AS region_name "
        f"FROM {_from('customer', I.CUSTOMER_NATION_GAPS)} b LEFT JOIN nation n ON b.c_nationkey = n.n_nationkey "
        f"LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
    q["dim_part"] = (
        f"WITH cat AS (SELECT upper(substr(p_type, 1, 2)) AS category_id, max(p_type) AS category, "
        f"count(*) AS parts_in_category FROM part GROUP BY 1) "
        f"SELECT b.p_partkey, b.p_name, b.category_id, cat.category, cat.parts_in_category "
        f"FROM {_from('part', I.PART_WITH_CATEGORY)} b LEFT JOIN cat ON b.category_id = cat.category_id")
    q["fact_sales"] = ("SELECT order_number, product_key, customer_id, order_date, ship_date, due_date, sales_amount, "
                       f"quantity, price FROM {SALES}")
    q["null_profile"] = null_profile_sql(ORDERS_NULLS, ORDERS_NULL_COLS, "orders")
    q["completeness"] = (f"SELECT 'orders' AS table_name, {_completeness_select(ORDERS_NULL_COLS)} "
                         f"FROM {_null_counts(ORDERS_NULLS, ORDERS_NULL_COLS)}")
    q["null_details"] = null_profile_sql(ORDERS_NULLS, ORDERS_NULL_COLS, "orders", only_nulls=True)
    copies = (f"(SELECT * FROM {_from('lineitem', I.LINEITEM_WITH_NULLS)} UNION ALL SELECT * FROM "
              f"{_from('lineitem', I.LINEITEM_WITH_NULLS, I.LINEITEM_COPIED)})")
    for name, src in (("exact_duplicates", copies), ("exact_duplicates_fingerprint", "(SELECT l_orderkey, l_linenumber FROM lineitem)")):
        q[name] = (f"SELECT 'lineitem' AS table_name, count(*) AS total_rows, {_distinct_rows(src)} AS distinct_rows, "
                   f"count(*) - {_distinct_rows(src)} AS exact_duplicate_rows FROM {src}")
    dk = _dup_keys("lineitem", ["l_orderkey", "l_linenumber"])
    q["key_duplicates"] = (f"SELECT 'lineitem' AS table_name, '[\"l_orderkey\", \"l_linenumber\"]' AS keys, "
                           f"(SELECT count(*) FROM lineitem) AS total_rows, g AS duplicate_key_groups, "
                           f"r AS duplicate_key_rows FROM {dk}")
    q["rule_violations"] = " UNION ALL ".join(
        f"SELECT 'sales' AS table_name, '{r}' AS rule_name, count(*) AS total_rows, "
        f"CAST(count_if({cond}) AS BIGINT) AS failed_rows "
        f"FROM {SALES}" for r, cond in SALES_RULES.items())
    q["reconcile"] = (f"SELECT 'orders' AS table_name, (SELECT count(*) FROM {ORDERS_NULLS}) AS source_row_count, "
                      f"count(*) AS row_count, (SELECT count(*) FROM {ORDERS_NULLS}) - count(*) AS rows_removed "
                      f"FROM {ORDERS_NULLS} WHERE o_orderpriority IS NOT NULL")
    q["quality_report"] = quality_report_sql()
    q["report_summary"] = (f"SELECT count(*) AS checks, CAST(count_if(status = 'FAIL') AS BIGINT) AS failures, "
                           f"CAST(count_if(status = 'WARN') AS BIGINT) AS warnings, "
                           f"CAST(count_if(status = 'PASS') AS BIGINT) AS passes "
                           f"FROM ({quality_report_sql()})")
    q["profile_report"] = " UNION ALL ".join([
        profile_row_sql(RAW_CUSTOMERS, CUSTOMER_RAW_COLS, "raw_customers"),
        profile_row_sql("nation", ["n_nationkey", "n_name", "n_regionkey"], "raw_nation"),
        profile_row_sql(ORDERS_NULLS, ORDERS_NULL_COLS, "raw_orders"),
    ])
    clean_orders = (f"(SELECT * FROM (SELECT * FROM {ORDERS_NULLS} QUALIFY row_number() OVER (PARTITION BY o_custkey "
                    f"ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS LAST, o_orderstatus ASC NULLS LAST, "
                    f"o_totalprice ASC NULLS LAST, o_orderpriority ASC NULLS LAST) = 1) "
                    f"WHERE o_orderpriority IS NOT NULL)")
    q["layer_report"] = " UNION ALL ".join([
        layer_row_sql("raw_orders", ORDERS_NULLS, "clean_orders", clean_orders, ORDERS_NULL_COLS, ["o_custkey"]),
        layer_row_sql("raw_customers", RAW_CUSTOMERS, "clean_customer", CLEAN_CUSTOMER, CLEAN_CUSTOMER_COLS,
                      ["customer_id"]),
    ])
    q["mask_columns"] = (
        f"SELECT customer_id, customer_key, CASE WHEN firstname IS NULL THEN NULL ELSE "
        f"concat(substr(firstname, 1, 1), '***') END AS firstname, CASE WHEN lastname IS NULL THEN NULL ELSE "
        f"concat(substr(lastname, 1, 1), '***') END AS lastname, marital_status, country_code, "
        f"CASE WHEN birth_date IS NULL THEN NULL ELSE make_date(CAST(year(birth_date) AS INTEGER), 1, 1) END "
        f"AS birth_date FROM {_mask_source()}")
    q["mask_columns_owner"] = f"SELECT * FROM {_mask_source()}"
    q["assign_batches"] = (
        "SELECT o_orderkey, o_orderdate, rn AS row_number, CASE WHEN rn <= 6000 THEN 1 WHEN rn <= 12000 THEN 2 "
        "ELSE 3 END AS batch_id FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, "
        "row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders)")
    q["table_inventory"] = table_inventory_sql()
    q["column_inventory"] = column_inventory_sql()
    q["governed_tables"] = governed_tables_sql()
    q["governed_columns"] = governed_columns_sql()
    q["scan_patterns"] = " UNION ALL ".join(
        f"SELECT '{k}' AS pattern_name, '{p}' AS pattern, count(*) AS rows_scanned, "
        f"CAST(count_if(regexp_matches(text, '{p}')) AS BIGINT) AS matching_rows FROM documents" for k, p in SECRET_PATTERNS.items())
    q["scan_pattern_hits"] = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS pattern_name FROM documents WHERE regexp_matches(text, '{p}')"
        for k, p in SECRET_PATTERNS.items())
    q["raw_csv_roundtrip"] = ("SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, "
                              "c_mktsegment AS segment FROM customer")
    q["release_batches"] = (
        f"SELECT doc_id, text, CAST(CASE WHEN n <= 60 THEN 1 WHEN n <= 150 THEN 2 ELSE 3 END AS INTEGER) AS batch_id "
        f"FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM {_from('documents', I.DOCUMENTS_MESSY)})")
    q["ingest_inferred"] = "SELECT event_id, user_id, event_type, value, (SELECT count(*) FROM events) AS rows_ingested FROM events"
    q["catalog_roundtrip"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(cols)} AS BIGINT) AS column_count, "
        f"CAST({' + '.join(f'count_if({x} IS NULL)' for x in cols)} AS BIGINT) AS total_null_values FROM {src}"
        for t, src, cols in (
            ("raw_customer", "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
            ("raw_orders", "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
            ("raw_orders_nulls", ORDERS_NULLS, ORDERS_NULL_COLS),
        )
    ) + " UNION ALL SELECT 'raw_absent', NULL, NULL, NULL"
    q["ingest_sources"] = (
        "SELECT 'raw_customer' AS table_name, (SELECT count(*) FROM customer) AS row_count, "
        "(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE customer)) AS column_count, 2 AS errors UNION ALL SELECT 'raw_part', "
        "(SELECT count(*) FROM part), (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE part)), 2")
    q["masked_view"] = q["star_customers_secure"]
    q["star_increment"] = q["star_report"]
    q["intake_streams"] = " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) * {int(t != 'supplier')} AS first_rows, {'true' if t == 'supplier' else 'false'} AS first_rows_failed, "
        f"0::BIGINT AS again_rows, {'true' if t == 'supplier' else 'false'} AS again_rows_failed FROM {t}"
        for t in ("customer", "part", "orders", "lineitem", "supplier", "nation")
    )
    # a line with a field too few and one too many has the right number again, but no number at its end
    bad = "(doc_id % 17 = 0 OR doc_id % 23 = 0 OR doc_id % 29 = 0)"
    q["checked_intake"] = f"""
        SELECT CASE WHEN NOT {bad} THEN doc_id END AS doc_id, CASE WHEN NOT {bad} THEN lang END AS lang, CASE WHEN NOT {bad} THEN text END AS text,
               CASE WHEN NOT {bad} THEN n_chars END AS n_chars, CASE WHEN {bad} THEN {I.DOCUMENT_LINE} END AS line,
               count(*) OVER () AS rows_read, count(*) FILTER ({bad}) OVER () AS rows_rejected
        FROM documents"""
    q["orphan_rows_filtered"] = (f"SELECT * FROM {_from('lineitem', I.LINEITEM_BAD_KEYS)} f WHERE NOT EXISTS "
                                 "(SELECT 1 FROM orders o WHERE o.o_orderkey = f.l_orderkey)")
    q["report_state"] = " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, {_completeness_select(ORDERS_NULL_COLS)}, g AS duplicate_key_groups, r AS duplicate_key_rows, "
        f"'[\"o_custkey\"]' AS dedupe_keys, {_details_json(ORDERS_NULL_COLS, 'counts')} AS null_details, {i + 1} AS increment "
        f"FROM {_null_counts(part, ORDERS_NULL_COLS)}, {_dup_keys(part, ['o_custkey'])}"
        for i in range(3) for part in [f"(SELECT * FROM {ORDERS_NULLS} WHERE o_orderkey % 3 <= {i})"])
    padded = _from("orders", I.ORDERS_PADDED)
    q["publish_atomic"] = f"""
        SELECT o_orderkey, o_orderpriority, o_orderstatus, 1 AS step FROM {padded}
        UNION ALL SELECT o_orderkey, NULLIF(trim(o_orderpriority), ''), NULLIF(trim(o_orderstatus), ''), 2 FROM {padded}"""
    q["release_concurrent"] = """
        SELECT batch_id, 1::BIGINT AS times_taken, count(*) AS rows_landed, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
        FROM (SELECT o_orderkey, CAST(1 + least(4, (row_number() OVER (ORDER BY o_orderkey) - 1) // 2000) AS INTEGER) AS batch_id FROM orders) GROUP BY batch_id"""
    q["assign_batches_file_order"] = """
        SELECT o_orderkey, row_number, CASE WHEN row_number <= 6000 THEN 1 WHEN row_number <= 12000 THEN 2 ELSE 3 END AS batch_id
        FROM (SELECT o_orderkey, row_number() OVER () AS row_number FROM orders)"""
    q["read_by_header"] = """
        SELECT c_custkey, c_name, CAST(CASE WHEN c_custkey % 3 <> 1 THEN c_nationkey END AS BIGINT) AS c_nationkey,
               CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS c_mktsegment FROM customer"""
    q["raw_csv_inferred"] = "SELECT * EXCLUDE (l_shipdate), 'int,int,int,int,double,double,double,double,string,string' AS inferred_types FROM lineitem"
    q["column_contracts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, '{t} missing: [''{t}_note'', ''checked_at'']' AS message FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
                  "pages", "benchmark", "labels", "conversations")
    )
    q["ingest_increment"] = ("SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date, props, "
                             "(SELECT count(*) FROM events) AS rows_ingested FROM events")
    return q


# ------------------------------------------------ whole retail pipeline (C4)
STAR_AS_OF = "DATE '2025-01-01'"
_ERP = "'(?i)^(NAS)?AW-?'"


def _gender_map(col: str) -> str:
    return (f"CASE lower(trim({col})) WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female' WHEN 'male' THEN 'Male' "
            f"WHEN 'female' THEN 'Female' ELSE {col} END")


STAR_DEMOGRAPHICS = f"""(
WITH t AS (SELECT NULLIF(trim(CID), '') AS CID, NULLIF(trim(BDATE), '') AS BDATE, NULLIF(trim(GEN), '') AS GEN
           FROM {_from('customer', I.STAR_CUST_AZ12)}),
d AS (SELECT regexp_replace(CID, {_ERP}, '') AS CID, TRY_CAST(BDATE AS DATE) AS BDATE, {_gender_map('GEN')} AS GEN FROM t),
p AS (SELECT CID, CASE WHEN BDATE > {STAR_AS_OF} THEN NULL ELSE BDATE END AS BDATE, coalesce(GEN, 'missing') AS GEN FROM d),
q AS (SELECT * FROM p WHERE CID IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY CID ORDER BY BDATE ASC NULLS LAST, GEN ASC NULLS LAST) = 1)
SELECT CID AS customer_key, BDATE AS birth_date, GEN AS gender FROM q)"""

STAR_LOCATION = f"""(
WITH t AS (SELECT NULLIF(trim(CID), '') AS CID, NULLIF(trim(CNTRY), '') AS CNTRY FROM {_from('customer', I.STAR_LOC_A101)}),
m AS (SELECT regexp_replace(CID, {_ERP}, '') AS CID,
             coalesce(CASE lower(trim(CNTRY)) WHEN 'de' THEN 'Germany' WHEN 'us' THEN 'United States'
                      WHEN 'usa' THEN 'United States' ELSE CNTRY END, 'missing') AS CNTRY FROM t),
q AS (SELECT * FROM m WHERE CID IS NOT NULL QUALIFY row_number() OVER (PARTITION BY CID ORDER BY CNTRY ASC NULLS LAST) = 1)
SELECT CID AS customer_key, CNTRY AS country FROM q)"""

STAR_CATEGORIES = f"""(
WITH g AS (SELECT {', '.join(I.STAR_PX_CAT)} FROM part GROUP BY {I.STAR_PX_CAT_GROUP}),
t AS (SELECT NULLIF(trim(ID), '') AS ID, NULLIF(trim(CAT), '') AS CAT, NULLIF(trim(SUBCAT), '') AS SUBCAT,
             NULLIF(trim(MAINTENANCE), '') AS MAINTENANCE FROM g),
q AS (SELECT * FROM t WHERE ID IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ID ORDER BY CAT ASC NULLS LAST,
      SUBCAT ASC NULLS LAST, MAINTENANCE ASC NULLS LAST) = 1)
SELECT ID AS category_id, CAT AS category, SUBCAT AS subcategory, MAINTENANCE AS maintenance FROM q)"""

STAR_PRODUCTS = clean_products_sql(_from("part", I.STAR_PRD_INFO))
STAR_SALES = clean_sales_sql(
    f"(SELECT {', '.join(I.STAR_SALES)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    f"JOIN part ON l_partkey = p_partkey)"
)

DIM_CUSTOMERS = f"""(SELECT i.customer_id, i.customer_key, i.firstname, i.lastname, i.marital_status, i.gender,
       l.country, d.birth_date, i.creation_date
FROM {CLEAN_CUSTOMER} i LEFT JOIN {STAR_LOCATION} l ON i.customer_key = l.customer_key
LEFT JOIN {STAR_DEMOGRAPHICS} d ON i.customer_key = d.customer_key)"""
DIM_CUSTOMER_COLS = ["customer_id", "customer_key", "firstname", "lastname", "marital_status", "gender", "country",
                     "birth_date", "creation_date"]

DIM_PRODUCT = f"""(SELECT p.product_id, p.product_key, p.product_name, p.cost, p.product_line, p.start_date,
       p.end_date, p.category_id, c.category, c.subcategory, c.maintenance
FROM {STAR_PRODUCTS} p LEFT JOIN {STAR_CATEGORIES} c ON p.category_id = c.category_id)"""
DIM_PRODUCT_COLS = ["product_id", "product_key", "product_name", "cost", "product_line", "start_date", "end_date",
                    "category_id", "category", "subcategory", "maintenance"]

FACT_COLS = ["order_number", "product_key", "customer_id", "order_date", "ship_date", "due_date", "sales_amount",
             "quantity", "price"]
FACT = f"(SELECT {', '.join(FACT_COLS)} FROM {STAR_SALES})"


def _suite_sql(t, src, cols, key_sets, required, rules):
    n = f"(SELECT count(*) FROM {src})"
    parts = [
        _check(t, "table_exists", "existence", None, 1, 0, f"'Table exists with ' || CAST({n} AS VARCHAR) || ' rows.'"),
        _check(t, "table_not_empty", "row_count", None, f"greatest({n}, 1)", f"CASE WHEN {n} = 0 THEN 1 ELSE 0 END",
               f"'Row count: ' || CAST({n} AS VARCHAR)"),
        _check(t, "exact_duplicate_rows", "duplication", cols, n, f"{n} - {_distinct_rows(src)}"),
    ]
    parts += [_check(t, f"required_not_null:{c}", "nullability", [c], n, f"(SELECT count(*) - count({c}) FROM {src})")
              for c in required]
    parts += [_check(t, r, "business_rule", None, n, f"(SELECT count_if({cond}) FROM {src})") for r, cond in rules.items()]
    parts += [_check(t, "unique_key:" + ",".join(k), "uniqueness", k, n, f"(SELECT r FROM {_dup_keys(src, k)})")
              for k in key_sets]
    return parts


def star_report_sql() -> str:
    parts = _suite_sql("gold_dim_customers", "dc", DIM_CUSTOMER_COLS, [["customer_id"], ["customer_key"]],
                       DIM_CUSTOMER_COLS, {"future_birth_date": f"birth_date > {STAR_AS_OF}"})
    parts += _suite_sql("gold_dim_product", "dp", DIM_PRODUCT_COLS, [["product_id"], ["product_key", "start_date"]],
                        [c for c in DIM_PRODUCT_COLS if c != "end_date"],
                        {"negative_cost": "cost < 0",
                         "invalid_date_range": "end_date IS NOT NULL AND end_date < start_date"})
    parts += _suite_sql("gold_fact_sales", "fs", FACT_COLS, [["order_number", "product_key"]], FACT_COLS,
                        {"negative_sales_amount": "sales_amount < 0", "non_positive_quantity": "quantity <= 0",
                         "negative_price": "price < 0",
                         "ship_before_order": "ship_date IS NOT NULL AND order_date IS NOT NULL AND ship_date < order_date",
                         "due_before_order": "due_date IS NOT NULL AND order_date IS NOT NULL AND due_date < order_date"})
    n_fact = "(SELECT count(*) FROM fs)"
    parts.append(_check("gold_fact_sales", "customer_referential_integrity", "referential_integrity", ["customer_id"],
                        n_fact, "(SELECT count(*) FROM fs f WHERE NOT EXISTS (SELECT 1 FROM dc d "
                                "WHERE d.customer_id = f.customer_id))"))
    parts.append(_check("gold_fact_sales", "product_referential_integrity", "referential_integrity", ["product_key"],
                        n_fact, "(SELECT count(*) FROM fs f WHERE NOT EXISTS (SELECT 1 FROM dp d "
                                "WHERE d.product_key = f.product_key))"))
    parts.append(_check("gold_fact_sales", "historical_product_version_match", "temporal_integrity",
                        ["product_key", "order_date"], "(SELECT count(order_date) FROM fs)",
                        "(SELECT count(*) FROM fs f WHERE f.order_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dp p "
                        "WHERE p.product_key = f.product_key AND p.start_date <= f.order_date AND "
                        "(p.end_date IS NULL OR f.order_date <= p.end_date)))"))
    win = "PARTITION BY product_key ORDER BY start_date ASC NULLS LAST, product_id ASC NULLS LAST"
    parts.append(_check("gold_dim_product", "product_validity_overlap", "temporal_integrity",
                        ["product_key", "start_date", "end_date"], "(SELECT count(*) FROM dp)",
                        f"(SELECT count(*) FROM (SELECT *, lag(start_date) OVER ({win}) AS ps, lag(end_date) OVER ({win}) "
                        f"AS pe FROM dp) WHERE ps IS NOT NULL AND (pe IS NULL OR start_date <= pe))"))
    return f"""WITH dc AS {DIM_CUSTOMERS}, dp AS {DIM_PRODUCT}, fs AS {FACT}
SELECT table_name, check_name, check_type, columns_checked, total_rows, failed_rows,
  CASE WHEN total_rows = 0 THEN CASE WHEN failed_rows = 0 THEN 100.0 ELSE 0.0 END
       ELSE round(CAST(100.0 AS DOUBLE) * CAST(total_rows - failed_rows AS DOUBLE) / CAST(total_rows AS DOUBLE), 3)
  END AS pass_percentage,
  CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status, details
FROM ({' UNION ALL '.join(parts)})"""
