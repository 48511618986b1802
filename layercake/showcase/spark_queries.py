"""Library operators applied to the driver tables: one callable per operator
key, each ``(spark, sf_dir) -> DataFrame`` over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.functions import columns as fx
from layercake.operators import (
    assign_batches,
    classify_columns,
    column_inventory,
    completeness,
    dedupe,
    derive_end_date,
    exact_duplicates,
    fill_nulls,
    key_duplicates,
    mask_columns,
    null_profile,
    orphan_rows,
    orphan_rows_filtered,
    overlapping_versions,
    pattern_hits,
    reconcile,
    regex_rules,
    rename_strict,
    require_not_null,
    rule_violations,
    safe_cast,
    safe_date,
    scan_patterns,
    split_key,
    table_inventory,
    trim_nullify,
    value_map,
    version_misses,
)
from layercake.operators.governance import CUSTOMER_COLUMN_METADATA
from layercake.operators.rules import date_default_format, null_future_dates
from layercake.plans.catalog import SPECS
from layercake.plans.legacy import LEGACY_SPECS, clean_legacy
from layercake.plans.checks import Overlap, Reference, Suite, VersionMatch, quality_report, report_summary
from layercake.plans.reports import LayerPair, layer_report, profile_report
from layercake.plans.spec import TableSpec, clean
from layercake.plans.star import Lookup, build_dimension, build_fact
from layercake.session import materialize
from layercake.showcase import inputs as I

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
AS_OF = dt.date(2000, 1, 1)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _t(name: str, *exprs: str) -> Callable[[SparkSession, str], DataFrame]:
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load(spark, sf_dir, name).selectExpr(*exprs)

    return get


orders_with_nulls = _t("orders", *I.ORDERS_WITH_NULLS)
orders_padded = _t("orders", *I.ORDERS_PADDED)


# ---------------------------------------------------------------- rules (P)
def q_trim_nullify(spark, sf):
    return trim_nullify(orders_padded(spark, sf))


def q_regex_rules(spark, sf):
    df = _t("customer", *I.CUSTOMER_KEYS)(spark, sf)
    return regex_rules(df, {"c_name": [(r"(?i)^customer#0*", "")], "customer_key": [(fx.CRM_CUSTOMER_KEY_PREFIX, "")]})


def q_value_map(spark, sf):
    df = _t("orders", *I.ORDERS_STATUS_VARIANTS)(spark, sf)
    return value_map(df, {"o_orderstatus": {"O": "Open", "F": "Fulfilled", "f": "Filled"}})


def q_safe_cast(spark, sf):
    df = _t("part", *I.PART_BRAND_TEXT)(spark, sf)
    return safe_cast(df.withColumn("brand_number", F.col("brand_text")), {"brand_number": "int"})


def _order_date_text(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.expr(
            "CASE WHEN o_orderkey % 13 = 0 THEN '0' WHEN o_orderkey % 13 = 1 THEN substr(date_format(o_orderdate, 'yyyyMMdd'), 1, 6) "
            "WHEN o_orderkey % 13 = 2 THEN '20111301' ELSE date_format(o_orderdate, 'yyyyMMdd') END"
        ).alias("order_date_text"),
    )


def q_safe_date(spark, sf):
    df = _order_date_text(spark, sf)
    return safe_date(df.withColumn("order_date", F.col("order_date_text")), {"order_date": "yyyyMMdd"})


def q_date_default_format(spark, sf):
    df = _order_date_text(spark, sf)
    return date_default_format(df.withColumn("order_date", F.col("order_date_text")), ["order_date"], fmt="yyyyMMdd")


def q_split_key(spark, sf):
    return split_key(_t("part", *I.PART_COMPOSITE_KEY)(spark, sf), "product_key", "category_id")


def q_null_future_dates(spark, sf):
    df = orders_with_nulls(spark, sf).select("o_orderkey", "o_orderdate")
    return null_future_dates(df, ["o_orderdate"], as_of=AS_OF)


def q_fill_nulls(spark, sf):
    fill = {"o_orderpriority": "missing", "o_orderstatus": "missing", "o_totalprice": 0.0, "o_custkey": "none",
            "not_a_column": "x"}
    return fill_nulls(orders_with_nulls(spark, sf), fill)


def q_require_not_null(spark, sf):
    return require_not_null(orders_with_nulls(spark, sf), ["o_orderpriority", "o_orderstatus"])


def q_rename_strict(spark, sf):
    return rename_strict(orders_with_nulls(spark, sf), {"o_orderkey": "order_key", "o_custkey": "customer_id",
                                                        "o_orderdate": "order_date"})


# ------------------------------------------------------------- clean
CUSTOMER_SPEC = TableSpec(
    target="clean_customer",
    keys=("cst_id",),
    order_by=(("cst_create_date", "desc"),),
    regex={"cst_key": ((fx.CRM_CUSTOMER_KEY_PREFIX, ""),)},
    value_maps={
        "cst_gndr": {"M": "Male", "F": "Female", "Male": "Male", "Female": "Female"},
        "cst_marital_status": {"M": "Married", "S": "Single", "Married": "Married", "Single": "Single"},
    },
    dates={"cst_create_date": None},
    casts={"cst_id": "int"},
    fill={"cst_gndr": "missing", "cst_marital_status": "missing"},
    required=("cst_id", "cst_key"),
    rename={"cst_id": "customer_id", "cst_key": "customer_key", "cst_firstname": "firstname",
            "cst_lastname": "lastname", "cst_marital_status": "marital_status", "cst_gndr": "gender",
            "cst_create_date": "creation_date"},
)


def raw_customers(spark, sf):
    cust = load(spark, sf, "customer")
    base = cust.selectExpr(*I.CUSTOMER_RAW)
    updates = cust.selectExpr(*I.CUSTOMER_RAW_UPDATES)
    return base.unionByName(updates)


def q_clean_table(spark, sf):
    return clean(raw_customers(spark, sf), CUSTOMER_SPEC)


def q_clean_products(spark, sf):
    return clean(_t("part", *I.PART_AS_PRODUCTS)(spark, sf), SPECS["prd_info"])


def q_clean_sales(spark, sf):
    li = load(spark, sf, "lineitem")
    od = load(spark, sf, "orders")
    raw = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner").selectExpr(*I.SALES_FROM_LINEITEM)
    return clean(raw, SPECS["sales_details"])


STAR_AS_OF = dt.date(2025, 1, 1)


def star_raw(spark, sf) -> dict[str, DataFrame]:
    """The six retail raw sources, derived from whole driver tables."""
    part = load(spark, sf, "part")
    li = load(spark, sf, "lineitem")
    od = load(spark, sf, "orders")
    sales = li.join(od, li["l_orderkey"] == od["o_orderkey"]).join(part, li["l_partkey"] == part["p_partkey"])
    return {
        "cust_info": raw_customers(spark, sf),
        "cust_az12": _t("customer", *I.STAR_CUST_AZ12)(spark, sf),
        "loc_a101": _t("customer", *I.STAR_LOC_A101)(spark, sf),
        "prd_info": _t("part", *I.STAR_PRD_INFO)(spark, sf),
        "px_cat_g1v2": part.groupBy(F.expr(I.STAR_PX_CAT_GROUP).alias("ID")).agg(*[F.expr(e) for e in I.STAR_PX_CAT[1:]]),
        "sales_details": sales.selectExpr(*I.STAR_SALES),
    }


def q_star_report(spark, sf):
    from layercake.plans.layers import folder_store, run_batch

    out = run_batch(star_raw(spark, sf), as_of=STAR_AS_OF, owners=["data_owner"], principal="analyst",
                    store=folder_store(), reports=("diagnostic_gold",))
    return out["diagnostic_gold"]


def q_star_customers_secure(spark, sf):
    from layercake.operators.governance import classify_columns as classify
    from layercake.plans.star import customer_dimension

    raw = {k: v for k, v in star_raw(spark, sf).items() if k in ("cust_info", "cust_az12", "loc_a101")}
    cleaned = {k: clean(v, SPECS[k], STAR_AS_OF) for k, v in raw.items()}
    dim = customer_dimension(cleaned["cust_info"], cleaned["cust_az12"], cleaned["loc_a101"])
    return mask_columns(classify(dim, CUSTOMER_COLUMN_METADATA), owners=["data_owner"], principal="analyst")


def q_clean_table_legacy(spark, sf):
    return clean_legacy(raw_customers(spark, sf), LEGACY_SPECS["cust_info"])


# --------------------------------------------------------- windows (W)
def q_dedupe_latest(spark, sf):
    df = load(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return dedupe(df, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "asc")])


def q_dedupe_any(spark, sf):
    df = load(spark, sf, "lineitem")
    return dedupe(df, ["l_orderkey", "l_linenumber"]).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def signup_versions(spark, sf):
    signups = (
        load(spark, sf, "events").filter(F.col("event_type") == "signup")
        .select("user_id", F.col("ts").cast("date").alias("start_date")).distinct()
    )
    return derive_end_date(signups, "user_id", "start_date", "end_date")


def q_derive_end_date(spark, sf):
    return signup_versions(spark, sf)


def order_periods(spark, sf):
    return load(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("start_date"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 90).cast("int")).alias("end_date"),
    )


def q_overlapping_versions(spark, sf):
    return overlapping_versions(order_periods(spark, sf), "o_custkey", "start_date", "end_date", "previous", ["o_orderkey"])


def q_overlapping_versions_any(spark, sf):
    return overlapping_versions(order_periods(spark, sf), "o_custkey", "start_date", "end_date", "any", ["o_orderkey"])


def purchases(spark, sf):
    return load(spark, sf, "events").filter(F.col("event_type") == "purchase").selectExpr(*I.PURCHASES)


def q_version_misses(spark, sf):
    return version_misses(purchases(spark, sf), signup_versions(spark, sf), "user_id", "event_date", "start_date", "end_date")


def q_version_misses_asof(spark, sf):
    versions = signup_versions(spark, sf)
    return version_misses(purchases(spark, sf), versions, "user_id", "event_date", "start_date", "end_date")


def q_version_misses_timestamps(spark, sf):
    """Facts with a time of day against versions that begin and end at one."""
    events = load(spark, sf, "events")
    versions = events.filter(F.col("event_type") == "signup").selectExpr(
        "user_id", "ts AS start_time", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + INTERVAL '36' HOUR END AS end_time")
    facts = events.filter(F.col("event_type") == "purchase").selectExpr(*I.PURCHASES_STAMPED)
    return version_misses(facts, versions, "user_id", "event_time", "start_time", "end_time")


def q_version_misses_mixed_keys(spark, sf):
    """Text keys (padded, unreadable, NULL) against numeric version keys."""
    facts = load(spark, sf, "events").filter(F.col("event_type") == "purchase").selectExpr(*I.PURCHASES_TEXT_KEY)
    return version_misses(facts, signup_versions(spark, sf), "user_key", "event_date", "start_date", "end_date", version_key="user_id")


def q_version_misses_closed(spark, sf):
    closed = load(spark, sf, "events").filter(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").cast("date").alias("start_date"),
        F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 5).cast("int")).alias("end_date"),
    )
    return version_misses(purchases(spark, sf), closed, "user_id", "event_date", "start_date", "end_date")


def q_assign_batches(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return assign_batches(df, ["o_orderdate", "o_orderkey"], [6000, 12000], keep_row_number=True)


# ----------------------------------------------------------- joins (J)
def q_orphan_rows(spark, sf):
    return orphan_rows(_t("orders", *I.ORDERS_BAD_KEYS)(spark, sf), load(spark, sf, "customer"), "o_custkey", "c_custkey")


def q_orphan_rows_nulls(spark, sf):
    fact = _t("orders", *I.ORDERS_BAD_AND_NULL_KEYS)(spark, sf)
    return orphan_rows(fact, load(spark, sf, "customer"), "o_custkey", "c_custkey")


def q_orphan_rows_ignore_nulls(spark, sf):
    fact = _t("orders", *I.ORDERS_BAD_AND_NULL_KEYS)(spark, sf)
    return orphan_rows(fact, load(spark, sf, "customer"), "o_custkey", "c_custkey", ignore_null_keys=True)


def q_dim_customer(spark, sf):
    base = _t("customer", *I.CUSTOMER_NATION_GAPS)(spark, sf)
    return build_dimension(
        base,
        [
            Lookup(load(spark, sf, "nation"), "c_nationkey", {"n_name": "nation_name", "n_regionkey": "region_key"},
                   "n_nationkey"),
            Lookup(load(spark, sf, "region"), "region_key", {"r_name": "region_name"}, "r_regionkey"),
        ],
        ["c_custkey", "c_name", "c_nationkey", "nation_name", "region_name"],
    )


def part_categories(spark, sf):
    return load(spark, sf, "part").groupBy(F.upper(F.substring("p_type", 1, 2)).alias("category_id")).agg(
        F.max("p_type").alias("category"), F.count(F.lit(1)).alias("parts_in_category")
    )


def q_dim_part(spark, sf):
    base = _t("part", *I.PART_WITH_CATEGORY)(spark, sf)
    return build_dimension(base, [Lookup(part_categories(spark, sf), "category_id", ["category", "parts_in_category"])])


def sales_fact(spark, sf):
    li = load(spark, sf, "lineitem")
    od = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return joined.select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_partkey").alias("product_key"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.date_add(F.col("l_shipdate").cast("date"), 30).alias("due_date"),
        F.col("l_extendedprice").alias("sales_amount"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_discount").alias("discount"),
    )


def q_fact_sales(spark, sf):
    return build_fact(sales_fact(spark, sf))


# ------------------------------------------------------ aggregates (A)
def q_null_profile(spark, sf):
    return null_profile(orders_with_nulls(spark, sf), "orders")


def q_completeness(spark, sf):
    return completeness(orders_with_nulls(spark, sf), "orders")


def q_null_details(spark, sf):
    return null_profile(orders_with_nulls(spark, sf), "orders").filter(F.col("null_count") > 0).select(
        "table_name", "column_name", "null_count", "null_percentage"
    )


def lineitem_with_copies(spark, sf):
    rows = load(spark, sf, "lineitem")
    return rows.selectExpr(*I.LINEITEM_WITH_NULLS).unionByName(rows.where(I.LINEITEM_COPIED).selectExpr(*I.LINEITEM_WITH_NULLS))


def q_exact_duplicates(spark, sf):
    return exact_duplicates(lineitem_with_copies(spark, sf), "lineitem")


def q_exact_duplicates_fingerprint(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return exact_duplicates(df, "lineitem")


def q_key_duplicates(spark, sf):
    return key_duplicates(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


SALES_RULES = {
    "ship_before_order": "ship_date IS NOT NULL AND order_date IS NOT NULL AND ship_date < order_date",
    "non_positive_quantity": "quantity <= 0",
    "negative_price": "price < 0",
    "high_discount": "discount > 0.08",
}


def q_rule_violations(spark, sf):
    return rule_violations(sales_fact(spark, sf), {k: F.expr(v) for k, v in SALES_RULES.items()}, "sales")


def q_reconcile(spark, sf):
    src = orders_with_nulls(spark, sf)
    return reconcile(src, require_not_null(src, ["o_orderpriority"]), "orders")


# ------------------------------------------------------- reports (Q)
def flagship_suites() -> dict[str, Suite]:
    return {
        "customer": Suite(
            keys=("c_custkey",),
            secondary_keys=(("c_name",),),
            required=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
            rules={"negative_balance": "c_acctbal < 0"},
            references=(Reference("c_nationkey", "nation", "n_nationkey", "nation_referential_integrity"),),
        ),
        "part": Suite(
            keys=("p_partkey",),
            secondary_keys=(("p_name", "p_brand"),),
            required=("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
            rules={"non_positive_price": "p_retailprice <= 0", "oversized": "p_size > 45"},
        ),
        "sales": Suite(
            keys=("order_number", "line_number"),
            required=("order_number", "product_key", "customer_id", "order_date", "ship_date", "quantity", "price"),
            rules=dict(SALES_RULES),
            references=(
                Reference("product_key", "part", "p_partkey", "product_referential_integrity"),
                Reference("customer_id", "customer", "c_custkey", "customer_referential_integrity"),
                Reference("supplier_key", "supplier", "s_suppkey", "supplier_referential_integrity"),
            ),
        ),
        "supplier_dim": Suite(keys=("s_suppkey",)),
        "signups": Suite(
            keys=("user_id", "start_date"),
            required=("user_id", "start_date"),
            overlaps=(Overlap("user_id", "start_date", "end_date", name="signup_validity_overlap"),),
        ),
        "purchases": Suite(
            keys=("event_id",),
            required=("event_id", "user_id", "event_date"),
            versions=(VersionMatch("user_id", "event_date", "signups", "start_date", "end_date",
                                   name="active_signup_match"),),
        ),
    }


def q_quality_report(spark, sf):
    # derived inputs read by several checks (the fact by a join, the signup
    # versions by a window) are materialised once in the checkpoint folder
    # instead of being recomputed per check
    tables = {
        "customer": load(spark, sf, "customer"),
        "part": load(spark, sf, "part"),
        "sales": materialize(sales_fact(spark, sf), "sales-fact"),
        "nation": load(spark, sf, "nation"),
        "supplier": load(spark, sf, "supplier"),
        "supplier_dim": None,
        "signups": materialize(signup_versions(spark, sf), "signup-versions"),
        "purchases": purchases(spark, sf),
    }
    return quality_report(tables, flagship_suites(), spark=spark)


def q_report_summary(spark, sf):
    return report_summary(q_quality_report(spark, sf))


def q_profile_report(spark, sf):
    return profile_report({
        "raw_orders": orders_with_nulls(spark, sf),
        "raw_customers": raw_customers(spark, sf),
        "raw_nation": load(spark, sf, "nation"),
        "other_region": load(spark, sf, "region"),
    }, prefix="raw_")


def q_layer_report(spark, sf):
    raw_o = orders_with_nulls(spark, sf)
    cleaned_o = require_not_null(dedupe(raw_o, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "asc")]),
                                 ["o_orderpriority"])
    raw_c = raw_customers(spark, sf)
    return layer_report([
        LayerPair("raw_orders", raw_o, "clean_orders", cleaned_o, ["o_custkey"]),
        LayerPair("raw_customers", raw_c, "clean_customer", clean(raw_c, CUSTOMER_SPEC),
                  CUSTOMER_SPEC.renamed_keys()),
    ])


# ---------------------------------------------------- governance (P15, M)
def customer_pii(spark, sf):
    df = _t("customer", *I.CUSTOMER_PII)(spark, sf).withColumn(
        "birth_date",
        F.expr("CASE WHEN customer_id % 29 = 0 THEN NULL ELSE date_add(DATE'1950-01-01', CAST((customer_id * 37) % 20000 AS INT)) END"),
    )
    return classify_columns(df, CUSTOMER_COLUMN_METADATA)


def q_mask_columns(spark, sf):
    return mask_columns(customer_pii(spark, sf), owners=["data_owner"], principal="analyst")


def q_mask_columns_owner(spark, sf):
    return mask_columns(customer_pii(spark, sf), owners=["data_owner"], principal="data_owner")


def all_tables(spark, sf):
    return {n: load(spark, sf, n) for n in TABLES}


def q_table_inventory(spark, sf):
    return table_inventory(spark, all_tables(spark, sf))


def q_column_inventory(spark, sf):
    return column_inventory(spark, all_tables(spark, sf)).drop("comment", "classification")


def _customer_dimension(spark, sf):
    from layercake.plans.star import customer_dimension

    raw = {k: v for k, v in star_raw(spark, sf).items() if k in ("cust_info", "cust_az12", "loc_a101")}
    cleaned = {k: clean(v, SPECS[k], STAR_AS_OF) for k, v in raw.items()}
    return customer_dimension(cleaned["cust_info"], cleaned["cust_az12"], cleaned["loc_a101"])


def q_governed_tables(spark, sf):
    """Inventory of a labelled table in the catalog, a view and a bare DataFrame."""
    import uuid

    from layercake.operators.governance import CUSTOMER_TABLE_LABELS, label_table
    from layercake.sources.sinks import publish_table

    database = f"layercake_{uuid.uuid4().hex[:12]}"
    dim = label_table(_customer_dimension(spark, sf), CUSTOMER_TABLE_LABELS, "Customer dimension")
    publish_table(dim, f"{database}.gold_dim_customers")
    load(spark, sf, "nation").createOrReplaceTempView("governed_nation_view")
    tables = {
        "gold_dim_customers": spark.table(f"{database}.gold_dim_customers"), "governed_nation_view": spark.table("governed_nation_view"),
        "region": load(spark, sf, "region"),
    }
    names = {"gold_dim_customers": f"{database}.gold_dim_customers", "governed_nation_view": "governed_nation_view"}
    return table_inventory(spark, tables, {"region": "World regions"}, names)


def q_governed_columns(spark, sf):
    """Column inventory of the classified customer dimension."""
    from layercake.operators.governance import classify_columns as classify

    return column_inventory(spark, {"gold_dim_customers": classify(_customer_dimension(spark, sf), CUSTOMER_COLUMN_METADATA)}).drop("is_nullable")


def q_scan_patterns(spark, sf):
    return scan_patterns(load(spark, sf, "documents"), "text")


def q_scan_pattern_hits(spark, sf):
    return pattern_hits(load(spark, sf, "documents"), "text", "doc_id")


# ------------------------------------------------------ sources (S, K)
def q_raw_csv_roundtrip(spark, sf):
    from layercake.plans.catalog import raw_string_schema
    from layercake.session import scratch_path
    from layercake.sources.csv import read_raw_csv

    path = scratch_path(spark, "csv-roundtrip")
    cust = load(spark, sf, "customer")
    cust.select(*[F.col(c).cast("string") for c in cust.columns]).write.option("header", True).csv(path)
    # positional binding: the header says c_custkey..., the schema names differ
    raw = read_raw_csv(spark, path, raw_string_schema("id", "name", "nation", "balance", "segment"))
    return raw.select(
        F.col("id").cast("long").alias("id"), "name", F.col("nation").cast("int").alias("nation"),
        F.col("balance").cast("double").alias("balance"), "segment",
    )


def q_ingest_increment(spark, sf):
    from layercake.operators.batches import assign_batches as batches
    from layercake.plans.catalog import raw_string_schema
    from layercake.session import scratch_path
    from layercake.streaming.ingest import ingest_increment, read_sink

    events = load(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("event_date"), "props"
    )
    schema = raw_string_schema(*events.columns)
    numbered = batches(events, ["event_id"], [4000, 8000])
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    total = 0
    for b in (1, 2, 3):
        drop = numbered.filter(F.col("batch_id") == b).drop("batch_id")
        drop.select(*[F.col(c).cast("string") for c in drop.columns]).write.mode("append").option(
            "header", True).csv(landing)
        total += ingest_increment(spark, landing, schema, sink)
    out = read_sink(spark, sink, schema)
    return out.select(
        F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"),
        "event_type", F.col("value").cast("double").alias("value"),
        F.col("event_date").cast("date").alias("event_date"), "props",
        F.lit(total).cast("long").alias("rows_ingested"),
    )


def q_release_batches(spark, sf):
    """Export numbered batches, release them all, read the landing folder back."""
    from layercake.operators.batches import assign_batches as batches
    from layercake.session import scratch_path
    from layercake.sources.sinks import LOSSLESS_CSV, write_batches
    from layercake.sources.tables import release_batch

    docs = load(spark, sf, "documents").selectExpr(*I.DOCUMENTS_MESSY)
    exported = write_batches(batches(docs, ["doc_id"], [60, 150]), scratch_path(spark, "export"))
    landing, log = scratch_path(spark, "landing"), scratch_path(spark, "release-log")
    while release_batch(spark, exported, landing, log) is not None:
        pass
    back = spark.read.schema("doc_id string, text string, batch_id int").options(**LOSSLESS_CSV).csv(landing)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "batch_id")


def q_ingest_inferred(spark, sf):
    """Incremental intake of a folder whose schema is inferred from it."""
    from layercake.session import scratch_path
    from layercake.streaming.ingest import ingest_increment, stream_raw_csv

    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    total = 0
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").option("header", True).csv(landing)
        total += ingest_increment(spark, landing, None, sink)
    out = spark.read.schema(stream_raw_csv(spark, landing).schema).parquet(sink)
    return out.select(
        F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "event_type",
        F.col("value").cast("double").alias("value"), F.lit(total).cast("long").alias("rows_ingested"),
    )


def q_catalog_roundtrip(spark, sf):
    """Publish tables to a schema, publish one again with its schema kept, discover them by prefix, load and profile them."""
    import uuid

    from layercake.sources.csv import discover_tables
    from layercake.sources.sinks import publish_table
    from layercake.sources.tables import load_tables

    database = f"layercake_{uuid.uuid4().hex[:12]}"
    for name in ("orders", "customer"):
        publish_table(load(spark, sf, name), f"{database}.raw_{name}")
    publish_table(load(spark, sf, "part"), f"{database}.other_part")
    publish_table(orders_with_nulls(spark, sf), f"{database}.raw_orders_nulls")
    publish_table(load(spark, sf, "customer"), f"{database}.raw_customer", check_schema=True)
    names = discover_tables(spark, "raw_", database)
    tables = load_tables(spark, [*names, "raw_absent"], database)
    report = materialize(profile_report(tables, spark=spark).select("table_name", "row_count", "column_count", "total_null_values"), "catalog-report")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return report


def q_ingest_sources(spark, sf):
    """Register raw files by source name; unknown and unreadable ones are collected."""
    from layercake.plans.catalog import raw_string_schema
    from layercake.session import scratch_path
    from layercake.sources.csv import ingest_sources

    base = scratch_path(spark, "sources")
    files = []
    for name in ("customer", "part", "supplier"):
        load(spark, sf, name).write.option("header", True).csv(f"{base}/{name}.csv")
        files.append(f"{base}/{name}.csv")
    registry = {n: raw_string_schema(*load(spark, sf, n).columns) for n in ("customer", "part", "nation")}
    result = ingest_sources(spark, [*files, f"{base}/nation.csv"], registry, strict=False)
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for name, df in sorted(result.tables.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("errors", F.lit(len(result.errors)))


def q_masked_view(spark, sf):
    """The masked customer dimension, read through its view's name by someone who is no owner."""
    import uuid

    from layercake.operators.governance import classify_columns as classify
    from layercake.operators.governance import register_masked_view
    from layercake.plans.star import customer_dimension

    raw = {k: v for k, v in star_raw(spark, sf).items() if k in ("cust_info", "cust_az12", "loc_a101")}
    cleaned = {k: clean(v, SPECS[k], STAR_AS_OF) for k, v in raw.items()}
    dim = customer_dimension(cleaned["cust_info"], cleaned["cust_az12"], cleaned["loc_a101"])
    view = f"customers_masked_view_{uuid.uuid4().hex[:12]}"
    register_masked_view(classify(dim, CUSTOMER_COLUMN_METADATA), view, owners=["data_owner"])
    return spark.table(view)


def q_star_increment(spark, sf):
    """The star report after three increments of every source's landing folder, each recomputing the keys it touches."""
    from layercake.plans.catalog import RAW_SCHEMAS
    from layercake.plans.incremental import IncrementalStar, run_keyed_increment
    from layercake.plans.layers import STAR_SUITES
    from layercake.session import scratch_path
    from layercake.sources.sinks import LOSSLESS_CSV
    from layercake.streaming.intake import Intake

    raw = star_raw(spark, sf)
    star = IncrementalStar(spark, scratch_path(spark, "star"), buckets=8, as_of=STAR_AS_OF)
    jobs = [Intake(s, scratch_path(spark, f"land-{s}"), scratch_path(spark, f"sink-{s}"), RAW_SCHEMAS[s], LOSSLESS_CSV) for s in raw]
    text = {s: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) for s, df in raw.items()}
    parts = {s: materialize(df.withColumn("__part", F.pmod(F.xxhash64(*df.columns), F.lit(3))), f"raw-{s}") for s, df in text.items()}
    for part in (0, 1, 2):
        for job in jobs:
            parts[job.name].where(F.col("__part") == part).drop("__part").write.mode("append").options(**LOSSLESS_CSV, compression="gzip").csv(job.folder)
        run_keyed_increment(star, jobs)
    tables = star.tables()
    return quality_report({n: tables.get(n) for n in STAR_SUITES}, STAR_SUITES, as_of=STAR_AS_OF, spark=spark)


def q_intake_streams(spark, sf):
    """Six sources taken in at once, one of them broken, and once more without new files."""
    from layercake.plans.catalog import raw_string_schema
    from layercake.session import scratch_path
    from layercake.streaming.intake import Intake, outcome_rows, run_streams

    base, jobs = scratch_path(spark, "intake"), []
    for name in ("customer", "part", "orders", "lineitem", "supplier", "nation"):
        df = load(spark, sf, name)
        df.write.option("header", True).csv(f"{base}/{name}")
        columns = df.columns[:-1] if name == "supplier" else df.columns  # a column short: strict reading fails
        jobs.append(Intake(name, f"{base}/{name}", f"{base}/sink-{name}", raw_string_schema(*columns), {"mode": "FAILFAST"} if name == "supplier" else {}))
    first, again = outcome_rows(spark, run_streams(spark, jobs)), outcome_rows(spark, run_streams(spark, jobs))
    kept = lambda df, name: df.select("source", F.col("rows").alias(name), F.col("error").isNotNull().alias(f"{name}_failed"))
    return kept(first, "first_rows").join(kept(again, "again_rows"), "source")


def q_checked_intake(spark, sf):
    """Documents as CSV lines, some of them malformed, through a file stream that keeps those apart."""
    from layercake.session import scratch_path
    from layercake.streaming.intake import Intake, read_checked_sink, run_streams

    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    load(spark, sf, "documents").selectExpr(f"{I.DOCUMENT_LINE} AS value").write.text(landing)
    schema = spark.createDataFrame([], "doc_id bigint, lang string, text_hex string, n_chars bigint").schema
    outcome = run_streams(spark, [Intake("documents", landing, sink, schema, {"header": "false", "maxCharsPerColumn": "-1"}, rejects=True)])[0]
    found = read_checked_sink(spark, sink, schema)
    kept = found.kept.select("doc_id", "lang", F.decode(F.unhex("text_hex"), "UTF-8").alias("text"), "n_chars", F.lit(None).cast("string").alias("line"))
    rejected = found.rejected.select(*[F.lit(None).cast(t).alias(n) for n, t in kept.dtypes[:-1]], F.col("_line").alias("line"))
    counts = [F.lit(outcome.rows).alias("rows_read"), F.lit(outcome.rejected).alias("rows_rejected")]
    return kept.unionByName(rejected).select("*", *[x.cast("bigint") for x in counts])


def q_orphan_rows_filtered(spark, sf):
    """Order lines without an order, the orders' keys as a Bloom filter."""
    return orphan_rows_filtered(_t("lineitem", *I.LINEITEM_BAD_KEYS)(spark, sf), load(spark, sf, "orders"), "l_orderkey", "o_orderkey")


def q_report_state(spark, sf):
    """Profile and key duplicates of the orders after each of three increments, each of which counts its own files only."""
    from layercake.plans.report_state import ReportState
    from layercake.session import scratch_path

    root = scratch_path(spark, "report-state")
    state, landed, out = ReportState(spark, f"{root}/state", ["o_custkey"]), [], []
    orders = orders_with_nulls(spark, sf).withColumn("part", F.pmod(F.col("o_orderkey"), F.lit(3)))
    for i in range(3):
        orders.where(F.col("part") == i).drop("part").write.parquet(f"{root}/landing/{i}")
        landed += spark.read.parquet(f"{root}/landing/{i}").inputFiles()
        state.update(landed, lambda names: spark.read.parquet(*names))
        out.append(materialize(state.report("orders").withColumn("increment", F.lit(i + 1)), "report"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_publish_atomic(spark, sf):
    """A table published, published again by a job that dies between writing and the swap, and then by one that does not."""
    from layercake.session import scratch_path
    from layercake.sources.versioned import VersionedStore, publish_atomic

    root = scratch_path(spark, "published")
    publish_atomic(orders_padded(spark, sf), root, "orders")

    def dies():
        raise RuntimeError("lost before the swap")

    cleaned = trim_nullify(orders_padded(spark, sf))
    try:
        publish_atomic(cleaned, root, "orders", before_swap=dies)
    except RuntimeError:
        pass
    store = VersionedStore(spark, root)
    after_loss = store.read("orders")  # pinned to the version of now
    publish_atomic(cleaned, root, "orders", check_schema=True)
    return after_loss.withColumn("step", F.lit(1)).unionByName(store.read("orders").withColumn("step", F.lit(2)))


def q_release_concurrent(spark, sf):
    """Two releasers at once over all batches: how often each batch was taken, and the rows that landed."""
    from concurrent.futures import ThreadPoolExecutor

    from layercake.operators.batches import assign_batches as batches
    from layercake.session import scratch_path
    from layercake.sources.sinks import LOSSLESS_CSV, write_batches
    from layercake.sources.tables import release_batch

    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    exported = write_batches(batches(orders, ["o_orderkey"], [2000, 4000, 6000, 8000]), scratch_path(spark, "export"))
    landing, log = scratch_path(spark, "landing"), scratch_path(spark, "release-log")

    def work(_):
        taken = []
        while (batch := release_batch(spark, exported, landing, log)) is not None:
            taken.append(batch)
        return taken

    with ThreadPoolExecutor(max_workers=2) as pool:
        taken = spark.createDataFrame([(b,) for mine in pool.map(work, range(2)) for b in mine], "batch_id int")
    landed = spark.read.schema("o_orderkey bigint, o_custkey bigint, batch_id int").options(**LOSSLESS_CSV).csv(landing)
    landed = landed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_landed"), F.sum("o_orderkey").alias("key_sum"))
    return taken.groupBy("batch_id").agg(F.count(F.lit(1)).alias("times_taken")).join(landed, "batch_id", "full")


def q_assign_batches_file_order(spark, sf):
    from layercake.operators.batches import assign_file_batches

    return assign_file_batches(load(spark, sf, "orders"), [6000, 12000], keep_row_number=True).select("o_orderkey", "row_number", "batch_id")


def q_read_by_header(spark, sf):
    """Customer files with columns in another order, columns missing and columns that the schema does not know."""
    from layercake.plans.catalog import raw_string_schema
    from layercake.session import scratch_path
    from layercake.sources.csv import read_csv_by_header

    cust = load(spark, sf, "customer")
    path = scratch_path(spark, "by-header")
    layouts = (("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ("C_NAME", "c_mktsegment", "c_custkey"), ("c_acctbal", "c_nationkey", "c_custkey", "c_name"))
    for part, columns in enumerate(layouts):
        cust.where(F.col("c_custkey") % 3 == part).select(*[F.col(c).alias(c) for c in columns]).write.mode("append").option("header", True).csv(path)
    raw = read_csv_by_header(spark, path, raw_string_schema("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    return raw.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_mktsegment")


def q_raw_csv_inferred(spark, sf):
    """All line items through CSV files whose types are inferred."""
    from layercake.session import scratch_path
    from layercake.sources.csv import read_raw_csv

    path = scratch_path(spark, "csv-inferred")
    items = load(spark, sf, "lineitem").drop("l_shipdate")
    items.write.option("header", True).csv(path)
    back = read_raw_csv(spark, path)
    return back.select(*[F.col(n).cast(t).alias(n) for n, t in items.dtypes], F.lit(",".join(t for _, t in back.dtypes)).alias("inferred_types"))


def q_column_contracts(spark, sf):
    """What the column contract of every table says about a list of names that it has only in part."""
    from layercake.operators.rules import require_columns

    found = []
    for name in TABLES:
        df = load(spark, sf, name)
        try:
            require_columns(df, [*df.columns, f"{name}_note", "checked_at"], name)
            message = None
        except ValueError as exc:
            message = str(exc)
        found.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.lit(message).alias("message")))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trim_nullify": q_trim_nullify,
    "regex_rules": q_regex_rules,
    "value_map": q_value_map,
    "safe_cast": q_safe_cast,
    "safe_date": q_safe_date,
    "date_default_format": q_date_default_format,
    "split_key": q_split_key,
    "null_future_dates": q_null_future_dates,
    "fill_nulls": q_fill_nulls,
    "require_not_null": q_require_not_null,
    "rename_strict": q_rename_strict,
    "clean_table": q_clean_table,
    "clean_table_legacy": q_clean_table_legacy,
    "clean_products": q_clean_products,
    "clean_sales": q_clean_sales,
    "star_report": q_star_report,
    "star_customers_secure": q_star_customers_secure,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_any": q_dedupe_any,
    "derive_end_date": q_derive_end_date,
    "overlapping_versions": q_overlapping_versions,
    "overlapping_versions_any": q_overlapping_versions_any,
    "version_misses": q_version_misses,
    "version_misses_asof": q_version_misses_asof,
    "version_misses_closed": q_version_misses_closed,
    "orphan_rows": q_orphan_rows,
    "orphan_rows_nulls": q_orphan_rows_nulls,
    "orphan_rows_ignore_nulls": q_orphan_rows_ignore_nulls,
    "dim_customer": q_dim_customer,
    "dim_part": q_dim_part,
    "fact_sales": q_fact_sales,
    "null_profile": q_null_profile,
    "completeness": q_completeness,
    "null_details": q_null_details,
    "exact_duplicates": q_exact_duplicates,
    "exact_duplicates_fingerprint": q_exact_duplicates_fingerprint,
    "key_duplicates": q_key_duplicates,
    "rule_violations": q_rule_violations,
    "reconcile": q_reconcile,
    "quality_report": q_quality_report,
    "report_summary": q_report_summary,
    "profile_report": q_profile_report,
    "layer_report": q_layer_report,
    "mask_columns": q_mask_columns,
    "mask_columns_owner": q_mask_columns_owner,
    "assign_batches": q_assign_batches,
    "table_inventory": q_table_inventory,
    "column_inventory": q_column_inventory,
    "governed_tables": q_governed_tables,
    "governed_columns": q_governed_columns,
    "scan_patterns": q_scan_patterns,
    "scan_pattern_hits": q_scan_pattern_hits,
    "raw_csv_roundtrip": q_raw_csv_roundtrip,
    "ingest_increment": q_ingest_increment,
    "version_misses_timestamps": q_version_misses_timestamps,
    "version_misses_mixed_keys": q_version_misses_mixed_keys,
    "release_batches": q_release_batches,
    "ingest_inferred": q_ingest_inferred,
    "catalog_roundtrip": q_catalog_roundtrip,
    "ingest_sources": q_ingest_sources,
    "masked_view": q_masked_view,
    "star_increment": q_star_increment,
    "intake_streams": q_intake_streams,
    "checked_intake": q_checked_intake,
    "publish_atomic": q_publish_atomic,
    "orphan_rows_filtered": q_orphan_rows_filtered,
    "report_state": q_report_state,
    "release_concurrent": q_release_concurrent,
    "assign_batches_file_order": q_assign_batches_file_order,
    "read_by_header": q_read_by_header,
    "raw_csv_inferred": q_raw_csv_inferred,
    "column_contracts": q_column_contracts,
}
