"""The retail source catalog: raw schemas, layer table names and the six
cleaning specs (C2). These are configuration values, not logic.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

from layercake.functions.columns import CRM_CUSTOMER_KEY_PREFIX, ERP_CUSTOMER_KEY_PREFIX
from layercake.plans.spec import TableSpec


def raw_string_schema(*columns: str) -> StructType:
    """Every raw column is a nullable string; typing happens when cleaning."""
    return StructType([StructField(n, StringType(), True) for n in columns])


# Raw source layouts (column order = CSV order).
RAW_SCHEMAS = {
    "cust_info": raw_string_schema(
        "cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"
    ),
    "prd_info": raw_string_schema("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"),
    "sales_details": raw_string_schema(
        "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
        "sls_sales", "sls_quantity", "sls_price",
    ),
    "cust_az12": raw_string_schema("CID", "BDATE", "GEN"),
    "loc_a101": raw_string_schema("CID", "CNTRY"),
    "px_cat_g1v2": raw_string_schema("ID", "CAT", "SUBCAT", "MAINTENANCE"),
}

# Source system of each raw file (raw table = raw_<system>_<name>).
SOURCE_SYSTEM = {
    "cust_info": "crm",
    "prd_info": "crm",
    "sales_details": "crm",
    "cust_az12": "erp",
    "loc_a101": "erp",
    "px_cat_g1v2": "erp",
}


# The sources that arrive as file streams in streaming mode
# (the others stay batch).
STREAMED_SOURCES = ("cust_info", "sales_details")


def raw_table_name(source: str) -> str:
    return f"bronze_{SOURCE_SYSTEM[source]}_{source}"


_GENDER = {"M": "Male", "F": "Female", "Male": "Male", "Female": "Female"}

# Cleaning rules of the six sources.
SPECS: dict[str, TableSpec] = {
    "cust_info": TableSpec(
        target="silver_customer_info",
        keys=("cst_id",),
        order_by=(("cst_create_date", "desc"),),
        regex={"cst_key": ((CRM_CUSTOMER_KEY_PREFIX, ""),)},
        dates={"cst_create_date": None},
        casts={"cst_id": "int"},
        value_maps={
            "cst_gndr": _GENDER,
            "cst_marital_status": {"M": "Married", "S": "Single", "Married": "Married", "Single": "Single"},
        },
        fill={"cst_gndr": "missing", "cst_marital_status": "missing"},
        required=("cst_id", "cst_key"),
        rename={
            "cst_id": "customer_id",
            "cst_key": "customer_key",
            "cst_firstname": "firstname",
            "cst_lastname": "lastname",
            "cst_marital_status": "marital_status",
            "cst_gndr": "gender",
            "cst_create_date": "creation_date",
        },
    ),
    "prd_info": TableSpec(
        target="silver_product_info",
        keys=("prd_id",),
        transforms_before=("split_product_key",),
        dates={"prd_start_dt": None, "prd_end_dt": None},
        casts={"prd_id": "int", "prd_cost": "int"},
        fill={"prd_line": "missing"},
        required=("prd_id", "prd_key"),
        transforms_after=("derive_product_end_date",),
        rename={
            "prd_id": "product_id",
            "prd_key": "product_key",
            "prd_nm": "product_name",
            "prd_cost": "cost",
            "prd_line": "product_line",
            "prd_start_dt": "start_date",
            "prd_end_dt": "end_date",
        },
    ),
    "sales_details": TableSpec(
        target="silver_sales_details",
        keys=("sls_ord_num", "sls_prd_key"),
        dates={"sls_order_dt": "yyyyMMdd", "sls_ship_dt": "yyyyMMdd", "sls_due_dt": "yyyyMMdd"},
        casts={"sls_cust_id": "int", "sls_sales": "int", "sls_quantity": "int", "sls_price": "int"},
        required=("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_sales", "sls_quantity"),
        rename={
            "sls_ord_num": "order_number",
            "sls_prd_key": "product_key",
            "sls_cust_id": "customer_id",
            "sls_order_dt": "order_date",
            "sls_ship_dt": "ship_date",
            "sls_due_dt": "due_date",
            "sls_sales": "sales_amount",
            "sls_quantity": "quantity",
            "sls_price": "price",
        },
    ),
    "cust_az12": TableSpec(
        target="silver_customer_demographics",
        keys=("CID",),
        regex={"CID": ((ERP_CUSTOMER_KEY_PREFIX, ""),)},
        dates={"BDATE": None},
        value_maps={"GEN": _GENDER},
        fill={"GEN": "missing"},
        required=("CID",),
        transforms_after=("validate_birth_date",),
        rename={"CID": "customer_key", "BDATE": "birth_date", "GEN": "gender"},
    ),
    "loc_a101": TableSpec(
        target="silver_customer_location",
        keys=("CID",),
        regex={"CID": ((ERP_CUSTOMER_KEY_PREFIX, ""),)},
        value_maps={"CNTRY": {"DE": "Germany", "US": "United States", "USA": "United States"}},
        fill={"CNTRY": "missing"},
        required=("CID",),
        rename={"CID": "customer_key", "CNTRY": "country"},
    ),
    "px_cat_g1v2": TableSpec(
        target="silver_product_category",
        keys=("ID",),
        required=("ID",),
        rename={"ID": "category_id", "CAT": "category", "SUBCAT": "subcategory", "MAINTENANCE": "maintenance"},
    ),
}
