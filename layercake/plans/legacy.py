"""First-generation cleaning flow.

Kept as an option for users of the older per-table cleaning: its results
differ from ``clean`` (dates become ``dd/MM/yyyy`` text with a 2000-01-01
default, keys are cast to integers, blanks survive, dedupe comes first).
Composed from the same operators, in the older order:

    dedupe (any row per key) -> key prefix strip -> trim (blanks kept)
    -> date text by column name -> NULL fill -> casts -> required -> rename

Differences kept on purpose: the survivor of the dedupe is deterministic
(lowest row in all-column order) instead of arbitrary, and malformed dates /
numbers fall back to the default / NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators import rules
from layercake.operators.dedupe import dedupe


@dataclass(frozen=True)
class LegacySpec:
    target: str = ""
    keys: tuple[str, ...] = ()
    key_rule: tuple[str, str] | None = None  # (column, case-sensitive prefix pattern)
    date_pattern: str | None = None
    fill: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)


def clean_legacy(df: DataFrame, spec: LegacySpec) -> DataFrame:
    df = dedupe(df, spec.keys)
    if spec.key_rule:
        col, pattern = spec.key_rule
        df = df.withColumn(col, F.regexp_replace(F.trim(c(col)), pattern, ""))
    df = rules.trim_nullify(df, nullify=False)
    df = rules.date_default_format(df, fmt=spec.date_pattern)
    df = rules.fill_nulls(df, spec.fill)
    df = rules.safe_cast(df, spec.casts)
    df = rules.require_not_null(df, spec.required)
    # renames of absent columns are skipped, as the older flow did
    return rules.rename_strict(df, {k: v for k, v in spec.rename.items() if k in df.columns})


# The three first-generation CRM specs.
LEGACY_SPECS = {
    "cust_info": LegacySpec(
        target="silver_customer_info",
        keys=("cst_id",),
        key_rule=("cst_key", "^AW"),
        fill={"cst_gndr": "missing", "cst_marital_status": "missing"},
        casts={"cst_id": "int", "cst_key": "int"},
        required=("cst_id", "cst_key"),
        rename={"cst_id": "id", "cst_key": "key", "cst_firstname": "firstname", "cst_lastname": "lastname",
                "cst_marital_status": "marital_status", "cst_gender": "gender", "cst_create_date": "creation_date"},
    ),
    "prd_info": LegacySpec(
        target="silver_product_info",
        keys=("prd_id",),
        key_rule=("prd_key", "^[A-Z]{2}-[A-Z]{2}-"),
        fill={"prd_line": "missing"},
        casts={"prd_cost": "int"},
        required=("prd_id", "prd_key"),
        rename={"prd_id": "id", "prd_key": "key", "prd_nm": "name", "prd_line": "line", "prd_cost": "cost",
                "prd_start_dt": "start_date", "prd_end_dt": "end_date"},
    ),
    "sales_details": LegacySpec(
        target="silver_sales_details",
        keys=("sls_ord_num",),
        date_pattern="yyyyMMdd",
        casts={"sls_sales": "int", "sls_quantity": "int", "sls_price": "int"},
        required=("sls_quantity", "sls_sales"),
        rename={"sls_ord_num": "order_number", "sls_prd_key": "product_key", "sls_cust_id": "customer_id",
                "sls_order_dt": "order_date", "sls_due_dt": "due_date", "sls_ship_dt": "ship_date",
                "sls_sales": "sales_amount", "sls_quantity": "quantity", "sls_price": "price"},
    ),
}
