"""Star-schema builds.

Dimensions are a base table left-joined to lookups on a key. No join is
forced to broadcast: AQE measures each materialised lookup and broadcasts it
only when it is below the threshold, otherwise a shuffled join runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns


@dataclass(frozen=True)
class Lookup:
    """A lookup joined on ``key`` (base side) = ``lookup_key`` (lookup side),
    contributing ``columns`` (optionally renamed as ``{source: output}``)."""

    df: DataFrame
    key: str
    columns: Sequence[str] | dict
    lookup_key: str | None = None


def build_dimension(base: DataFrame, lookups: Sequence[Lookup], columns: Sequence[str] | None = None) -> DataFrame:
    """Left equi-joins of ``base`` with each lookup; output in ``columns`` order."""
    out = base
    for i, lk in enumerate(lookups):
        lookup_key = lk.lookup_key or lk.key
        cols = lk.columns if isinstance(lk.columns, dict) else {n: n for n in lk.columns}
        require_columns(out, [lk.key], "Dimension base key")
        require_columns(lk.df, [lookup_key, *cols], "Lookup columns")
        alias_key = f"__lk{i}_key"
        right = lk.df.select(c(lookup_key).alias(alias_key), *[c(s).alias(t) for s, t in cols.items()])
        out = out.join(right, c(lk.key) == F.col(alias_key), "left").drop(alias_key)
    if columns is not None:
        out = out.select(*[c(n) for n in columns])
    return out


# Output layouts of the star tables.
CUSTOMER_DIM_COLUMNS = (
    "customer_id", "customer_key", "firstname", "lastname", "marital_status", "gender", "country", "birth_date",
    "creation_date",
)
PRODUCT_DIM_COLUMNS = (
    "product_id", "product_key", "product_name", "cost", "product_line", "start_date", "end_date", "category_id",
    "category", "subcategory", "maintenance",
)
SALES_FACT_COLUMNS = (
    "order_number", "product_key", "customer_id", "order_date", "ship_date", "due_date", "sales_amount", "quantity",
    "price",
)


def customer_dimension(info: DataFrame, demographics: DataFrame, location: DataFrame) -> DataFrame:
    """Customer info + birth date (demographics) + country (location) on the
    customer key; gender and marital status come from the CRM side only."""
    return build_dimension(
        info,
        [Lookup(location, "customer_key", ["country"]), Lookup(demographics, "customer_key", ["birth_date"])],
        CUSTOMER_DIM_COLUMNS,
    )


def product_dimension(products: DataFrame, categories: DataFrame) -> DataFrame:
    """All product versions + category attributes on ``category_id``."""
    return build_dimension(
        products, [Lookup(categories, "category_id", ["category", "subcategory", "maintenance"])], PRODUCT_DIM_COLUMNS
    )


def build_fact(df: DataFrame, columns: Sequence[str] = SALES_FACT_COLUMNS) -> DataFrame:
    """Ordered projection of the fact columns."""
    require_columns(df, columns, "Fact columns")
    return df.select(*[c(n) for n in columns])
