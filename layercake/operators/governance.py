"""Classification metadata, masking and inventories.

Classification labels live in ``StructField.metadata`` (keys ``comment`` and
``classification``) so they travel with the DataFrame and into parquet
tables. Masking is a projection: the owner check is one boolean expression,
evaluated per row by the JVM, never a driver-side branch on data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from layercake.functions import columns as fx
from layercake.functions.columns import c
from layercake.operators.profile import ROWS, null_alias, table_metrics

# Documentation and classification of the customer dimension.
CUSTOMER_COLUMN_METADATA = {
    "customer_id": ("Internal customer identifier", "internal_identifier"),
    "customer_key": ("Business customer key", "internal_identifier"),
    "firstname": ("Customer first name", "pii_name"),
    "lastname": ("Customer last name", "pii_name"),
    "birth_date": ("Customer date of birth", "pii_birth_date"),
    "country": ("Customer country", "geographic"),
    "marital_status": ("Customer marital status", "sensitive_demographic"),
    "gender": ("Customer gender value from source system", "sensitive_demographic"),
    "creation_date": ("Customer record creation date", "operational_metadata"),
}

PII_NAME = "pii_name"
PII_BIRTH_DATE = "pii_birth_date"
IDENTIFIER = "internal_identifier"


def classify_columns(df: DataFrame, metadata: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach (comment, classification) to the columns that exist (K10);
    unknown names are skipped, as the source pipeline tolerated them."""
    present = {n.lower(): n for n in df.columns}
    for name, (comment, label) in metadata.items():
        actual = present.get(name.lower())
        if actual is None:
            continue
        meta = dict(df.schema[actual].metadata or {})
        meta.update({"comment": comment, "classification": label})
        df = df.withMetadata(actual, meta)
    return df


# Labels of the customer dimension as a table.
CUSTOMER_TABLE_LABELS = {"layer": "gold", "domain": "customer", "classification": "confidential"}

_TABLE_KEY = "table"  # metadata of the first column that belongs to the whole table


def label_table(df: DataFrame, labels: Mapping[str, str], comment: str | None = None) -> DataFrame:
    """Attach labels (layer, domain, classification, ...) and a comment to the table as a whole.

    They live in the first column's metadata under ``table``, so they travel
    with the DataFrame and into parquet tables like the columns' own. A frame
    without columns is returned as it is.
    """
    if not df.columns:
        return df
    first = df.schema.fields[0]
    meta = dict(first.metadata or {})
    meta[_TABLE_KEY] = {**meta.get(_TABLE_KEY, {}), **labels, **({"comment": comment} if comment else {})}
    return df.withMetadata(first.name, meta)


def table_labels(df: DataFrame) -> dict[str, str]:
    """Labels and comment of a table (see ``label_table``)."""
    return dict((df.schema.fields[0].metadata or {}).get(_TABLE_KEY, {})) if df.columns else {}


def classification_of(df: DataFrame) -> dict[str, str]:
    return {f.name: (f.metadata or {}).get("classification") for f in df.schema.fields if (f.metadata or {}).get("classification")}


def is_principal(owners: Sequence[str], principal: str | Column | None = None) -> Column:
    """TRUE when the principal (default: ``session_user()``) is an owner."""
    who = F.session_user() if principal is None else (principal if isinstance(principal, Column) else F.lit(principal))
    if not owners:
        return F.lit(False)
    return who.isin(*[F.lit(o) for o in owners])


def mask_columns(
    df: DataFrame,
    policy: Mapping[str, str] | None = None,
    owners: Sequence[str] = (),
    principal: str | Column | None = None,
) -> DataFrame:
    """Masked projection (P15): for non-owners ``pii_name`` -> initial + ``***``,
    ``pii_birth_date`` -> 1 January of its year; identifiers are rendered as
    text; NULL stays NULL; owners see clear values; other columns unchanged.

    ``policy`` maps column -> classification; default: the columns' metadata.
    """
    policy = dict(classification_of(df) if policy is None else policy)
    owner = is_principal(owners, principal)
    out = []
    for n in df.columns:
        label = policy.get(n)
        if label == PII_NAME:
            out.append(F.when(owner, c(n)).otherwise(fx.mask_initial(c(n))).alias(n))
        elif label == PII_BIRTH_DATE:
            out.append(F.when(owner, c(n)).otherwise(fx.generalise_to_year(c(n))).alias(n))
        elif label == IDENTIFIER and n.endswith("_key"):
            out.append(c(n).cast("string").alias(n))
        else:
            out.append(c(n))
    return df.select(*out)


_TABLE_SCHEMA = StructType(
    [StructField(n, StringType(), n != "table_name") for n in ("table_name", "layer", "domain", "classification", "table_type", "comment")]
    + [StructField("row_count", LongType(), False), StructField("column_count", LongType(), False)]
)


def _catalog_type(spark: SparkSession, name: str) -> str | None:
    """What the session's catalog says the name is (MANAGED, EXTERNAL, VIEW, TEMPORARY); None for a name it does not hold."""
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def table_inventory(
    spark: SparkSession, tables: Mapping[str, DataFrame], comments: Mapping[str, str] | None = None,
    catalog_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Name, labels, type, comment and **row count** of every table: a union of
    one-row aggregates, one scan per table (M1).

    Labels and comment come from ``label_table`` (``comments`` overrides; the
    layer falls back to the name's prefix before ``_``). The type is the
    catalog's for tables named in ``catalog_names`` (name -> catalog name)
    and NULL for bare DataFrames.
    """
    comments, catalog_names = comments or {}, catalog_names or {}
    rows = []
    for name, df in tables.items():
        labels = table_labels(df)
        layer = labels.get("layer") or (name.split("_", 1)[0] if "_" in name else None)
        kind = _catalog_type(spark, catalog_names[name]) if name in catalog_names else None
        text = lambda v, n: F.lit(v).cast("string").alias(n)
        rows.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                text(layer, "layer"),
                text(labels.get("domain"), "domain"),
                text(labels.get("classification"), "classification"),
                text(kind, "table_type"),
                text(comments.get(name, labels.get("comment")), "comment"),
                F.col("row_count").cast("long").alias("row_count"),
                F.lit(len(df.columns)).cast("long").alias("column_count"),
            )
        )
    if not rows:
        return spark.createDataFrame([], _TABLE_SCHEMA)
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def column_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: position, type, nullability, comment, classification
    and the column's NULL count from a single aggregation per table (M2)."""
    def lit(v):
        return "CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    parts = []
    for name, df in tables.items():
        m = table_metrics(df)
        entries = ", ".join(
            f"named_struct('ordinal_position', {i + 1}, 'column_name', {lit(f.name)}, "
            f"'data_type', {lit(f.dataType.simpleString())}, 'is_nullable', {lit('YES' if f.nullable else 'NO')}, "
            f"'comment', {lit((f.metadata or {}).get('comment'))}, "
            f"'classification', {lit((f.metadata or {}).get('classification'))}, 'null_count', {null_alias(i)})"
            for i, f in enumerate(df.schema.fields)
        )
        parts.append(
            m.selectExpr(f"{ROWS} AS row_count", f"inline(array({entries}))").select(
                F.lit(name).alias("table_name"),
                "column_name",
                "ordinal_position",
                "data_type",
                "is_nullable",
                "comment",
                "classification",
                "row_count",
                "null_count",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def register_masked_view(df: DataFrame, name: str, owners: Sequence[str], policy: Mapping[str, str] | None = None) -> str:
    """Create or replace a temporary view of ``df`` masked for everyone but
    ``owners`` (K9, P15). The owner test uses ``session_user()`` and runs
    each time the view is queried, so the view never freezes an identity."""
    mask_columns(df, policy, owners, principal=None).createOrReplaceTempView(name)
    return name
