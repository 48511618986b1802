"""Table and file sinks (K1, K2, K6, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish_table(
    df: DataFrame,
    name: str,
    check_schema: bool = False,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> str:
    """Full overwrite of a catalog table (K1). A ``schema.table`` name creates
    the schema if absent (K7). ``check_schema=True`` refuses to replace an
    existing table whose schema differs (K2)."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if check_schema and spark.catalog.tableExists(name):
        old = spark.table(name).schema
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"Schema of {name} would change")
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


#: CSV options under which text survives a round trip unchanged: line breaks, padding, quotes, '' and NULL.
#: The null mark is a control character that stands alone in a field; give both to writers and readers.
LOSSLESS_CSV = {
    "header": "true", "quoteAll": "true", "escape": '"', "multiLine": "true", "nullValue": "\u0001", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_batches(df: DataFrame, path: str, batch_col: str = "batch_id") -> str:
    """Export numbered batches (K6): ``<path>/data``, parquet with one folder a
    batch, all columns as text, and ``<path>/manifest``, one row a batch
    (``batch_id``, ``rows``), which ``release_batch`` picks from."""
    out = df.select(*[df[c].cast("string").alias(c) if c != batch_col else df[c] for c in df.columns])
    out.write.mode("overwrite").partitionBy(batch_col).parquet(f"{path}/data")
    stored = df.sparkSession.read.parquet(f"{path}/data")  # the counts come from footers
    stored.groupBy(batch_col).agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/manifest")
    return path


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The exported rows, with their batch column."""
    return spark.read.parquet(f"{path}/data")
