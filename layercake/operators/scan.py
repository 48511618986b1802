"""Secret-pattern scan over a text table (M3).

Each pattern is a Java regex evaluated with ``rlike`` on the whole text of
every row, so the scan is a single pass that parallelises with the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c

# The repository-validator patterns (platform personal access
# token, cloud access key id, PEM private-key header), plus an assignment of a
# 40-hex-digit token as it appears in the text tables.
SECRET_PATTERNS = {
    "platform_token": r"\bdapi[a-zA-Z0-9]{20,}\b",
    "cloud_access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "hex_token_assignment": r"token\s*=\s*\"[0-9a-f]{40}\"",
}


def flag_patterns(df: DataFrame, text_col: str, patterns: Mapping[str, str] = SECRET_PATTERNS) -> DataFrame:
    """Add one boolean column ``hit_<label>`` per pattern."""
    return df.select(
        *[c(n) for n in df.columns],
        *[F.coalesce(c(text_col).rlike(p), F.lit(False)).alias(f"hit_{label}") for label, p in patterns.items()],
    )


def pattern_hits(df: DataFrame, text_col: str, id_col: str, patterns: Mapping[str, str] = SECRET_PATTERNS) -> DataFrame:
    """Long form (id, pattern) for every row matching a pattern."""
    labels = list(patterns)
    flagged = flag_patterns(df.select(c(id_col), c(text_col)), text_col, patterns)
    hits = F.array(*[F.when(c(f"hit_{lb}"), F.lit(lb)) for lb in labels])
    return flagged.select(c(id_col), F.explode(F.array_compact(hits)).alias("pattern_name"))


def scan_patterns(df: DataFrame, text_col: str, patterns: Mapping[str, str] = SECRET_PATTERNS) -> DataFrame:
    """Per pattern: rows scanned and rows matching, from one aggregation."""
    labels = list(patterns)
    flagged = flag_patterns(df.select(c(text_col)), text_col, patterns)
    agg = flagged.agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        *[F.count_if(c(f"hit_{lb}")).alias(f"n_{i}") for i, lb in enumerate(labels)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(lb).alias("pattern_name"), F.lit(patterns[lb]).alias("pattern"), F.col(f"n_{i}").alias("matching_rows"))
            for i, lb in enumerate(labels)
        ]
    )
    return agg.select("rows_scanned", F.inline(entries)).select("pattern_name", "pattern", "rows_scanned", "matching_rows")
