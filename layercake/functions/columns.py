"""Column-expression builders. Everything here returns a ``Column`` made of
Spark built-ins, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source pipeline's behaviour.
# Composite product key: two 2-character groups, then the business key,
# e.g. CO-RF-FR-R92B-58 -> category CO_RF, key FR-R92B-58.
KEY_PREFIX_CAPTURE = r"^([A-Za-z0-9]{2}-[A-Za-z0-9]{2})-"
KEY_PREFIX_STRIP = r"^[A-Za-z0-9]{2}-[A-Za-z0-9]{2}-"
# Customer-key normalisation: CRM keys drop "AW"/"AW-", ERP keys also "NAS".
CRM_CUSTOMER_KEY_PREFIX = r"(?i)^AW-?"
ERP_CUSTOMER_KEY_PREFIX = r"(?i)^(NAS)?AW-?"
MASK_SUFFIX = "***"


def quoted(name: str) -> str:
    """Back-quote a column name so dots, spaces and back-quotes survive."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column reference that is safe for any column name."""
    return F.col(quoted(name))


def trim_nullify(col: Column) -> Column:
    """Trim spaces; an empty result becomes NULL (tabs/NBSP are kept)."""
    return F.nullif(F.trim(col), F.lit(""))


def regex_chain(col: Column, replacements) -> Column:
    """Apply ordered (pattern, replacement) pairs, each replacing all matches."""
    for pattern, replacement in replacements:
        col = F.regexp_replace(col, F.lit(pattern), F.lit(replacement))
    return col


def normalise_mapping(mapping: Mapping) -> dict:
    """Keys compared as ``lower(trim(key))``; on collisions the later entry wins."""
    out: dict = {}
    for source, target in mapping.items():
        out[str(source).strip().lower()] = target
    return out


def value_map(col: Column, mapping: Mapping) -> Column:
    """Categorical map on ``lower(trim(col))``; unmatched values pass through."""
    table = normalise_mapping(mapping)
    if not table:
        return col
    key = F.lower(F.trim(col))
    lookup = F.create_map(*[x for kv in table.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.when(F.map_contains_key(lookup, key), F.try_element_at(lookup, key)).otherwise(col)


def safe_cast(col: Column, dtype: str) -> Column:
    """Error-free cast: unparsable values become NULL."""
    return col.try_cast(dtype)


def safe_date(col: Column, fmt: str | None = None) -> Column:
    """Error-free date parse of the value's text, with an optional pattern."""
    text = col.cast("string")
    return F.try_to_date(text, fmt) if fmt else F.try_to_date(text)


def as_of_date(as_of) -> Column:
    """``as_of`` may be None (today), a date/str literal or a Column."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of).cast("date")
    return F.to_date(F.lit(str(as_of)))


def null_if_future(col: Column, as_of=None) -> Column:
    """Dates after ``as_of`` become NULL; NULL stays NULL."""
    return F.when(col > as_of_date(as_of), F.lit(None).cast("date")).otherwise(col)


def key_category(key: Column) -> Column:
    """``XX-YY-rest`` -> ``XX_YY`` upper-cased; no prefix -> NULL."""
    prefix = F.regexp_extract(F.trim(key), KEY_PREFIX_CAPTURE, 1)
    return F.when(F.length(prefix) > 0, F.upper(F.regexp_replace(prefix, "-", "_")))


def key_remainder(key: Column) -> Column:
    """``XX-YY-rest`` -> ``rest``; keys without the prefix are only trimmed."""
    return F.regexp_replace(F.trim(key), KEY_PREFIX_STRIP, "")


def date_or_default(col: Column, fmt: str | None, default: str, out_fmt: str) -> Column:
    """Legacy date rule: parse, fall back to a default date, render as text."""
    parsed = safe_date(col, fmt)
    return F.date_format(F.coalesce(parsed, F.to_date(F.lit(default))), out_fmt)


def mask_initial(col: Column) -> Column:
    """First character followed by the mask suffix; NULL stays NULL."""
    return F.when(col.isNotNull(), F.concat(F.substring(col, 1, 1), F.lit(MASK_SUFFIX)))


def generalise_to_year(col: Column) -> Column:
    """A date becomes 1 January of its year; NULL stays NULL."""
    return F.make_date(F.year(col), F.lit(1), F.lit(1))


def pass_percentage(total: Column, failed: Column, digits: int = 3) -> Column:
    """Share of passing rows in percent, rounded half-up; empty -> 100 or 0."""
    ratio = F.round(F.lit(100.0) * (total - failed).cast("double") / total.cast("double"), digits)
    return (
        F.when(total == 0, F.when(failed == 0, F.lit(100.0)).otherwise(F.lit(0.0)))
        .otherwise(ratio)
        .cast("double")
    )


def check_status(failed: Column, warn_only: Column | bool = False) -> Column:
    """PASS when nothing failed, else WARN (warn-only checks) or FAIL."""
    warn = warn_only if isinstance(warn_only, Column) else F.lit(bool(warn_only))
    return F.when(failed == 0, F.lit("PASS")).when(warn, F.lit("WARN")).otherwise(F.lit("FAIL"))
