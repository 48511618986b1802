"""DataFrame -> DataFrame operators."""

from layercake.operators.batches import assign_batches, global_row_number, unreleased_batches
from layercake.operators.dedupe import dedupe, dedupe_latest
from layercake.operators.governance import (
    classify_columns,
    column_inventory,
    mask_columns,
    register_masked_view,
    table_inventory,
)
from layercake.operators.integrity import orphan_rows, orphan_rows_filtered
from layercake.operators.profile import (
    completeness,
    exact_duplicates,
    key_duplicates,
    null_profile,
    reconcile,
    rule_violations,
)
from layercake.operators.rules import (
    date_default_format,
    fill_nulls,
    null_future_dates,
    regex_rules,
    rename_strict,
    require_columns,
    require_not_null,
    safe_cast,
    safe_date,
    split_key,
    trim_nullify,
    value_map,
)
from layercake.operators.scan import pattern_hits, scan_patterns
from layercake.operators.versions import derive_end_date, flag_overlaps, overlapping_versions, version_misses
from layercake.operators.segments import PLAIN, Skew
