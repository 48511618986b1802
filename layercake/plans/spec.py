"""Declarative cleaning spec and ``clean``.

``clean`` turns a raw table into a cleaned one with the fixed rule order:

    trim/nullify -> regex -> transforms_before -> value maps -> dates -> casts
    -> transforms_after -> fill -> dedupe -> required -> rename

Every stage is one projection or filter on the same lazy plan; the only
shuffles are the dedupe window and windows inside named transforms. Column
contracts are checked eagerly (analysis only, no job).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from layercake.operators import rules
from layercake.operators.dedupe import dedupe
from layercake.operators.versions import derive_end_date

Transform = Callable[..., DataFrame]


def _split_product_key(df: DataFrame, as_of=None) -> DataFrame:
    return rules.split_key(df, "prd_key", "category_id")


def _derive_product_end_date(df: DataFrame, as_of=None) -> DataFrame:
    tie = [n for n in ("prd_id",) if n in df.columns]
    return derive_end_date(df, "prd_key", "prd_start_dt", "prd_end_dt", tie=tie)


def _validate_birth_date(df: DataFrame, as_of=None) -> DataFrame:
    return rules.null_future_dates(df, ["BDATE"], as_of)


NAMED_TRANSFORMS: dict[str, Transform] = {
    "split_product_key": _split_product_key,
    "derive_product_end_date": _derive_product_end_date,
    "validate_birth_date": _validate_birth_date,
}


@dataclass(frozen=True)
class TableSpec:
    """Cleaning rules for one table (C2 holds the six source specs)."""

    target: str = ""
    keys: tuple[str, ...] = ()
    order_by: tuple[tuple[str, str], ...] = ()
    regex: Mapping[str, tuple[tuple[str, str], ...]] = field(default_factory=dict)
    transforms_before: tuple[str | Transform, ...] = ()
    value_maps: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    dates: Mapping[str, str | None] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    transforms_after: tuple[str | Transform, ...] = ()
    fill: Mapping[str, object] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    # options for the two ordering defects of the source pipeline
    required_first: bool = False
    dedupe_first: bool = False

    def renamed_keys(self) -> list[str]:
        """Dedupe keys under their output names."""
        return [self.rename.get(k, k) for k in self.keys]

    @classmethod
    def from_config(cls, config: Mapping) -> "TableSpec":
        """Build a spec from a cleaning-rule dictionary with the keys
        ``target``, ``dedupe`` (``keys``, ``order_by``), ``regex_replace``,
        ``special_transform``, ``value_maps``, ``dates``, ``casts``,
        ``post_transform``, ``fillna``, ``required`` and ``rename``."""
        dedupe_cfg = config.get("dedupe") or {}
        special = config.get("special_transform")
        post = config.get("post_transform")
        return cls(
            target=config.get("target", ""),
            keys=tuple(dedupe_cfg.get("keys", ())),
            order_by=tuple((c, d) for c, d in dedupe_cfg.get("order_by", ())),
            regex={k: tuple(tuple(r) for r in v) for k, v in (config.get("regex_replace") or {}).items()},
            transforms_before=(special,) if special else (),
            value_maps=dict(config.get("value_maps") or {}),
            dates=dict(config.get("dates") or {}),
            casts=dict(config.get("casts") or {}),
            transforms_after=(post,) if post else (),
            fill=dict(config.get("fillna") or {}),
            required=tuple(config.get("required") or ()),
            rename=dict(config.get("rename") or {}),
        )


def _apply(df: DataFrame, transforms, as_of) -> DataFrame:
    for t in transforms:
        if isinstance(t, str):
            if t not in NAMED_TRANSFORMS:
                raise ValueError(f"Unknown transform: {t}")
            t = NAMED_TRANSFORMS[t]
        df = t(df, as_of)
    return df


def _dedupe(df: DataFrame, spec: TableSpec) -> DataFrame:
    # A key that is also required and NULL only forms groups whose rows are
    # dropped later anyway: filter those rows right before the window so NULL
    # keys never pile up in one task. Other groups are unaffected.
    guard = [k for k in spec.keys if k in spec.required]
    if guard and not spec.required_first:
        df = rules.require_not_null(df, guard)
    return dedupe(df, spec.keys, spec.order_by)


def clean(df: DataFrame, spec: TableSpec, as_of=None) -> DataFrame:
    """Raw -> cleaned table as one lazy plan (no action)."""
    df = rules.trim_nullify(df)
    df = rules.regex_rules(df, spec.regex)
    df = _apply(df, spec.transforms_before, as_of)
    df = rules.value_map(df, spec.value_maps)
    df = rules.safe_date(df, spec.dates)
    df = rules.safe_cast(df, spec.casts)
    if spec.required_first:
        df = rules.require_not_null(df, spec.required)
    if spec.dedupe_first:
        df = rules.fill_nulls(df, spec.fill)
        df = _dedupe(df, spec)
        df = _apply(df, spec.transforms_after, as_of)
    else:
        df = _apply(df, spec.transforms_after, as_of)
        df = rules.fill_nulls(df, spec.fill)
        df = _dedupe(df, spec)
    if not spec.required_first:
        df = rules.require_not_null(df, spec.required)
    return rules.rename_strict(df, spec.rename)
