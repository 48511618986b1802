"""Composite plans: cleaning specs, star builds, reports, layer chains."""

from layercake.plans.checks import Overlap, Reference, Suite, VersionMatch, quality_report, report_summary
from layercake.plans.reports import LayerPair, layer_report, profile_report
from layercake.plans.spec import TableSpec, clean
from layercake.plans.star import Lookup, build_dimension, build_fact
from layercake.plans.legacy import LEGACY_SPECS, LegacySpec, clean_legacy
