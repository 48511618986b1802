"""Operators applied to the driver test tables (queries + SQL oracles)."""
