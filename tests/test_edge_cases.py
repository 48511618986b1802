"""Edge cases every operator must survive: empty input, a single row, an
all-NULL column, NULL keys, names needing back-quotes, several partitions."""

import datetime as dt

import pytest

from layercake.operators import (
    completeness,
    dedupe,
    derive_end_date,
    exact_duplicates,
    key_duplicates,
    null_profile,
    orphan_rows,
    overlapping_versions,
    rule_violations,
    version_misses,
)
from layercake.operators.batches import assign_batches
from layercake.plans.checks import Overlap, Suite, quality_report

SCHEMA = "`the key` string, `start.date` date, `end date` date, v int"


def frames(spark):
    d = dt.date(2020, 1, 1)
    return {
        "empty": spark.createDataFrame([], SCHEMA),
        "single": spark.createDataFrame([("a", d, None, 1)], SCHEMA),
        "all_null": spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA),
        "null_keys": spark.createDataFrame([(None, d, None, 1), (None, d, None, 2), ("b", d, d, 3)], SCHEMA).repartition(3),
    }


@pytest.mark.parametrize("case", ["empty", "single", "all_null", "null_keys"])
def test_operators_on_edge_inputs(spark, case):
    df = frames(spark)[case]
    n = df.count()
    assert dedupe(df, ["the key"], [("start.date", "desc")]).count() == df.select("`the key`").distinct().count()
    assert derive_end_date(df, "the key", "start.date", "end date", tie=["v"]).count() == n
    assert overlapping_versions(df, "the key", "start.date", "end date", "any", ["v"]).count() <= n
    assert version_misses(df, df, "the key", "start.date", "start.date", "end date").count() <= n
    assert orphan_rows(df, df, "the key").count() == df.filter("`the key` IS NULL").count()
    prof = null_profile(df, "t").collect()
    assert [r.null_count for r in prof] == [df.filter(f"`{c}` IS NULL").count() for c in df.columns]
    assert completeness(df, "t").first().row_count == n
    assert exact_duplicates(df, "t").first().total_rows == n
    assert key_duplicates(df, ["the key"], "t").first().total_rows == n
    assert {r.rule_name for r in rule_violations(df, {"neg": df["v"] < 0}, "t").collect()} == {"neg"}
    assert assign_batches(df, ["start.date", "v"], [1]).count() == n
    rep = quality_report({"t": df}, {"t": Suite(keys=("the key",), required=("the key", "v"),
                                                 rules={"neg": "v < 0"},
                                                 overlaps=(Overlap("the key", "start.date", "end date"),))})
    got = {r.check_name: r for r in rep.collect()}
    assert got["table_not_empty"].status == ("FAIL" if n == 0 else "PASS")
    assert got["required_not_null:the key"].failed_rows == df.filter("`the key` IS NULL").count()
