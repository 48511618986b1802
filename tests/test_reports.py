import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from layercake.operators import completeness, exact_duplicates, key_duplicates, null_profile, reconcile, rule_violations
from layercake.plans.checks import Overlap, Reference, Suite, quality_report, report_summary
from layercake.plans.reports import LayerPair, layer_report, profile_report


def products_like(spark):
    # 397 rows x 7 columns; NULL cost 2, NULL line 17, NULL end 197 (216 NULLs)
    data = []
    for i in range(397):
        data.append((str(i), f"CO-RF-K{i}", f"name {i}", None if i < 2 else "10", None if i < 17 else "R",
                     "2011-07-01", None if i < 197 else "2007-12-28"))
    return spark.createDataFrame(data, "prd_id string, prd_key string, prd_nm string, prd_cost string, "
                                       "prd_line string, prd_start_dt string, prd_end_dt string")


def test_raw_profile_golden_numbers(spark):
    cats = spark.createDataFrame([("AC_BR", "Accessories", "Bike Racks", "Yes")] * 37,
                                 "ID string, CAT string, SUBCAT string, MAINTENANCE string")
    rep = profile_report({"bronze_crm_prd_info": products_like(spark), "bronze_erp_px_cat_g1v2": cats,
                          "bronzeXother": cats}, prefix="bronze_").collect()
    assert [r.table_name for r in rep] == ["bronze_crm_prd_info", "bronze_erp_px_cat_g1v2"]
    p, c = rep
    assert (p.row_count, p.column_count, p.total_null_values, p.columns_with_nulls) == (397, 7, 216, 3)
    assert p.completeness_percentage == 92.2274
    assert json.loads(p.null_details) == {"prd_cost": 2, "prd_end_dt": 197, "prd_line": 17}
    assert p.null_details == '{"prd_cost": 2, "prd_end_dt": 197, "prd_line": 17}'
    assert (c.row_count, c.total_null_values, c.completeness_percentage, c.null_details) == (37, 0, 100.0, "{}")


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "a string, b int")
    comp = completeness(empty, "t").first()
    assert (comp.row_count, comp.completeness_percentage) == (0, 100.0)
    prof = null_profile(empty, "t").collect()
    assert [(r.null_count, r.null_percentage) for r in prof] == [(0, 0.0), (0, 0.0)]
    rep = quality_report({"t": empty}, {"t": Suite(keys=("a",), required=("a", "b"), rules={"neg": "b < 0"})})
    got = {r.check_name: (r.total_rows, r.failed_rows, r.pass_percentage, r.status) for r in rep.collect()}
    assert got["table_not_empty"] == (1, 1, 0.0, "FAIL")
    assert got["required_not_null:a"] == (0, 0, 100.0, "PASS")
    assert got["unique_key:a"] == (0, 0, 100.0, "PASS")
    assert got["neg"][3] == "PASS"


def test_exact_and_key_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (None, None), (2, 3)], "k int, v int")
    e = exact_duplicates(df, "t").first()
    assert (e.total_rows, e.distinct_rows, e.exact_duplicate_rows) == (5, 3, 2)
    k = key_duplicates(df, ["k"], "t").first()
    assert (k.duplicate_key_groups, k.duplicate_key_rows) == (2, 2)
    none = key_duplicates(df, [], "t").first()
    assert (none.duplicate_key_groups, none.duplicate_key_rows) == (0, 0)


def test_rule_violations_null_counts_as_pass(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 2), dt.date(2020, 1, 1)), (2, None, dt.date(2020, 1, 1)),
                                (0, dt.date(2020, 1, 1), dt.date(2020, 1, 1))], "q int, ship date, ord date")
    out = {r.rule_name: r.failed_rows for r in rule_violations(
        df, {"ship_before_order": F.col("ship") < F.col("ord"), "non_positive_quantity": F.col("q") <= 0}, "t"
    ).collect()}
    assert out == {"ship_before_order": 0, "non_positive_quantity": 1}


def test_reconcile(spark):
    src = spark.range(10)
    r = reconcile(src, src.filter("id > 3"), "t").first()
    assert (r.source_row_count, r.row_count, r.rows_removed) == (10, 6, 4)


def test_quality_report_checks_and_status(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, name string")
    fact = spark.createDataFrame([(1, 5), (3, -1), (None, 2)], "cid int, amount int")
    versions = spark.createDataFrame([("k", dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
                                      ("k", dt.date(2020, 6, 1), None)], "key string, s date, e date")
    suites = {
        "dim": Suite(keys=("id",), required=("id", "name")),
        "fact": Suite(required=("cid",), rules={"negative_amount": "amount < 0"},
                      references=(Reference("cid", "dim", "id", "dim_reference"),
                                  Reference("cid", "dim", "id", "dim_reference_non_null", ignore_null_keys=True)),
                      warn_only=frozenset({"negative_amount"})),
        "versions": Suite(overlaps=(Overlap("key", "s", "e"),)),
        "gone": Suite(),
    }
    rep = quality_report({"dim": dim, "fact": fact, "versions": versions, "gone": None}, suites)
    assert rep.columns == ["table_name", "check_name", "check_type", "columns_checked", "total_rows", "failed_rows",
                           "pass_percentage", "status", "details"]
    got = {(r.table_name, r.check_name): r for r in rep.collect()}
    assert got[("dim", "exact_duplicate_rows")].failed_rows == 1
    assert got[("dim", "exact_duplicate_rows")].columns_checked == '["id", "name"]'
    assert got[("dim", "unique_key:id")].failed_rows == 1
    assert got[("dim", "table_exists")].details == "Table exists with 3 rows."
    assert got[("fact", "dim_reference")].failed_rows == 2  # 3 and NULL
    assert got[("fact", "dim_reference")].pass_percentage == 33.333
    assert got[("fact", "dim_reference_non_null")].failed_rows == 1
    assert got[("fact", "negative_amount")].status == "WARN"
    assert got[("versions", "validity_overlap")].failed_rows == 1
    assert (got[("gone", "table_exists")].status, got[("gone", "table_exists")].details) == (
        "FAIL", "Table not found: gone")
    s = report_summary(rep).first()
    assert s.checks == len(got) and s.warnings == 1 and s.failures >= 4


def test_quality_report_missing_configured_column_raises(spark):
    with pytest.raises(ValueError, match="missing"):
        quality_report({"t": spark.range(1)}, {"t": Suite(required=("nope",))})


def test_layer_report_columns(spark):
    raw = spark.createDataFrame([("1", None), ("1", "x"), ("2", "y")], "id string, v string")
    cleaned = raw.dropDuplicates(["id"]).withColumnRenamed("id", "key")
    rep = layer_report([LayerPair("raw_t", raw, "clean_t", cleaned, ["key"])]).first()
    assert rep.source_row_count == 3 and rep.row_count == 2 and rep.rows_removed == 1
    assert rep.dedupe_keys == '["key"]' and rep.duplicate_key_groups == 0
    assert len(rep) == 14


def test_profile_report_error_row_and_hybrid_variant(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), ("y", 3)], "a string, b int")
    rep = {r.table_name: r for r in profile_report({"raw_t": df, "raw_gone": None}, prefix="raw_",
                                                   digits=2, empty=0.0, details="repr").collect()}
    assert rep["raw_gone"].row_count is None and rep["raw_gone"].null_details == "Error: table not found"
    assert rep["raw_t"].completeness_percentage == 66.67
    assert rep["raw_t"].null_details == "{'a': 1, 'b': 1}"
    empty = profile_report({"e": spark.createDataFrame([], "a string")}, digits=2, empty=0.0).first()
    assert empty.completeness_percentage == 0.0


def test_exact_duplicates_equal_full_distinct(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select((F.col("id") % 700).alias("a"),
                                  F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5).alias("b"),
                                  F.when(F.col("id") % 13 == 0, None).otherwise(F.lit("x")).alias("s"))
    for t in (df, df.union(df), df.select(F.lit(1).alias("x")), df.limit(0)):
        got = exact_duplicates(t, "t").first()
        assert (got.total_rows, got.distinct_rows) == (t.count(), t.distinct().count())
    nulls = spark.createDataFrame([(1, None), (None, 1), (None, 1)], "a int, b int")
    assert exact_duplicates(nulls, "t").first().exact_duplicate_rows == 1


def test_quality_report_counts_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "id int, v string")
    report = rows(quality_report({"t": df}, {"t": Suite(keys=("id",), required=("v",))}))
    assert [r[5] for r in report if r[1] == "exact_duplicate_rows"] == [2]


def test_layer_report_counts_exact_duplicates(spark):
    raw = spark.createDataFrame([("1", None), ("1", None), ("2", "y"), (None, None)], "id string, v string")
    row = layer_report([LayerPair("raw_t", raw, "clean_t", raw, ["id"])]).first()
    assert row.exact_duplicate_rows == 1


def test_masked_view_checks_the_session_user_at_query_time(spark):
    import datetime as dt

    from layercake.operators.governance import CUSTOMER_COLUMN_METADATA, classify_columns, register_masked_view

    me = spark.sql("SELECT session_user() AS u").first().u
    df = classify_columns(spark.createDataFrame([(1, "Ann", dt.date(1990, 5, 6))],
                                                "customer_id int, firstname string, birth_date date"),
                          CUSTOMER_COLUMN_METADATA)
    register_masked_view(df, "lc_secure_other", owners=["someone_else"])
    register_masked_view(df, "lc_secure_mine", owners=[me])
    masked = spark.table("lc_secure_other").first()
    clear = spark.table("lc_secure_mine").first()
    assert (masked.firstname, masked.birth_date) == ("A***", dt.date(1990, 1, 1))
    assert (clear.firstname, clear.birth_date) == ("Ann", dt.date(1990, 5, 6))


def test_seven_column_cleaned_layer_variant(spark):
    import json

    df = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "y")], "id int, v string")
    rep = profile_report({"silver_t": df, "silver_diagnostics": df}, prefix="silver_", details="shares")
    row = [r for r in rep.collect() if r.table_name == "silver_t"][0]
    assert json.loads(row.null_details) == {"v": {"null_count": 2, "null_percentage": 50.0}}
    assert row.null_details == '{"v": {"null_count": 2, "null_percentage": 50.0}}'
