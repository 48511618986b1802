import datetime as dt

import pytest

from conftest import rows
from layercake.functions.columns import CRM_CUSTOMER_KEY_PREFIX, ERP_CUSTOMER_KEY_PREFIX
from layercake.operators import rules


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


def test_trim_nullify_blanks_and_spaces_only(spark):
    df = spark.createDataFrame([(" a ", 1), ("", 2), ("   ", 3), ("\tb", 4), (None, 5)], "s string, n int")
    out = dict((r.n, r.s) for r in rules.trim_nullify(df).collect())
    assert out == {1: "a", 2: None, 3: None, 4: "\tb", 5: None}
    kept = dict((r.n, r.s) for r in rules.trim_nullify(df, nullify=False).collect())
    assert kept[2] == "" and kept[3] == ""


def test_crm_and_erp_key_normalisation(spark):
    df = one_col(spark, ["AW00011000", "aw-00011000", "NASAW00011000", "AW-00011000"], "k")
    crm = rules.regex_rules(df.limit(2), {"k": [(CRM_CUSTOMER_KEY_PREFIX, "")]})
    erp = rules.regex_rules(df, {"k": [(ERP_CUSTOMER_KEY_PREFIX, "")]})
    assert {r.k for r in crm.collect()} == {"00011000"}
    assert {r.k for r in erp.collect()} == {"00011000"}


def test_regex_missing_column_raises(spark):
    with pytest.raises(ValueError, match="missing"):
        rules.regex_rules(one_col(spark, ["x"]), {"nope": [("a", "b")]})


def test_value_map_rules(spark):
    df = one_col(spark, [" m ", "FEMALE", "x", "", None], "g")
    out = rules.value_map(rules.trim_nullify(df), {"g": {"M": "Male", "F": "Female", "Male": "Male", "Female": "Female"}})
    out = rules.fill_nulls(out, {"g": "missing"})
    assert sorted(r.g for r in out.collect()) == sorted(["Male", "Female", "x", "missing", "missing"])


def test_value_map_last_mapping_wins_and_large_maps(spark):
    df = one_col(spark, ["m", "k7", "zz"], "g")
    out = rules.value_map(df, {"g": {"M": "first", " m ": "second"}})
    assert [r.g for r in out.collect()][0] == "second"
    big = {f"k{i}": f"v{i}" for i in range(100)}
    out = rules.value_map(df, {"g": big})
    assert sorted(r.g for r in out.collect()) == ["m", "v7", "zz"]


def test_country_map(spark):
    df = one_col(spark, ["DE", "us", "USA", "France", " "], "c")
    out = rules.value_map(rules.trim_nullify(df), {"c": {"DE": "Germany", "US": "United States", "USA": "United States"}})
    out = rules.fill_nulls(out, {"c": "missing"})
    assert sorted(r.c for r in out.collect()) == sorted(
        ["Germany", "United States", "United States", "France", "missing"])


def test_safe_date_with_pattern(spark):
    df = one_col(spark, ["20110103", "0", "5489", "20111301", None], "d")
    out = rules.safe_date(df, {"d": "yyyyMMdd"}).collect()
    assert [r.d for r in out] == [dt.date(2011, 1, 3), None, None, None, None]


def test_safe_date_default_rules(spark):
    df = one_col(spark, ["2011", "2011-1-3", "2011-01-03 10:00:00", "nope"], "d")
    out = [r.d for r in rules.safe_date(df, {"d": None}).collect()]
    assert out == [dt.date(2011, 1, 1), dt.date(2011, 1, 3), dt.date(2011, 1, 3), None]


def test_safe_cast_int(spark):
    df = one_col(spark, ["12", " 7 ", "12.7", "abc", None, "+5", "1e2"], "n")
    out = [r.n for r in rules.safe_cast(df, {"n": "int"}).collect()]
    assert out == [12, 7, None, None, None, 5, None]


def test_split_key(spark):
    df = one_col(spark, ["CO-RF-FR-R92B-58", "ABC", " co-rf-X "], "prd_key")
    out = rules.split_key(df, "prd_key")
    assert out.columns == ["prd_key", "category_id"]
    assert rows(out) == rows(spark.createDataFrame(
        [("FR-R92B-58", "CO_RF"), ("ABC", None), ("X", "CO_RF")], "prd_key string, category_id string"))


def test_null_future_dates(spark):
    today = dt.date(2024, 5, 1)
    df = spark.createDataFrame([(today + dt.timedelta(days=1),), (None,), (today,)], "d date")
    out = [r.d for r in rules.null_future_dates(df, ["d"], as_of=today).collect()]
    assert out == [None, None, today]


def test_fill_nulls_ignores_absent_and_mismatched(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    out = rules.fill_nulls(df, {"a": "missing", "b": "oops", "zz": 1}).first()
    assert out.a == "missing" and out.b is None


def test_require_not_null_and_contracts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, k string")
    assert rules.require_not_null(df, []).count() == 3
    assert [r.id for r in rules.require_not_null(df, ["id", "k"]).collect()] == [1]
    with pytest.raises(ValueError):
        rules.require_not_null(df, ["nope"])


def test_rename_strict_keeps_order_and_raises(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    assert rules.rename_strict(df, {"c": "z", "a": "x"}).columns == ["x", "b", "z"]
    with pytest.raises(ValueError, match="missing"):
        rules.rename_strict(df, {"cst_gender": "gender"})


def test_legacy_date_default_format(spark):
    df = one_col(spark, ["20110103", "bad", None], "order_dt")
    out = [r.order_dt for r in rules.date_default_format(df, fmt="yyyyMMdd").collect()]
    assert out == ["03/01/2011", "01/01/2000", "01/01/2000"]


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(" x ", "2011-01-03")], "`a.b` string, `my col` string")
    out = rules.safe_date(rules.trim_nullify(df), {"my col": None})
    out = rules.rename_strict(out, {"a.b": "ab"})
    r = out.first()
    assert r.ab == "x" and r["my col"] == dt.date(2011, 1, 3)
