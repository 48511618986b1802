import datetime as dt

from conftest import rows

from layercake.plans.catalog import RAW_SCHEMAS, SPECS
from layercake.plans.layers import run_batch
from layercake.plans.spec import clean

D = dt.date


def raw_sources(spark):
    def df(name, data):
        return spark.createDataFrame(data, RAW_SCHEMAS[name])

    return {
        "cust_info": df("cust_info", [
            ("11000", "AW00011000", " Ann ", "Lee", "M", "F", "2025-01-01"),
            ("11000", "AW00011000", "Ann", "Lee", "S", "F", "2025-02-01"),
            ("11000", "AW00011000", "Ann", "Lee", "M", "F", None),
            ("11001", "aw-00011001", "Bo", "Ng", "", " m ", "2024-03-03"),
            (None, "AW00011002", "No", "Id", "S", "M", "2024-01-01"),
            ("abc", "AW00011003", "Bad", "Id", "S", "M", "2024-01-01"),
        ]),
        "cust_az12": df("cust_az12", [
            ("NASAW00011000", "1990-05-06", "FEMALE"),
            ("AW-00011001", "2999-01-01", "x"),
        ]),
        "loc_a101": df("loc_a101", [("AW-00011000", "DE"), ("AW00011001", " ")]),
        "prd_info": df("prd_info", [
            ("210", "CO-RF-FR-R92B-58", "Frame", "", "R ", "2011-07-01", "2007-12-28"),
            ("211", "CO-RF-FR-R92B-58", "Frame", "12", "R ", "2012-07-01", None),
            ("212", "CO-RF-FR-R92B-58", "Frame", "13", "R ", "2013-07-01", None),
            ("213", "CO-PE-PE-1", "Pedal", "5", "", "2011-07-01", None),
            ("214", "ABC", "Odd", "abc", "M", "2011-07-01", None),
        ]),
        "px_cat_g1v2": df("px_cat_g1v2", [("CO_RF", "Components", "Road Frames", "Yes")]),
        "sales_details": df("sales_details", [
            ("SO1", "FR-R92B-58", "11000", "20120103", "20120110", "20120115", "10", "1", "10"),
            ("SO1", "FR-R92B-58", "11000", "20120103", "20120110", "20120115", "10", "1", "10"),
            ("SO2", "PE-1", "11001", "0", "20110101", "20110105", "-5", "0", "5"),
            ("SO3", "FR-R92B-58", "99999", "20100101", "20100102", "20100103", "7", "1", "7"),
            ("SO4", "NOPE", "11000", "20120101", "20111231", "20120102", "1", "1", "1"),
        ]),
    }


def test_clean_products_versions(spark):
    out = clean(raw_sources(spark)["prd_info"], SPECS["prd_info"])
    assert out.columns == ["product_id", "product_key", "product_name", "cost", "product_line", "start_date",
                           "end_date", "category_id"]
    got = {r.product_id: r for r in out.collect()}
    assert (got[210].end_date, got[211].end_date, got[212].end_date) == (D(2012, 6, 30), D(2013, 6, 30), None)
    assert (got[210].cost, got[210].product_line, got[213].product_line) == (None, "R", "missing")
    assert (got[214].category_id, got[214].product_key, got[214].cost) == (None, "ABC", None)


def test_run_batch_end_to_end(spark):
    out = run_batch(raw_sources(spark), as_of=D(2025, 6, 1), owners=["owner"], principal="analyst")
    cust = {r.customer_id: r for r in out["silver_customer_info"].collect()}
    assert set(cust) == {11000, 11001}
    assert (cust[11000].marital_status, cust[11000].creation_date) == ("Single", D(2025, 2, 1))
    assert (cust[11001].customer_key, cust[11001].marital_status, cust[11001].gender) == ("00011001", "missing", "Male")
    demo = {r.customer_key: r for r in out["silver_customer_demographics"].collect()}
    assert demo["00011001"].birth_date is None and demo["00011000"].gender == "Female"
    loc = {r.customer_key: r.country for r in out["silver_customer_location"].collect()}
    assert loc == {"00011000": "Germany", "00011001": "missing"}
    sales = out["silver_sales_details"]
    assert sales.count() == 4 and [r.order_date for r in sales.filter("order_number = 'SO2'").collect()] == [None]

    dim = {r.customer_id: r for r in out["gold_dim_customers"].collect()}
    assert (dim[11000].country, dim[11000].birth_date) == ("Germany", D(1990, 5, 6))
    secure = {r.customer_id: r for r in out["gold_dim_customers_secure"].collect()}
    assert (secure[11000].firstname, secure[11000].birth_date) == ("A***", D(1990, 1, 1))
    assert out["gold_dim_customers"].schema["firstname"].metadata["classification"] == "pii_name"

    rep = {(r.table_name, r.check_name): r for r in out["diagnostic_gold"].collect()}
    assert len(rep) == 54
    assert rep[("gold_fact_sales", "customer_referential_integrity")].failed_rows == 1
    assert rep[("gold_fact_sales", "product_referential_integrity")].failed_rows == 1
    assert rep[("gold_fact_sales", "historical_product_version_match")].failed_rows == 2
    assert rep[("gold_fact_sales", "historical_product_version_match")].total_rows == 3
    assert rep[("gold_fact_sales", "ship_before_order")].failed_rows == 1
    assert rep[("gold_dim_product", "product_validity_overlap")].failed_rows == 0
    assert rep[("gold_dim_product", "required_not_null:category")].failed_rows == 2
    assert rep[("gold_dim_customers", "future_birth_date")].failed_rows == 0

    bronze = {r.table_name: r for r in out["diagnostics_bronze"].collect()}
    assert set(bronze) == {"bronze_crm_cust_info", "bronze_crm_prd_info", "bronze_crm_sales_details",
                           "bronze_erp_cust_az12", "bronze_erp_loc_a101", "bronze_erp_px_cat_g1v2"}
    silver = {r.table_name: r for r in out["silver_diagnostics"].collect()}
    assert silver["silver_customer_info"].rows_removed == 4
    assert silver["silver_product_info"].dedupe_keys == '["product_id"]'


def test_run_batch_with_stored_layers_matches_lazy(spark):
    from conftest import rows
    from layercake.plans.layers import table_store

    raw = raw_sources(spark)
    lazy = run_batch(raw, as_of=D(2025, 6, 1))
    stored = run_batch(raw, as_of=D(2025, 6, 1), store=table_store("lc_layers"))
    assert spark.catalog.tableExists("lc_layers.silver_product_info")
    for name in ("silver_customer_info", "gold_dim_product", "diagnostic_gold", "silver_diagnostics"):
        assert rows(stored[name]) == rows(lazy[name]), name


def test_legacy_flow(spark):
    from layercake.plans.legacy import LEGACY_SPECS, clean_legacy

    cust = clean_legacy(raw_sources(spark)["cust_info"], LEGACY_SPECS["cust_info"])
    assert cust.columns == ["id", "key", "firstname", "lastname", "marital_status", "cst_gndr", "creation_date"]
    got = {r.id: r for r in cust.collect()}
    assert set(got) == {11000}  # 'aw-…' keeps its prefix and is not an integer; 'abc'/NULL ids dropped
    assert got[11000].key == 11000 and got[11000].creation_date in {"01/01/2025", "01/02/2025", "01/01/2000"}
    sales = clean_legacy(raw_sources(spark)["sales_details"], LEGACY_SPECS["sales_details"])
    dates = {r.order_number: r.order_date for r in sales.collect()}
    assert dates["SO1"] == "03/01/2012" and dates["SO2"] == "01/01/2000"
    prd = clean_legacy(raw_sources(spark)["prd_info"], LEGACY_SPECS["prd_info"])
    keys = {r.id: r.key for r in prd.collect()}
    assert keys["210"] == "FR-R92B-58" and keys["214"] == "ABC"


def test_folder_store_and_publish_all(spark):
    from layercake.plans.layers import folder_store, publish_all

    out = run_batch(raw_sources(spark), as_of=D(2025, 6, 1), store=folder_store())
    assert out["diagnostic_gold"].count() == 54
    written = publish_all({k: out[k] for k in ("silver_product_category", "gold_dim_customers_secure")}, "lc_pub")
    assert spark.catalog.tableExists("lc_pub.silver_product_category")
    assert not spark.catalog.tableExists("lc_pub.gold_dim_customers_secure")
    assert spark.table("gold_dim_customers_secure").count() == 2 and len(written) == 2


def test_run_batch_builds_only_requested_reports(spark):
    from conftest import rows
    from layercake.plans.layers import folder_store

    lazy = run_batch(raw_sources(spark), as_of=D(2025, 6, 1))
    stored = run_batch(raw_sources(spark), as_of=D(2025, 6, 1), store=folder_store(), reports=("diagnostic_gold",))
    assert rows(stored["diagnostic_gold"]) == rows(lazy["diagnostic_gold"])
    assert "silver_diagnostics" not in stored and "diagnostics_bronze" not in stored
    assert {"silver_sales_details", "gold_fact_sales", "gold_dim_customers_secure"} <= set(stored)


def test_specs_and_suites_from_config_dicts(spark):
    from layercake.plans.catalog import SPECS
    from layercake.plans.checks import Suite
    from layercake.plans.layers import STAR_SUITES
    from layercake.plans.spec import TableSpec

    config = {
        "target": "silver_product_info",
        "dedupe": {"keys": ["prd_id"]},
        "special_transform": "split_product_key",
        "dates": {"prd_start_dt": None, "prd_end_dt": None},
        "casts": {"prd_id": "int", "prd_cost": "int"},
        "fillna": {"prd_line": "missing"},
        "required": ["prd_id", "prd_key"],
        "post_transform": "derive_product_end_date",
        "rename": {"prd_id": "product_id", "prd_key": "product_key", "prd_nm": "product_name", "prd_cost": "cost",
                   "prd_line": "product_line", "prd_start_dt": "start_date", "prd_end_dt": "end_date"},
    }
    assert TableSpec.from_config(config) == SPECS["prd_info"]
    raw = raw_sources(spark)["prd_info"]
    assert rows(clean(raw, TableSpec.from_config(config))) == rows(clean(raw, SPECS["prd_info"]))
    suite = Suite.from_config({
        "keys": ["product_id"], "secondary_unique_keys": [["product_key", "start_date"]],
        "required_columns": list(STAR_SUITES["gold_dim_product"].required),
        "invalid_conditions": dict(STAR_SUITES["gold_dim_product"].rules),
    }, overlaps=STAR_SUITES["gold_dim_product"].overlaps)
    assert suite == STAR_SUITES["gold_dim_product"]


def test_fail_on_failure_option(spark):
    import pytest

    with pytest.raises(RuntimeError, match="quality checks failed"):
        run_batch(raw_sources(spark), as_of=D(2025, 6, 1), fail_on_failure=True)


def test_ordering_options_d2_d3(spark):
    from dataclasses import replace

    from layercake.plans.catalog import RAW_SCHEMAS, SPECS

    # The newest duplicate has no key -> dropped by `required` after dedupe
    cust = spark.createDataFrame([("1", None, "A", "B", "M", "F", "2025-02-01"),
                                  ("1", "AW1", "A", "B", "M", "F", "2025-01-01")], RAW_SCHEMAS["cust_info"])
    assert clean(cust, SPECS["cust_info"]).count() == 0
    kept = clean(cust, replace(SPECS["cust_info"], required_first=True)).collect()
    assert [(r.customer_id, r.customer_key) for r in kept] == [(1, "1")]
    # D3: a duplicated version (same id, same start) ends the day before it starts
    prd = spark.createDataFrame([("5", "CO-RF-K1", "n", "1", "R", "2011-07-01", None),
                                 ("5", "CO-RF-K1", "n", "1", "R", "2011-07-01", None),
                                 ("6", "CO-RF-K1", "n", "1", "R", "2012-07-01", None)], RAW_SCHEMAS["prd_info"])
    default = {r.product_id: r.end_date for r in clean(prd, SPECS["prd_info"]).collect()}
    fixed = {r.product_id: r.end_date for r in clean(prd, replace(SPECS["prd_info"], dedupe_first=True)).collect()}
    assert default[5] == D(2011, 6, 30)
    assert fixed[5] == D(2012, 6, 30) and fixed[6] is None
