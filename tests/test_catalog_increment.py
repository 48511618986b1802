
import pytest
from pyspark.sql import functions as F


from layercake.plans.layers import run_increment
from layercake.session import scratch_path
from layercake.sources.csv import discover_tables
from layercake.sources.sinks import publish_table
from layercake.streaming.ingest import stream_raw_csv
from test_layers import raw_sources


def test_publish_discover_and_schema_guard(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    publish_table(df, "lc_db.bronze_crm_x")
    publish_table(df, "lc_db.bronze1other")
    publish_table(df, "lc_db.silver_y")
    assert discover_tables(spark, "bronze_", "lc_db") == ["bronze_crm_x"]
    assert discover_tables(spark, "bronze_", "lc_db", exclude=["bronze_crm_x"]) == []
    publish_table(df.withColumn("v", F.upper("v")), "lc_db.bronze_crm_x", check_schema=True)
    assert spark.table("lc_db.bronze_crm_x").first().v == "A"
    with pytest.raises(ValueError, match="Schema"):
        publish_table(df.withColumn("extra", F.lit(1)), "lc_db.bronze_crm_x", check_schema=True)


def test_inferred_schema_stream(spark):
    folder = scratch_path(spark, "infer")
    spark.createDataFrame([(1, 2.5), (2, 3.5)], "a int, b double").write.option("header", True).csv(folder)
    s = stream_raw_csv(spark, folder)
    assert s.isStreaming and dict(s.dtypes) == {"a": "int", "b": "double"}


def test_run_increment_appends_then_recomputes(spark):
    raw = raw_sources(spark)
    landing = {s: scratch_path(spark, f"land-{s}") for s in raw}
    sinks = {s: scratch_path(spark, f"sink-{s}") for s in raw}
    for s, df in raw.items():
        df.write.option("header", True).csv(landing[s])
    counts, out = run_increment(spark, landing, sinks, as_of="2025-06-01")
    assert counts == {s: df.count() for s, df in raw.items()}
    assert out["silver_customer_info"].count() == 2
    assert out["diagnostic_gold"].count() == 54
    again, _ = run_increment(spark, landing, sinks)
    assert set(again.values()) == {0}


def test_load_tables_and_missing_table_check(spark):
    from layercake.plans.checks import Suite, quality_report
    from layercake.sources.tables import load_tables

    publish_table(spark.createDataFrame([(1,)], "id int"), "lc_db.present_t")
    tables = load_tables(spark, ["present_t", "absent_t"], "lc_db")
    assert tables["absent_t"] is None
    rep = {(r.table_name, r.check_name): r.status for r in quality_report(
        tables, {"present_t": Suite(keys=("id",)), "absent_t": Suite()}).collect()}
    assert rep[("absent_t", "table_exists")] == "FAIL" and rep[("present_t", "table_exists")] == "PASS"


def test_release_batches_in_order_and_refuse_twice(spark):
    from layercake.operators.batches import assign_batches
    from layercake.sources.sinks import write_batches
    from layercake.sources.tables import release_batch

    df = spark.range(1, 31).select(F.col("id").cast("string").alias("v"))
    exported = scratch_path(spark, "rel-batches")
    write_batches(assign_batches(df, ["v"], [10, 20]), exported)
    landing, log = scratch_path(spark, "rel-landing"), scratch_path(spark, "rel-log")
    assert release_batch(spark, exported, landing, log) == 1
    assert spark.read.option("header", True).csv(landing).count() == 10
    with pytest.raises(ValueError, match="already released"):
        release_batch(spark, exported, landing, log, batch_id=1)
    assert release_batch(spark, exported, landing, log, batch_id=3) == 3
    assert release_batch(spark, exported, landing, log) == 2
    assert release_batch(spark, exported, landing, log) is None
    assert spark.read.option("header", True).csv(landing).count() == 30
    # a retry after a lost log write does not duplicate a committed batch
    log2 = scratch_path(spark, "rel-log2")
    assert release_batch(spark, exported, landing, log2, batch_id=2) == 2
    assert spark.read.option("header", True).csv(landing).count() == 30


def test_profile_catalog(spark):
    from layercake.plans.reports import profile_catalog

    publish_table(spark.createDataFrame([(1, None), (2, "x")], "id int, v string"), "lc_prof.bronze_a")
    publish_table(spark.createDataFrame([(1,)], "id int"), "lc_prof.diagnostics_bronze")
    rep = profile_catalog(spark, "bronze_", "lc_prof").collect()
    assert [(r.table_name, r.total_null_values) for r in rep] == [("bronze_a", 1)]


def test_layer_catalog_after_stored_run(spark):
    from layercake.plans.layers import run_batch, table_store
    from layercake.plans.reports import layer_catalog

    out = run_batch(raw_sources(spark), as_of="2025-06-01", store=table_store("lc_cat"))
    from conftest import rows

    assert rows(layer_catalog(spark, "lc_cat")) == rows(out["silver_diagnostics"])
    with pytest.raises(RuntimeError, match="Missing"):
        layer_catalog(spark, "lc_nowhere")


def test_quality_catalog(spark):
    from conftest import rows
    from layercake.plans.checks import quality_catalog
    from layercake.plans.layers import STAR_SUITES, run_batch, table_store

    out = run_batch(raw_sources(spark), as_of="2025-06-01", store=table_store("lc_q"))
    assert rows(quality_catalog(spark, STAR_SUITES, "lc_q", as_of="2025-06-01")) == rows(out["diagnostic_gold"])
    missing = {(r.table_name, r.check_name): r.status for r in quality_catalog(spark, STAR_SUITES, "lc_none").collect()}
    assert set(missing.values()) == {"FAIL"} and len(missing) == 3
