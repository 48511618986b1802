import os
import tempfile

import pytest
from pyspark.sql import functions as F

from layercake.plans.catalog import RAW_SCHEMAS, raw_string_schema
from layercake.session import scratch_path
from layercake.sources.csv import IngestError, ingest_sources, read_raw_csv, source_name
from layercake.sources.sinks import LOSSLESS_CSV, read_batches, write_batches
from layercake.streaming.ingest import ingest_increment, read_sink
from layercake.operators.batches import assign_batches, unreleased_batches


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_positional_binding_and_strict_header(spark):
    d = tempfile.mkdtemp(prefix="lc-csv-")
    write(f"{d}/f.csv", "b,a\r\n1,2\r\n,4\r\n")
    df = read_raw_csv(spark, f"{d}/f.csv", raw_string_schema("a", "b"))
    assert [tuple(r) for r in df.collect()] == [("1", "2"), (None, "4")]
    with pytest.raises(Exception):
        read_raw_csv(spark, f"{d}/f.csv", raw_string_schema("a", "b"), strict_header=True).collect()
    inferred = read_raw_csv(spark, f"{d}/f.csv")
    assert dict(inferred.dtypes) == {"b": "int", "a": "int"}


def test_ingest_sources_collects_errors(spark):
    d = tempfile.mkdtemp(prefix="lc-src-")
    write(f"{d}/PX_CAT_G1V2.CSV", "ID,CAT,SUBCAT,MAINTENANCE\r\nAC_BR,Accessories,Bike Racks,Yes\r\n")
    write(f"{d}/mystery.csv", "x\r\n1\r\n")
    files = [f"{d}/PX_CAT_G1V2.CSV", f"{d}/mystery.csv", f"{d}/cust_info.csv"]
    assert source_name(files[0]) == "px_cat_g1v2"
    with pytest.raises(IngestError) as err:
        ingest_sources(spark, files, RAW_SCHEMAS)
    result = err.value.result
    assert list(result.tables) == ["raw_px_cat_g1v2"] and len(result.errors) == 2
    assert result.tables["raw_px_cat_g1v2"].count() == 1
    with pytest.raises(ValueError):
        ingest_sources(spark, files, RAW_SCHEMAS, mode="hybrid")


def test_stream_equals_batch_and_rerun_is_noop(spark):
    events = spark.range(0, 300).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"))
    schema = raw_string_schema("event_id", "user_id")
    numbered = assign_batches(events, ["event_id"], [100, 250])
    landing, sink = scratch_path(spark, "t-landing"), scratch_path(spark, "t-sink")
    counts = []
    for b in (1, 2, 3):
        drop = numbered.filter(F.col("batch_id") == b).drop("batch_id")
        drop.select(*[F.col(c).cast("string") for c in drop.columns]).write.mode("append").option(
            "header", True).csv(landing)
        counts.append(ingest_increment(spark, landing, schema, sink, max_files_per_trigger=1))
    assert counts == [100, 150, 50]
    assert ingest_increment(spark, landing, schema, sink) == 0
    got = read_sink(spark, sink, schema).select(F.col("event_id").cast("long"), F.col("user_id").cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.collect()))


def test_write_batches_and_release_guard(spark):
    df = spark.range(1, 8).select(F.col("id").alias("k"))
    batches = assign_batches(df, ["k"], [3, 5])
    out = scratch_path(spark, "t-batches")
    write_batches(batches, out)
    back = read_batches(spark, out)
    assert {r.batch_id for r in back.collect()} == {1, 2, 3}
    manifest = spark.read.parquet(f"{out}/manifest").collect()
    assert {(r.batch_id, r.rows) for r in manifest} == {(1, 3), (2, 2), (3, 2)}
    released = spark.createDataFrame([(1,)], "batch_id int")
    assert {r.batch_id for r in unreleased_batches(batches, released).collect()} == {2, 3}


def test_ingest_sources_streaming_mode(spark):
    d = tempfile.mkdtemp(prefix="lc-mode-")
    write(f"{d}/crm/cust_info.csv", "cst_id,cst_key,a,b,c,d,e\r\n1,AW1,x,y,M,F,2020-01-01\r\n")
    write(f"{d}/erp/loc_a101.csv", "CID,CNTRY\r\nAW1,DE\r\n")
    files = [f"{d}/crm/cust_info.csv", f"{d}/erp/loc_a101.csv"]
    res = ingest_sources(spark, files, RAW_SCHEMAS, mode="streaming", stream_sources=["cust_info"])
    assert res.tables["raw_cust_info"].isStreaming and not res.tables["raw_loc_a101"].isStreaming
    sink = scratch_path(spark, "mode-sink")
    q = res.tables["raw_cust_info"].writeStream.format("parquet").option(
        "checkpointLocation", sink + "/_checkpoint").trigger(availableNow=True).start(sink)
    q.awaitTermination()
    assert spark.read.parquet(sink).first().cst_key == "AW1"


def test_ingest_counts_every_micro_batch(spark):
    landing, sink = scratch_path(spark, "many-land"), scratch_path(spark, "many-sink")
    df = spark.range(0, 120).select(F.col("id").cast("string").alias("a"))
    df.repartition(12).write.option("header", True).csv(landing)
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        n = ingest_increment(spark, landing, raw_string_schema("a"), sink, max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert n == 120


def test_lossless_csv_keeps_any_text(spark):
    texts = ["a\nb", "a\r\nb", "  pad  ", "", None, 'q"uo"te', "c,omma", "\\", '\\"', "tab\t", "NULL", "\n", " ", "\u00e9\u4e2d"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    path = scratch_path(spark, "lossless")
    df.write.options(**LOSSLESS_CSV).csv(path)
    back = spark.read.schema("id string, t string").options(**LOSSLESS_CSV).csv(path)
    assert sorted((int(r.id), r.t) for r in back.collect()) == sorted(enumerate(texts), key=lambda x: x[0])


def test_concurrent_ingests_count_their_own_rows(spark):
    from concurrent.futures import ThreadPoolExecutor

    def run(n):
        landing, sink = scratch_path(spark, f"con-land-{n}"), scratch_path(spark, f"con-sink-{n}")
        spark.range(0, n).select(F.col("id").cast("string").alias("a")).repartition(5).write.option("header", True).csv(landing)
        return ingest_increment(spark, landing, raw_string_schema("a"), sink, max_files_per_trigger=1)

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(run, [70, 130])) == [70, 130]
