from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from layercake.plans.catalog import RAW_SCHEMAS, SPECS, raw_string_schema
from layercake.plans.spec import clean
from layercake.session import scratch_path
from layercake.streaming.ingest import ingest_increment, read_sink

raw_customer = st.tuples(
    st.sampled_from(["1", " 2", "2", "x", None, "3"]),
    st.sampled_from(["AW001", "aw-002", " ", None, "NASAW3"]),
    st.sampled_from(["Ann", " Bo ", None]),
    st.just("Lee"),
    st.sampled_from(["M", "s", "", None, "Married"]),
    st.sampled_from(["F", " male", None]),
    st.sampled_from(["2024-01-01", "2023-05-05", "bad", None]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(raw_customer, max_size=25))
def test_clean_is_independent_of_partitioning(spark, data):
    df = spark.createDataFrame(data, RAW_SCHEMAS["cust_info"])
    one = rows(clean(df.repartition(1), SPECS["cust_info"]))
    many = rows(clean(df.repartition(6), SPECS["cust_info"]))
    assert one == many
    assert len({r[0] for r in one}) == len(one)  # one row per customer id


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cuts=st.lists(st.integers(1, 59), max_size=3, unique=True))
def test_stream_equals_batch_for_any_file_split(spark, cuts):
    df = spark.range(60).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    schema = raw_string_schema("a", "b")
    landing, sink = scratch_path(spark, "p-land"), scratch_path(spark, "p-sink")
    bounds = [0, *sorted(cuts), 60]
    total = 0
    for lo, hi in zip(bounds, bounds[1:]):
        df.filter((F.col("a").cast("int") >= lo) & (F.col("a").cast("int") < hi)).write.mode("append").option(
            "header", True).csv(landing)
        total += ingest_increment(spark, landing, schema, sink)
    assert total == 60
    assert rows(read_sink(spark, sink, schema)) == rows(df)
