import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from layercake.operators import (
    dedupe,
    derive_end_date,
    global_row_number,
    orphan_rows,
    overlapping_versions,
    version_misses,
)
from layercake.operators.batches import assign_batches
from layercake.operators.segments import Skew

D = dt.date


def test_dedupe_keeps_newest_nulls_last(spark):
    df = spark.createDataFrame([(1, D(2025, 1, 1), "a"), (1, D(2025, 2, 1), "b"), (1, None, "c"), (2, None, "d")],
                               "id int, created date, v string")
    out = dedupe(df, ["id"], [("created", "desc")])
    assert rows(out) == [(1, D(2025, 2, 1), "b"), (2, None, "d")]


def test_dedupe_ascending_nulls_last_and_identity(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 3)], "id int, x int")
    assert rows(dedupe(df, ["id"], [("x", "asc")])) == [(1, 3)]
    assert dedupe(df, []).count() == 3


def test_dedupe_plans_partial_limit_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe(df, ["k"], [("id", "desc")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


rows_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])),
    min_size=0, max_size=30,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows_strategy)
def test_dedupe_deterministic_and_idempotent(spark, data):
    df = spark.createDataFrame(data, "k int, x int, s string")
    one = rows(dedupe(df.repartition(1), ["k"], [("x", "desc")]))
    many = rows(dedupe(df.repartition(5), ["k"], [("x", "desc")]))
    assert one == many
    again = rows(dedupe(dedupe(df, ["k"], [("x", "desc")]), ["k"], [("x", "desc")]))
    assert again == one
    assert len(one) == len({k for k, _, _ in data})


def test_derive_end_date_versions(spark):
    df = spark.createDataFrame([("HL-U509-R", D(2011, 7, 1), D(2000, 1, 1)), ("HL-U509-R", D(2013, 7, 1), None),
                                ("HL-U509-R", D(2012, 7, 1), None)], "k string, s date, e date")
    out = rows(derive_end_date(df, "k", "s", "e"), "s", "e")
    assert out == [(D(2011, 7, 1), D(2012, 6, 30)), (D(2012, 7, 1), D(2013, 6, 30)), (D(2013, 7, 1), None)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(starts=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 400)), max_size=25, unique=True))
def test_derived_periods_never_overlap(spark, starts):
    base = D(2020, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(days=d)) for k, d in starts], "k int, s date")
    derived = derive_end_date(df, "k", "s", "e")
    assert overlapping_versions(derived, "k", "s", "e", mode="any").count() == 0


def test_overlap_previous_vs_any(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 12, 31)), (1, D(2020, 2, 1), D(2020, 2, 10)),
                                (1, D(2020, 3, 1), D(2020, 3, 5)), (2, D(2020, 1, 1), None), (2, D(2021, 1, 1), None)],
                               "k int, s date, e date")
    prev = rows(overlapping_versions(df, "k", "s", "e", "previous"), "k", "s")
    anym = rows(overlapping_versions(df, "k", "s", "e", "any"), "k", "s")
    assert prev == [(1, D(2020, 2, 1)), (2, D(2021, 1, 1))]
    assert anym == [(1, D(2020, 2, 1)), (1, D(2020, 3, 1)), (2, D(2021, 1, 1))]


def test_version_misses(spark):
    versions = spark.createDataFrame([("A", D(2020, 1, 1), D(2020, 6, 30)), ("A", D(2020, 7, 1), None),
                                      ("B", D(2020, 1, 1), D(2020, 1, 31))], "k string, s date, e date")
    fact = spark.createDataFrame([(1, "A", D(2019, 12, 31)), (2, "A", D(2021, 1, 1)), (3, "B", D(2020, 2, 1)),
                                  (4, "B", None), (5, None, D(2020, 1, 5)), (6, "C", D(2020, 1, 5))],
                                 "id int, k string, d date")
    got = version_misses(fact, versions, "k", "d", "s", "e").orderBy("id").collect()
    assert [r.id for r in got] == [1, 3, 5, 6]


def test_orphan_rows_null_keys(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "cid int")
    assert rows(orphan_rows(fact, dim, "cid", "id")) == [(3,), (None,)]
    assert rows(orphan_rows(fact, dim, "cid", "id", ignore_null_keys=True)) == [(3,)]


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("x"), "id")
    out = global_row_number(df, ["x", "id"], partitions=6)
    expect = {r.id: i + 1 for i, r in enumerate(df.orderBy("x", "id").collect())}
    assert {r.id: r.row_number for r in out.collect()} == expect


def test_assign_batches_cut_points_left_inclusive(spark):
    df = spark.range(1, 11).select(F.col("id").alias("k"))
    out = {r.k: r.batch_id for r in assign_batches(df, ["k"], [3, 6]).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 3, 8: 3, 9: 3, 10: 3}


def test_version_misses_equal_nested_loop(spark):
    import random

    rnd = random.Random(7)
    vers, facts = [], []
    for k in ["A", "B", "C", None]:
        for _ in range(rnd.randint(0, 6)):
            s = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 300))
            e = None if rnd.random() < 0.3 else s + dt.timedelta(days=rnd.randint(-5, 60))
            vers.append((k, s, e))
    for i in range(200):
        k = rnd.choice(["A", "B", "C", "D", None])
        d = None if rnd.random() < 0.1 else D(2020, 1, 1) + dt.timedelta(days=rnd.randint(-10, 320))
        facts.append((i, k, d))
    v = spark.createDataFrame(vers, "k string, s date, e date")
    f = spark.createDataFrame(facts, "id int, k string, d date")
    got = {r.id for r in version_misses(f, v, "k", "d", "s", "e").collect()}
    want = {i for i, k, d in facts if d and not any(k is not None and k == vk and s <= d and (e is None or d <= e) for vk, s, e in vers)}
    assert got == want and want
    split = Skew(hot_rows=3, buckets=4, sample_fraction=None)
    assert {r.id for r in version_misses(f, v, "k", "d", "s", "e", skew=split).collect()} == want


def test_version_misses_types(spark):
    T = dt.datetime
    fact = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 2))], "id int, d date").selectExpr("id", "'A' AS k", "d")
    stamped = spark.createDataFrame([("A", T(2020, 1, 1, 12), None)], "k string, s timestamp, e timestamp")
    assert [r.id for r in version_misses(fact, stamped, "k", "d", "s", "e").collect()] == [1]  # midnight comes before noon
    texts = spark.createDataFrame([(1, "007"), (2, "8"), (3, "x"), (4, None)], "id int, k string").selectExpr("*", "DATE'2020-01-01' AS d")
    numbers = spark.createDataFrame([(7, D(2019, 1, 1), None), (5_000_000_000, D(2019, 1, 1), None)], "k bigint, s date, e date")
    assert sorted(r.id for r in version_misses(texts, numbers, "k", "d", "s", "e").collect()) == [2, 3, 4]
    ints = spark.createDataFrame([(1, 7), (2, 8)], "id int, k int").selectExpr("*", "DATE'2020-01-01' AS d")
    assert [r.id for r in version_misses(ints, numbers, "k", "d", "s", "e").collect()] == [2]


def test_hot_key_and_date_collapse_before_the_shuffle(spark):
    fact = spark.range(20_000).selectExpr("id", "CAST(id % 1 AS STRING) AS k", "date_add(DATE'2020-01-01', CAST(id % 1 AS INT)) AS d")
    versions = spark.createDataFrame([("0", D(2021, 1, 1), None)], "k string, s date, e date")
    out = version_misses(fact, versions, "k", "d", "s", "e")
    assert out.count() == 20_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]  # what is above the scan of the facts, from the window down
    assert "HashAggregate(keys=[__k" in window and "HashAggregate(keys=[__k" in window[window.index("Exchange"):]

