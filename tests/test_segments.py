import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from layercake.operators.segments import PLAIN, Skew, hot_bounds, tag_buckets
from layercake.operators.versions import derive_end_date, flag_overlaps

TINY = Skew(hot_rows=3, buckets=3, accuracy=100, sample_fraction=None)
BASE = dt.date(2020, 1, 1)

periods = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "a", "b", None]),  # "a" is the hot key
        st.one_of(st.none(), st.integers(0, 60)),
        st.one_of(st.none(), st.integers(0, 20)),
    ),
    max_size=40,
)


def frame(spark, data):
    out = []
    for i, (k, s, length) in enumerate(data):
        start = None if s is None else BASE + dt.timedelta(days=s)
        end = None if (start is None or length is None) else start + dt.timedelta(days=length)
        out.append((i, k, start, end))
    return spark.createDataFrame(out, "id int, k string, s date, e date")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=periods)
def test_segmented_windows_equal_plain(spark, data):
    df = frame(spark, data)
    for fn in (
        lambda sk: derive_end_date(df, "k", "s", "e", tie=["id"], skew=sk),
        lambda sk: flag_overlaps(df, "k", "s", "e", "previous", ["id"], "f", sk),
        lambda sk: flag_overlaps(df, "k", "s", "e", "any", ["id"], "f", sk),
    ):
        assert rows(fn(TINY)) == rows(fn(PLAIN))


def test_hot_key_is_split_into_buckets(spark):
    data = [(i, "hot", BASE + dt.timedelta(days=i), None) for i in range(60)] + [(100, "cold", BASE, None)]
    df = spark.createDataFrame(data, "id int, k string, s date, e date")
    sk = Skew(hot_rows=10, buckets=4, accuracy=1000, sample_fraction=None)
    tagged = tag_buckets(df, ["k"], "s", sk, hot_bounds(df, ["k"], "s", sk))
    hot_buckets = {r["__seg_bucket"] for r in tagged.filter("k = 'hot'").collect()}
    assert len(hot_buckets) == 4
    assert {r["__seg_bucket"] for r in tagged.filter("k = 'cold'").collect()} == {0}
    ends = derive_end_date(df, "k", "s", "e", skew=Skew(hot_rows=10, buckets=4, accuracy=1000, sample_fraction=None))
    got = {r.id: r.e for r in ends.collect()}
    assert all(got[i] == BASE + dt.timedelta(days=i) for i in range(59)) and got[59] is None and got[100] is None


def test_dominant_start_value_is_split_by_tie(spark):
    # one hot key, 80 % of its rows on the same start date
    data = [(i, "hot", BASE if i % 5 else BASE + dt.timedelta(days=i), None) for i in range(200)]
    data += [(1000 + i, "cold", BASE + dt.timedelta(days=i), None) for i in range(5)]
    df = spark.createDataFrame(data, "id int, k string, s date, e date")
    sk = Skew(hot_rows=20, buckets=8, accuracy=1000, sample_fraction=None)
    bounds = hot_bounds(df, ["k"], "s", sk, "id")
    tagged = tag_buckets(df, ["k"], "s", sk, bounds, "id")
    same_day = {r["__seg_bucket"] for r in tagged.filter(f"k = 'hot' AND s = DATE'{BASE}'").collect()}
    assert len(same_day) > 1
    for fn in (
        lambda skw: derive_end_date(df, "k", "s", "e", tie=["id"], skew=skw),
        lambda skw: flag_overlaps(df, "k", "s", "e", "previous", ["id"], "f", skw),
        lambda skw: flag_overlaps(df, "k", "s", "e", "any", ["id"], "f", skw),
    ):
        assert rows(fn(sk)) == rows(fn(PLAIN))


def test_text_starts_and_text_ties_are_split(spark):
    data = [(i, "hot", f"2020-{1 + i % 12:02d}-{1 + i % 28:02d}", f"t{i:03d}") for i in range(90)] + [(200, "cold", None, "x"), (201, "hot", None, "y")]
    df = spark.createDataFrame(data, "id int, k string, s string, t string")
    sk = Skew(hot_rows=10, buckets=4, sample_fraction=None)
    tagged = tag_buckets(df, ["k"], "s", sk, hot_bounds(df, ["k"], "s", sk))
    assert len({r["__seg_bucket"] for r in tagged.filter("k = 'hot' and s is not null").collect()}) == 4
    same = df.selectExpr("id", "k", "'2020-01-01' AS s", "t")
    tagged = tag_buckets(same, ["k"], "s", sk, hot_bounds(same, ["k"], "s", sk, "t"), "t")
    assert len({r["__seg_bucket"] for r in tagged.filter("k = 'hot'").collect()}) > 2
    for t in (df, same):
        for mode in ("previous", "any"):
            ends = t.selectExpr("*", "concat(substr(s, 1, 8), '31') AS e")
            assert rows(flag_overlaps(ends, "k", "s", "e", mode, ["t", "id"], "f", sk)) == rows(flag_overlaps(ends, "k", "s", "e", mode, ["t", "id"], "f", PLAIN))


def test_no_hot_key_is_left_out(spark):
    data = [(i, f"k{i % 12}", BASE + dt.timedelta(days=i)) for i in range(240)] + [(1000 + i, "k0", BASE + dt.timedelta(days=i)) for i in range(100)]
    df = spark.createDataFrame(data, "id int, k string, s date")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = hot_bounds(df, ["k"], "s", Skew(hot_rows=5, buckets=3, sample_fraction=None))
    split = {r["__bk0"] for r in bounds.collect()}
    assert "k0" in split and len(split) == min(parts, 12)  # every key over a partition's share of the 340 rows
