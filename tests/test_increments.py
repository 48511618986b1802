"""Versioned publishing, keyed increments, intake with rejects, exclusive release, grouped metrics, file order, header binding."""

import os
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layercake.operators.batches import assign_batches, assign_file_batches, file_row_number
from layercake.operators.profile import exact_duplicates, grouping_metrics, key_groups
from layercake.plans.catalog import RAW_SCHEMAS, raw_string_schema
from layercake.plans.incremental import IncrementalStar, run_keyed_increment
from layercake.plans.layers import run_batch
from layercake.session import scratch_path
from layercake.sources.csv import read_csv_by_header
from layercake.sources.sinks import write_batches
from layercake.sources.tables import release_batch, release_log
from layercake.sources.versioned import PublishConflict, VersionedStore, exclusive_write, list_names, publish_atomic
from layercake.streaming.intake import Intake, IntakeError, ingest_to_sinks, read_checked_csv, read_checked_sink, run_streams


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def near(path):
    return path.removeprefix("file:")


# --- versioned publishing


def test_readers_see_the_old_or_the_new_table(spark):
    root = scratch_path(spark, "t-store")
    publish_atomic(spark.range(5), root, "t", view="lc_views.t_now")
    old = VersionedStore(spark, root).read("t")

    def fail():
        raise OSError("lost between write and swap")

    with pytest.raises(OSError):
        publish_atomic(spark.range(9), root, "t", before_swap=fail)
    assert VersionedStore(spark, root).read("t").count() == 5 == spark.table("lc_views.t_now").count()
    publish_atomic(spark.range(9), root, "t", view="lc_views.t_now")
    assert VersionedStore(spark, root).read("t").count() == 9 == spark.table("lc_views.t_now").count()
    assert old.count() == 5  # a frame planned before keeps its version
    with pytest.raises(ValueError, match="would change"):
        publish_atomic(spark.range(2).toDF("other"), root, "t", check_schema=True)
    store = VersionedStore(spark, root)
    one, two = store.begin(), store.begin()
    one.replace("t", spark.range(1))
    two.replace("t", spark.range(2))
    one.commit()
    with pytest.raises(PublishConflict):
        two.commit()
    assert store.read("t").count() == 1
    assert store.vacuum(keep=1) >= 3 and store.read("t").count() == 1
    spark.sql("DROP VIEW lc_views.t_now")
    spark.sql("DROP SCHEMA lc_views")


def test_buckets_are_replaced_alone(spark):
    store = VersionedStore(spark, scratch_path(spark, "t-buckets"))
    work = store.begin()
    work.replace("t", spark.range(1000).selectExpr("id", "id % 50 as k"), ["k"], 8)
    before = work.commit()
    keys = spark.createDataFrame([(7,)], "k bigint")
    touched = before.touched("t", keys)
    assert len(touched) == 1
    work = store.begin()
    part = before.read("t", touched)
    work.replace("t", part.withColumn("id", F.when(F.col("k") == 7, F.lit(-1)).otherwise(F.col("id"))), ["k"], 8, touched)
    after = work.commit()
    same = [b for b in before.tables["t"]["parts"] if before.tables["t"]["parts"][b] == after.tables["t"]["parts"][b]]
    assert len(same) == 7 and after.read("t").where("id = -1").count() == 20 and after.read("t").count() == 1000
    with pytest.raises(ValueError, match="outside"):
        store.begin().replace("t", spark.range(100).selectExpr("id", "id as k"), ["k"], 8, touched)


def test_one_of_many_creates_a_file(spark):
    path = scratch_path(spark, "t-claims") + "/claim"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(exclusive_write(spark, path, str(i)))) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(won) == 1 and list_names(spark, path.rsplit("/", 1)[0]) == ["claim"]


# --- keyed increments


def raw_rows(spark, part):
    """Raw rows of three increments: new customers, newer and older records, moved keys, late versions and categories."""
    r = {
        0: {
            "cust_info": [("1", "AW001", "A", "B", "M", "F", "2020-01-01"), ("2", "AW002", "C", "D", "S", "M", "2020-01-01"), ("x", "AW9", "E", "F", "S", "M", None),
                          *[(str(i), f"AW{i:05d}", "N", "N", "S", "F", "2019-05-05") for i in range(100, 160)]],
            "cust_az12": [("NASAW001", "1990-02-02", "F"), ("NASAW00120", "1980-01-01", "M")],
            "loc_a101": [("AW-001", "DE"), ("AW-002", "US")],
            "prd_info": [("1", "AA-BB-P1", "p one", "10", "R", "2020-01-01", None), ("2", "AA-BB-P1", "p one b", "11", "R", "2021-01-01", None), ("3", "CC-DD-P2", "p two", None, "M", "2020-06-01", None)],
            "px_cat_g1v2": [("AA_BB", "cat", "sub", "Yes")],
            "sales_details": [("S1", "P1", "1", "20200301", "20200302", "20200303", "10", "1", "10"), ("S2", "P2", "2", "20210101", "20210102", "20210103", "5", "1", "5")],
        },
        1: {
            "cust_info": [("1", "AW001", "A2", "B", "S", "F", "2022-01-01"), ("2", "AW777", "C", "D", "S", "M", "2021-01-01"), ("2", "AW002", "old", "D", "S", "M", "2001-01-01")],
            "cust_az12": [("NASAW777", "1970-01-01", "M")],
            "prd_info": [("4", "AA-BB-P1", "p one c", "12", "S", "2020-07-01", None), ("3", "CC-DD-P3", "p moved", "9", "M", "2019-06-01", None)],
        },
        2: {
            "loc_a101": [("AW-00120", "USA"), ("AW777", "FR")],
            "px_cat_g1v2": [("CC_DD", "late", "sub", "No")],
            "sales_details": [("S2", "P2", "2", "20210101", "20210102", "20210103", "4", "1", "4"), ("S3", "P9", "404", "20230101", "20230102", "20230103", "1", "1", "1")],
        },
    }[part]
    return {s: spark.createDataFrame(x, RAW_SCHEMAS[s]) for s, x in r.items()}


def test_keyed_increments_equal_the_full_recompute(spark):
    star = IncrementalStar(spark, scratch_path(spark, "t-star"), buckets=16, as_of="2025-06-01")
    every = {}
    for part in range(3):
        new = raw_rows(spark, part)
        log = star.apply(new)
        every = {s: every[s].unionByName(new[s]) if s in every and s in new else every.get(s, new.get(s)) for s in {**every, **new}}
        want = run_batch(every, as_of="2025-06-01", reports=())
        got = star.tables()
        for name in ("gold_dim_customers", "gold_dim_product", "gold_fact_sales"):
            assert rows(got[name]) == rows(want[name].select(*got[name].columns)), (part, name)
        if part:  # no more buckets are rewritten than there are touched keys
            assert all(len(b) <= 6 for b in log.touched.values()), log.touched
    with pytest.raises(ValueError, match="built as of"):
        IncrementalStar(spark, star.store.root, buckets=16, as_of="2026-01-01").apply(raw_rows(spark, 1))


def test_only_keys_that_occur_again_are_shuffled(spark, monkeypatch):
    """Rows whose key no other row has go to their buckets by themselves: neither the windows nor the joins get them, nor are kept rows dealt again."""
    from layercake.plans import incremental
    from layercake.sources import versioned

    given, plans = [], []
    plain, joins, write = incremental.finish, incremental.same_keys, versioned.Transaction._write

    def finish(df, spec, *args, **more):
        if spec.keys:
            given.append(df.count())
        return plain(df, spec, *args, **more)

    def same_keys(df, keys, how):
        given.append(df.count())
        return joins(df, keys, how)

    def written(self, df, keys, buckets):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, keys, buckets)

    monkeypatch.setattr(incremental, "finish", finish)
    monkeypatch.setattr(incremental, "same_keys", same_keys)
    monkeypatch.setattr(versioned.Transaction, "_write", written)
    star = IncrementalStar(spark, scratch_path(spark, "t-star-again"), buckets=4, as_of="2025-06-01")
    sale = lambda i, amount: (f"S{i}", "P1", "1", "20200301", "20200302", "20200303", str(amount), "1", "1")
    every = []
    for part in range(3):
        own = [sale(i, part) for i in range(part * 500, part * 500 + 500)] + [sale(i, 90 + part) for i in (7, 1003, 1003)] + [(None, *sale(1, 1)[1:])]
        every += own
        star.apply({"sales_details": spark.createDataFrame(own, RAW_SCHEMAS["sales_details"])})
    assert given and max(given) <= 30, given  # of 1,500 rows
    assert not any("RebalancePartitions" in p or "RepartitionByExpression" in p for p in plans)
    want = run_batch({"sales_details": spark.createDataFrame(every, RAW_SCHEMAS["sales_details"])}, as_of="2025-06-01", reports=())["gold_fact_sales"]
    got = star.tables()["gold_fact_sales"]
    assert rows(got) == rows(want.select(*got.columns)) and got.count() == 1500


def test_an_increment_reads_touched_buckets_only(spark, monkeypatch):
    star = IncrementalStar(spark, scratch_path(spark, "t-star-read"), buckets=16, as_of="2025-06-01")
    star.apply(raw_rows(spark, 0))
    opened = []
    from layercake.sources import versioned

    plain = versioned.Snapshot.read
    monkeypatch.setattr(versioned.Snapshot, "read", lambda self, name, buckets=None: opened.append((name, buckets)) or plain(self, name, buckets))
    before = star.store.snapshot()
    log = star.apply({"cust_info": spark.createDataFrame([("120", "AW00120", "N", "M", "S", "F", "2021-05-05")], RAW_SCHEMAS["cust_info"])})
    assert opened and all(b is not None and len(b) <= 1 for _, b in opened), opened
    untouched = [n for n in before.tables if n not in log.touched]
    assert "silver_sales_details" in untouched and "gold_dim_product" in untouched
    for name, buckets in log.touched.items():
        old, new = before.tables[name]["parts"], log.snapshot.tables[name]["parts"]
        assert {b for b in set(old) | set(new) if old.get(b) != new.get(b)} <= {str(b) for b in buckets}


def test_a_lost_increment_is_repeated_once(spark, monkeypatch):
    landing, sink = scratch_path(spark, "t-land"), scratch_path(spark, "t-sink")
    star = IncrementalStar(spark, scratch_path(spark, "t-star-lost"), buckets=4, as_of="2025-06-01")
    job = Intake("cust_info", landing, sink, RAW_SCHEMAS["cust_info"])
    raw_rows(spark, 0)["cust_info"].write.option("header", True).csv(landing)
    from layercake.sources import versioned

    plain = versioned.Transaction.commit
    monkeypatch.setattr(versioned.Transaction, "commit", lambda self, *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run_keyed_increment(star, [job])
    monkeypatch.setattr(versioned.Transaction, "commit", plain)
    outcomes, _ = run_keyed_increment(star, [job])
    assert outcomes[0].rows == 0  # the intake was done, the tables were not
    assert star.store.read("raw_cust_info").count() == 63
    assert run_keyed_increment(star, [job])[1].rows == {}
    assert star.store.read("raw_cust_info").count() == 63


def test_a_failed_intake_is_no_increment(spark):
    """A source that fails midway and one that cannot start: an error that names both, no tables without their rows, and every row once they are mended."""
    base = near(scratch_path(spark, "t-star-broken"))
    star = IncrementalStar(spark, f"{base}/star", buckets=4, as_of="2025-06-01")
    jobs = [Intake(s, f"{base}/{s}", f"{base}/sink-{s}", RAW_SCHEMAS[s], max_files_per_trigger=1) for s in ("cust_info", "sales_details", "loc_a101")]
    landed = {}

    def land(part, *sources):
        for s in sources:
            new = raw_rows(spark, part)[s]
            new.coalesce(1).write.mode("append").option("header", True).csv(f"{base}/{s}")
            landed[s] = landed[s].unionByName(new) if s in landed else new

    land(0, "cust_info", "sales_details")
    assert run_keyed_increment(star, jobs[:2])[1].snapshot.version == 1
    before = rows(star.tables()["gold_dim_customers"]), rows(star.tables()["gold_fact_sales"])
    land(1, "cust_info")
    land(2, "sales_details")
    held = set(os.listdir(f"{base}/sales_details"))
    land(2, "sales_details")
    (broken,) = [f"{base}/sales_details/{f}" for f in set(os.listdir(f"{base}/sales_details")) - held if f.endswith(".csv")]
    text = open(broken).read()
    write(broken, text.replace("S2", "S0"))  # no longer what its checksum says
    for _ in range(2):  # tried again, it is still an error
        with pytest.raises(IntakeError, match="(?s)sales_details: .*loc_a101: ") as failed:
            run_keyed_increment(star, jobs)
        assert [o.error is None for o in failed.value.outcomes] == [True, False, False]
        assert (rows(star.tables()["gold_dim_customers"]), rows(star.tables()["gold_fact_sales"])) == before
    write(broken, text)
    land(2, "loc_a101")
    run_keyed_increment(star, jobs)
    once = IncrementalStar(spark, f"{base}/once", buckets=4, as_of="2025-06-01")
    once.apply(landed)
    assert star.store.read("raw_sales_details").count() == landed["sales_details"].count() == 6
    for name, want in once.tables().items():
        assert rows(star.tables()[name].select(*want.columns)) == rows(want), name


# --- intake


def test_streams_run_at_once_and_errors_are_collected(spark):
    base = near(scratch_path(spark, "t-intake"))
    schema = raw_string_schema("a", "b")
    for name in ("one", "two", "strict"):
        write(f"{base}/{name}/f.csv", "a,b\n1,2\n3,4\n")
    write(f"{base}/strict/g.csv", "a,b\n5,6,7\n")
    jobs = [Intake(n, f"{base}/{n}", f"{base}/sink-{n}", schema) for n in ("one", "two", "absent")]
    jobs.append(Intake("strict", f"{base}/strict", f"{base}/sink-strict", schema, {"mode": "FAILFAST"}))
    jobs.append(Intake("guessed", f"{base}/one", f"{base}/sink-guessed"))
    got = {o.name: o for o in run_streams(spark, jobs)}
    assert [(got[n].rows, got[n].error) for n in ("one", "two", "guessed")] == [(2, None)] * 3
    assert got["absent"].error and got["strict"].error and got["strict"].rows == 0
    assert [o.rows for o in run_streams(spark, jobs[:2])] == [0, 0]
    write(f"{base}/one/h.csv", "a,b\n9,9\n")
    assert [(o.mode, o.rows) for o in ingest_to_sinks(spark, jobs[:2], "streaming", ["ONE"])] == [("streaming", 1), ("batch", 2)]
    assert [o.mode for o in ingest_to_sinks(spark, jobs[1:2])] == ["batch"]
    with pytest.raises(ValueError):
        ingest_to_sinks(spark, jobs, "hybrid")


def test_malformed_lines_are_kept_apart(spark):
    base = near(scratch_path(spark, "t-reject"))
    write(f"{base}/in/a.csv", 'id,name\n1,x\n2\n3,y,z\nfour,w\n5,"q, r"\n')
    write(f"{base}/in/b.csv", "id,name\n6,\n")
    checked = read_checked_csv(spark, f"{base}/in", spark.createDataFrame([], "id int, name string").schema)
    assert rows(checked.kept) == [(1, "x"), (5, "q, r"), (6, None)]
    assert rows(checked.rejected) == [("2", "a.csv"), ("3,y,z", "a.csv"), ("four,w", "a.csv")]
    assert checked.kept.select("name").count() == 3 == checked.kept.count() and checked.rejected.select("_file").count() == 3
    schema = checked.kept.schema
    job = Intake("r", f"{base}/in", f"{base}/sink", schema, rejects=True)
    first = run_streams(spark, [job])[0]
    assert (first.rows, first.rejected, first.error) == (6, 3, None) and run_streams(spark, [job])[0].rows == 0
    stored = read_checked_sink(spark, f"{base}/sink", schema)
    assert rows(stored.kept) == rows(checked.kept) and rows(stored.rejected) == rows(checked.rejected)
    with pytest.raises(ValueError, match="reserved"):
        read_checked_csv(spark, f"{base}/in", raw_string_schema("_line"))


# --- release


def test_two_releasers_never_take_one_batch(spark):
    exported = write_batches(assign_batches(spark.range(60), ["id"], [10, 20, 30, 40, 50]), scratch_path(spark, "t-exp"))
    landing, log, taken = scratch_path(spark, "t-landing"), scratch_path(spark, "t-log"), []

    def work():
        while (b := release_batch(spark, exported, landing, log)) is not None:
            taken.append(b)

    threads = [threading.Thread(target=work) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(taken) == [1, 2, 3, 4, 5, 6] and release_log(spark, log).count() == 6
    assert spark.read.option("header", True).csv(landing).groupBy("batch_id").count().where("count = 10").count() == 6


def test_a_dead_releasers_batch_is_taken_over(spark):
    exported = write_batches(assign_batches(spark.range(20), ["id"], [10]), scratch_path(spark, "t-exp"))
    landing, log = scratch_path(spark, "t-landing"), scratch_path(spark, "t-log")
    assert exclusive_write(spark, f"{log}/claim-1-1", '{"owner": "dead", "at": 0}')
    assert release_batch(spark, exported, landing, log, stale_after=1e12) == 2
    with pytest.raises(ValueError, match="another"):
        release_batch(spark, exported, landing, log, 1, stale_after=1e12)
    assert release_batch(spark, exported, landing, log, owner="dead", stale_after=1e12) == 1
    assert release_batch(spark, exported, landing, log) is None


# --- grouped metrics, file order, headers


def test_grouping_metrics_equal_the_single_checks(spark):
    data = [(1, "a", None), (1, "a", None), (1, "b", 2.0), (None, "a", 3.0), (None, "a", 3.0), (2, None, 1.0)]
    for part in (data, data[:1], []):
        df = spark.createDataFrame(part, "k int, `odd name` string, v double").repartition(2)
        sets = [["k"], ["k", "odd name"], ["odd name", "v"], ["k"]]
        got = grouping_metrics(df, sets).first().asDict()
        plain = exact_duplicates(df, "t").first()
        assert (got["_rows"], got["_distinct"]) == (plain["total_rows"], plain["distinct_rows"])
        for i, keys in enumerate(sets):
            one = key_groups(df, keys).first()
            assert (got[f"_groups_{i}"], got[f"_extra_{i}"]) == (one["duplicate_key_groups"], one["duplicate_key_rows"])
    plan = grouping_metrics(df, sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("Expand") == 1


def test_file_order_needs_no_shuffle(spark):
    path = scratch_path(spark, "t-order")
    spark.range(1000).selectExpr("id", "cast(id as string) as s").repartition(3).write.parquet(path)
    plain = spark.read.parquet(path)
    order = [r["id"] for f in sorted(plain.inputFiles()) for r in spark.read.parquet(f).collect()]
    got = file_row_number(plain)
    assert {r["row_number"]: r["id"] for r in got.collect()} == {i + 1: v for i, v in enumerate(order)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    sizes = {r["batch_id"]: r["count"] for r in assign_file_batches(plain, [100, 250]).groupBy("batch_id").count().collect()}
    assert sizes == {1: 100, 2: 150, 3: 750}
    text = scratch_path(spark, "t-order-csv")
    spark.range(50_000).coalesce(1).write.option("header", True).csv(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")  # one file in several splits
    try:
        lines = file_row_number(spark.read.schema("id bigint").option("header", True).csv(text))
        assert lines.where("row_number <> id + 1").count() == 0 and lines.count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_columns_are_bound_by_header(spark):
    base = near(scratch_path(spark, "t-headers"))
    write(f"{base}/a.csv", "id,name,age\n1,x,10\n")
    write(f"{base}/b.csv", "Age,ID,extra\n20,2,e\n")
    write(f"{base}/c.csv", '"name","id"\r\n"y, z",3\r\n')
    write(f"{base}/_d.csv", "nothing\n")
    schema = raw_string_schema("id", "name", "age")
    assert rows(read_csv_by_header(spark, base, schema)) == [("1", "x", "10"), ("2", None, "20"), ("3", "y, z", None)]
    write(f"{base}/e.csv", "id,ID\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv_by_header(spark, base, schema)
