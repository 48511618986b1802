"""Report states that merge by file, and the filtered referential check."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layercake.operators import integrity, key_duplicates, orphan_rows, orphan_rows_filtered
from layercake.plans.report_state import ReportState
from layercake.plans.reports import table_profile
from layercake.session import scratch_path
from layercake.sources.versioned import PublishConflict


def landing(spark, df, root, name):
    path = f"{root}/in/{name}"
    df.repartition(2).write.parquet(path)
    return spark.read.parquet(path).inputFiles()


def table(spark, seed, n=200):
    rng = random.Random(seed)
    data = [(rng.choice([None, 1, 2, 3, rng.randrange(1000)]), rng.choice([None, "x", ""]), i) for i in range(n)]
    return spark.createDataFrame(data, "`k.1` int, __file string, _rows int")


def read(spark):
    return lambda names: spark.read.parquet(*names)


def test_state_equals_the_full_report_and_reads_new_files_only(spark):
    root, all_files, frames = scratch_path(spark, "t-state"), [], []
    for i in range(3):
        frames.append(table(spark, i))
        files = landing(spark, frames[-1], root, i)
        state = ReportState(spark, f"{root}/state", ["k.1"])
        opened = []
        all_files += files
        new = state.update(all_files, lambda names: opened.extend(names) or spark.read.parquet(*names))
        assert sorted(new) == sorted(opened) == sorted(files)
        whole = frames[0]
        for f in frames[1:]:
            whole = whole.unionByName(f)
        got = state.report("t").first().asDict()
        full = table_profile(whole, "t").first().asDict() | key_duplicates(whole, ["k.1"], "t").first().asDict()
        assert got == {k: full[k] for k in got if k != "dedupe_keys"} | {"dedupe_keys": '["k.1"]'}
    assert state.update(all_files, read(spark)) == []


def test_a_failed_or_late_update_changes_nothing(spark):
    root = scratch_path(spark, "t-state")
    files = landing(spark, table(spark, 1), root, 0)
    state = ReportState(spark, f"{root}/state")
    with pytest.raises(ValueError):
        state.report("t")
    state.update(files, read(spark))
    before = rows(state.report("t"))
    more = landing(spark, table(spark, 2), root, 1)

    def other_first(names):
        ReportState(spark, f"{root}/state").update(more, read(spark))
        return spark.read.parquet(*names)

    with pytest.raises(PublishConflict):
        state.update(more, other_first)
    assert rows(state.report("t")) != before and state.report("t").first()["row_count"] == 400
    with pytest.raises(ValueError):
        state.update(landing(spark, spark.range(3), root, 2), read(spark))
    assert state.report("t").first()["row_count"] == 400


@pytest.mark.parametrize("bits, most", [(16, integrity.BROADCAST_KEYS), (1, 1)])
@pytest.mark.parametrize("ignore", [False, True])
def test_filtered_orphans_equal_the_anti_join(spark, bits, most, ignore):
    """Also with one word for all keys, which lets nearly every key through."""
    rng = random.Random(7)
    facts = [(rng.choice([None, 5, rng.randrange(400)]), rng.choice(["a", None])) for _ in range(2000)]
    fact = spark.createDataFrame(facts * 2, "__key int, __bits string")
    dim = spark.createDataFrame([(x,) for x in [None, *rng.sample(range(400), 200)] * 2], "d long")
    for f, d in ((fact, dim), (fact.limit(0), dim), (fact, dim.limit(0))):
        want = sorted(map(str, rows(orphan_rows(f, d, "__key", "d", ignore))))
        assert sorted(map(str, rows(orphan_rows_filtered(f, d, "__key", "d", ignore, bits, most)))) == want


def test_filtered_orphans_without_broadcast_of_wrong_keys(spark, monkeypatch):
    monkeypatch.setattr(integrity, "BROADCAST_KEYS", 0)
    fact, dim = spark.range(500).select(F.col("id").cast("string").alias("k")), spark.range(0, 500, 2)
    fact = fact.union(spark.createDataFrame([("no number",)], "k string"))
    got = orphan_rows_filtered(fact, dim, "k", "id", bits_per_key=2)
    assert sorted(r[0] for r in got.collect()) == sorted([str(i) for i in range(1, 500, 2)] + ["no number"])


def test_fact_rows_are_not_shuffled(spark):
    fact, dim = spark.range(2000).selectExpr("id as k", "id * 2 as v"), spark.range(1000)
    plan = orphan_rows_filtered(fact, dim, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("__word" in line for line in shuffled)  # the filter's words alone
