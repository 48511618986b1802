import re

import duckdb

import __spark_entry__ as E
from layercake.showcase.spark_queries import TABLES

SF = "/root/testdata/sf0.001"


def core(by_key):
    """Without the training-data operators and the pipeline, which have tests of their own."""
    return {k: v for k, v in by_key.items() if not re.match(r"op\d+_|pipeline$", k)}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["table_name", "check_name", "check_type"]


def test_every_query_matches_oracle_at_smallest_sf(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, sql = core(E.queries()), core(E.oracle_sql())
    assert set(sql) == set(qs)
    bad = []
    for k, fn in qs.items():
        df = fn(spark, SF)
        s_rows = sorted(tuple(str(v) for _, v in sorted(r.asDict().items())) for r in df.collect())
        res = con.execute(sql[k])
        names = [d[0] for d in res.description]
        d_rows = sorted(tuple(str(v) for _, v in sorted(zip(names, r))) for r in res.fetchall())
        if sorted(df.columns) != sorted(names) or s_rows != d_rows:
            bad.append(k)
    assert bad == []
