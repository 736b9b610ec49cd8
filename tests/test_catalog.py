"""Every declarative query against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tidemark import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    plain = lambda v: "~" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return sorted(tuple(plain(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DIR).toPandas(), duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want[got.columns])


def test_entry_and_registration(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_whole_table_queries_reach_every_execution(spark, duck):
    got = catalog.QUERIES["sync_upsert_all"](spark, DIR)
    events = duck.execute("select count(*), count(distinct user_id || event_type), count(*) filter (value > 20) from events").fetchone()
    assert got.count() == events[1] and got.where("updated_at = 'new'").count() > 0
    assert catalog.QUERIES["replay_snapshot_all"](spark, DIR).count() == events[2]
    assert catalog.QUERIES["replay_resolve_all"](spark, DIR).count() == events[0]
    assert catalog.QUERIES["partition_scan_all"](spark, DIR).count() > 0
