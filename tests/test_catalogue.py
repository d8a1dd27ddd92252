"""Every catalogue query against its SQL on the smallest tables."""


import os

import duckdb
import pandas as pd
import pytest

from granary.plans import catalogue, registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, pd.Timestamp) and v == v.normalize():
        return v.date()
    return v


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(map(plain, r))) for r in df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    assert rows(got) == rows(duck.execute(catalogue.SQL[name]).df())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_rolling_covers_every_date_of_orders(spark, duck):
    dates = {r[0] for r in duck.execute("SELECT DISTINCT o_orderdate::DATE FROM orders").fetchall()}
    got = catalogue.QUERIES["rolling_7day_all"](spark, DATA).collect()
    assert {r.date for r in got} == dates and len(got) == len(dates)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_nesting_covers_every_order_and_line(spark, duck):
    got = catalogue.QUERIES["plates_with_items_all"](spark, DATA).collect()
    assert {r.id for r in got} == {r[0] for r in duck.execute("SELECT o_orderkey FROM orders").fetchall()}
    lines = duck.execute("SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)").fetchone()[0]
    assert sum(r.n_items for r in got) == lines


def agrees(spark, path, name, table, sql):
    """A query on a made-up table against its SQL."""
    c = duckdb.connect()
    c.execute(f"COPY ({sql}) TO '{path}/{table}.parquet' (FORMAT parquet)")
    c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    got = catalogue_and_changes()[name](spark, str(path)).toPandas()
    assert rows(got) == rows(c.execute(registry.SQL[name]).df())
    return got


def catalogue_and_changes():
    import granary.plans.changes  # noqa: F401

    return registry.QUERIES


PARTS = """
SELECT k::BIGINT AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, (k % 50 + 1)::INTEGER AS p_size, 900.0::DOUBLE AS p_retailprice
FROM (SELECT unnest([1, 2, 50, 100, 101, 1000050, 1000051, 1000100, 2000050]) AS k)"""


@pytest.mark.parametrize("name", ["effort_record", "useup_set"])
def test_made_up_ids_that_a_large_table_has(spark, tmp_path, name):
    """from a million parts on, a part has the id of an unknown one."""
    agrees(spark, tmp_path, name, "part", PARTS)


EVENTS = """
SELECT i::BIGINT AS event_id, TIMESTAMP '2001-01-01' + to_days(i::INTEGER) AS ts, u::BIGINT AS user_id, t AS event_type, v::DOUBLE AS value, '{}' AS props
FROM (VALUES (1, 1, 'purchase', 5), (2, 1, 'purchase', 0), (3, 2, 'purchase', 0), (4, 3, 'signup', 4), (5, 4, 'purchase', NULL), (6, 4, 'view', 3), (90, 5, 'purchase', 1)) x(i, u, t, v)"""


@pytest.mark.parametrize("name", ["freshness_expired", "purchase_clock"])
def test_a_purchase_of_no_value_is_one(spark, tmp_path, name):
    """the clock follows purchases, not values above 0."""
    got = agrees(spark, tmp_path, name, "events", EVENTS)
    assert got.set_index("item").bought_at.notna().to_dict() == {1: True, 2: True, 3: False, 4: True, 5: True}
