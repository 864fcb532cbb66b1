"""Every registered query of the engine's own operators against its SQL, over the smallest tables."""

import os

import duckdb
import pytest

from spillway.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 7)
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    expected = sql.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert _rows(df.columns, df.collect()) == _rows(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def _against_sql(spark, name, folder, **changed):
    """A query and its SQL over the smallest tables with some of them changed by SQL; the rows of both."""
    con = duckdb.connect()
    for t in TABLES:
        if t in changed:
            con.sql(f"COPY ({changed[t].replace('FROM ' + t, f"FROM '{SF}/{t}.parquet'")}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        else:
            os.symlink(f"{SF}/{t}.parquet", f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, str(folder))
    expected = con.sql(ORACLES[name])
    return _rows(df.columns, df.collect()), _rows(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", ["arr_exists", "arr_unnest"])
def test_elements_at_the_bound(spark, tmp_path, name):
    odd = "SELECT * FROM embeddings UNION ALL SELECT -1, [0.3, 0.1], 0 UNION ALL SELECT -2, [0.35], 0 UNION ALL SELECT -3, [0.2, NULL], 0 UNION ALL SELECT -4, [NULL], 0 UNION ALL SELECT -5, NULL, 0 UNION ALL SELECT -6, [], 0"
    got, expected = _against_sql(spark, name, tmp_path, embeddings=f"SELECT vec_id, embedding::FLOAT[] AS embedding, label FROM ({odd})")
    assert got == expected


def test_atanh_at_its_ends(spark, tmp_path):
    odd = "SELECT * REPLACE (CASE c_custkey WHEN 1 THEN 8000.0 WHEN 2 THEN -8000.0 WHEN 3 THEN 7999.99 ELSE c_acctbal END AS c_acctbal) FROM customer"
    got, expected = _against_sql(spark, "math_atanh", tmp_path, customer=odd)
    assert got == expected


@pytest.mark.parametrize(("name", "step"), [("upsert_merge", 1000000), ("upsert_pk", 1000000), ("tier_late_rows", 100000)])
def test_new_orders_whose_numbers_are_in_use(spark, tmp_path, name, step):
    odd = f"SELECT * FROM (SELECT * FROM orders) o UNION ALL SELECT * REPLACE (o_orderkey + {step} AS o_orderkey) FROM orders"
    got, expected = _against_sql(spark, name, tmp_path, orders=odd)
    assert got == expected
