"""Every registered query with SQL: Spark result == DuckDB result (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from kinrank.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    def v(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, con, key):
    df = catalog.queries()[key](spark, SF)
    res = con.execute(oracle.oracle_sql()[key])
    assert df.columns == [d[0] for d in res.description]
    assert _norm(df.collect()) == _norm(res.fetchall())


def test_every_query_has_sql_or_is_iterative():
    missing = set(catalog.queries()) - set(oracle.oracle_sql())
    assert missing == {"als_predict", "als_loss", "als_loss_trace", "als_recommend", "als_evaluate",
                       "model_comparison", "rmse_by_fraction_models"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "predicted_rating", "rank"]
    assert df.count() >= 0


@pytest.mark.parametrize("key,cols", [
    ("als_predict", ["user_id", "item_id", "rating", "predicted_rating", "scored"]),
    ("als_loss", ["n_users", "loss"]),
    ("als_recommend", ["user_id", "item_id", "predicted_rating", "rank"]),
    ("als_evaluate", ["model", "n_cells", "hits", "rmse"]),
    ("model_comparison", ["model", "n_cells", "hits", "rmse"]),
])
def test_iterative_queries_run(spark, key, cols):
    df = catalog.queries()[key](spark, SF)
    assert df.columns == cols
    assert df.count() > 0
