"""Plan shape of every registered query (sf0.001 tables)."""

import pytest

import __spark_entry__ as E
from kinrank import session

SF = "/root/testdata/sf0.001"
CORE = sorted(k for k in E.queries() if not k.startswith("op") and k != "pipeline")


@pytest.fixture(autouse=True)
def no_folder(monkeypatch):
    monkeypatch.setattr(session, "named_folder", lambda spark: None)


def _plan(df):
    """The plan with those of all frames that it reads from Spark's storage:
    without a checkpoint folder nothing has been cut off it."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", CORE)
def test_no_cartesian_products(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_the_check_sees_what_was_kept(spark):
    """The neighbour table is kept before it is returned; its pair join and the
    source scan still show."""
    plan = _plan(E.queries()["top_neighbours"](spark, SF))
    assert "InMemoryRelation" in plan and plan.count("Join") >= 2 and "lineitem.parquet" in plan
    crossed = spark.range(3).crossJoin(spark.range(2).toDF("b")).persist()
    assert any(x in _plan(crossed.select("id")) for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))


@pytest.mark.parametrize("key", ["recommend_top_n", "predict_nbcf", "rmse_by_n"])
def test_top_k_is_a_group_limit(spark, key):
    assert "WindowGroupLimit" in _plan(E.queries()[key](spark, SF))


def test_neighbour_ranking_is_a_group_limit(spark):
    from kinrank.operators.neighbours import top_neighbours
    from kinrank.operators.similarity import similarity
    from kinrank.sources.ratings import ratings_from_orders
    nb = top_neighbours(similarity(ratings_from_orders(spark, SF), "overlap"), 10, 0.5)
    assert "WindowGroupLimit" in _plan(nb)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["ratings_load"](spark, SF))
    scans = [x for x in plan.splitlines() if "ReadSchema" in x]
    orders = [x for x in scans if "orders.parquet" in x]
    assert scans and orders
    assert {x.split("ReadSchema: ")[1] for x in orders} == {"struct<o_orderkey:bigint,o_custkey:bigint>"}
    assert "l_extendedprice" not in plan
