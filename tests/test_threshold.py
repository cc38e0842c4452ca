"""Pairs above a threshold: cells, parts and the plain way give the same rows."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import threshold as th
from kinrank.operators.evaluate import split
from kinrank.operators.neighbours import top_neighbours
from kinrank.operators.similarity import similarity
from kinrank.sources.ratings import ratings_from_events, ratings_from_orders

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def forms(spark):
    return {"events": split(ratings_from_events(spark, SF))[0].cache(), "orders": split(ratings_from_orders(spark, SF))[0].cache()}


@pytest.mark.parametrize("form,measure,t", [("events", "overlap", 0.5), ("events", "cosine", 0.2), ("orders", "overlap", 0.5),
                                            ("orders", "cosine", 0.0)])
def test_cells_equal_the_plain_way(forms, form, measure, t, monkeypatch):
    monkeypatch.setattr(th, "PAIRS_AT_ONCE", 500)
    r = forms[form]
    want = rows(similarity(r, measure).where(F.col("similarity") > t))
    assert want
    for group, parts in ((10_000, 1), (7, 1), (20, 3)):
        got = th.similar_above(r, t, measure, group=group, cells=True, parts=parts)
        assert got.columns == ["user_id", "neighbour_id", "n_common", "similarity"]
        assert rows(got) == want
    assert rows(th.similar_above(r, t, measure, cells=False)) == want


def test_item_mode_and_min_common(forms):
    r = forms["events"]
    want = rows(similarity(r, "cosine", entity="item_id", through="user_id", min_common=3).where("similarity > 0.05"))
    assert rows(th.similar_above(r, 0.05, "cosine", entity="item_id", through="user_id", min_common=3, group=9, cells=True)) == want


def test_neighbours_are_those_of_all_pairs(forms):
    r = forms["events"]
    assert (rows(top_neighbours(th.similar_above(r, 0.5, cells=True), 10)) == rows(top_neighbours(similarity(r, "overlap"), 10, 0.5)))


def test_dense_ratings_take_cells_and_make_fewer_rows(spark):
    r = split(ratings_from_events(spark, "/root/testdata/sf0.01"))[0]
    cost = th.work(r, "user_id", "item_id")
    out = th.similar_above(r, 0.5)
    assert "FlatMapGroupsInPandas" in out._jdf.queryExecution().executedPlan().toString()
    assert 3 * (cost["rows"] * cost["groups"] + out.count()) < cost["pairs"]


def test_awkward_ratings(spark, golden):
    assert th.similar_above(golden.where("false"), 0.5).count() == 0
    assert th.similar_above(golden.where("false"), 0.5, cells=True).count() == 0
    with pytest.raises(ValueError):
        th.similar_above(golden, -0.1)
    hot = spark.createDataFrame([(0, i, float(i % 5)) for i in range(300)] + [(u, i, float((u + i) % 5)) for u in range(1, 40) for i in range(0, 300, 40)],
                                "user_id long, item_id long, rating double")
    assert rows(th.similar_above(hot, 0.1, "cosine", group=8, cells=True, parts=4)) == rows(similarity(hot, "cosine").where("similarity > 0.1"))
