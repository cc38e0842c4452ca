"""Model-style entry points give the same rows as the registered queries."""

import pytest

from kinrank.api import ALSRecommender, NeighbourhoodRecommender, RaterKNN, compare
from kinrank.plans import catalog

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_neighbourhood_model_matches_queries(spark):
    train, test = catalog.orders_split(spark, SF)
    m = NeighbourhoodRecommender(train, 10, 0.5)
    assert _rows(m.rmse(test, 5)) == _rows(catalog.q_rmse(spark, SF))
    recs = m.recommend(test.select("user_id"), 5)
    assert _rows(recs) == _rows(catalog.q_recommend_top_n(spark, SF))


def test_neighbourhood_model_single_user(spark, golden):
    m = NeighbourhoodRecommender(golden, 2, None, measure="corated", drop_constant=True)
    recs = m.recommend(1, 5).collect()
    assert [(r["item_id"], round(r["predicted_rating"], 6)) for r in recs] == [(4, 4.369318)]


def test_rater_knn_matches_queries(spark):
    train, test = catalog.events_split(spark, SF)
    knn = RaterKNN(10).fit(train)
    rows, summary = knn.evaluate(test)
    assert _rows(rows) == _rows(catalog.q_predict_nbcf(spark, SF))
    assert _rows(summary) == _rows(catalog.q_nbcf_evaluate(spark, SF))
    assert _rows(knn.recommend(10)) == _rows(catalog.q_recommend_nbcf(spark, SF))
    items = RaterKNN(10, mode="item").fit(train)
    assert _rows(items.recommend(10)) == _rows(catalog.q_recommend_users_for_item(spark, SF))


def test_als_and_comparison(spark):
    train, test = catalog.orders_split(spark, SF)
    als = ALSRecommender(max_iter=5).fit(train)
    rows, summary = als.evaluate(test)
    assert rows.count() == test.count()
    assert summary.first()["n_cells"] == test.count()
    assert als.recommend(3, [int(train.first()["user_id"])]).count() == 3
    with pytest.raises(ValueError):
        als.recommend(3, [10**9])
    both = compare(test, RaterKNN(10).fit(train), als)
    assert sorted(r["model"] for r in both.collect()) == ["als", "nbcf"]
