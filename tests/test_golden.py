"""Golden micro-fixture (values worked out independently, FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import nbcf, neighbours, predict, quality
from kinrank.operators.similarity import similarity


def _pairs(df):
    return {(r["user_id"], r["neighbour_id"]): r["similarity"] for r in df.collect()}


def test_constant_raters(golden):
    c = {r["user_id"]: r for r in quality.constant_raters(golden).collect()}
    assert set(c) == {4, 5}
    assert c[4]["std_rating"] == 0.0 and c[5]["std_rating"] is None
    s = quality.constant_rater_summary(golden).first()
    assert (s["total_users"], s["constant_users"]) == (5, 2)
    assert s["percent"] == pytest.approx(40.0)
    assert {r["user_id"] for r in quality.biased_raters(golden).collect()} == {4, 5}
    kept = {r["user_id"] for r in quality.without_constant_raters(golden).collect()}
    assert kept == {1, 2, 3}


@pytest.mark.parametrize("measure,expected", [
    ("corated", {(1, 2): 0.981981, (1, 3): -1.0, (2, 3): -0.855236, (1, 4): 0.0, (2, 4): 0.0, (3, 4): 0.0}),
    ("overlap", {(1, 2): 0.866025, (1, 3): -0.988483, (2, 3): -0.855236, (1, 4): 0.0, (2, 4): 0.0, (3, 4): 0.0}),
    ("cosine", {(1, 2): 0.670820, (1, 3): -0.956183, (2, 3): -0.855236, (1, 4): 0.0, (2, 4): 0.0, (3, 4): 0.0}),
])
def test_similarities(golden, measure, expected):
    got = _pairs(similarity(golden, measure))
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, abs=1e-6), (measure, k)


def test_common_counts(golden):
    got = {(r["user_id"], r["neighbour_id"]): r["n_common"] for r in similarity(golden, "overlap").collect()}
    assert got[(1, 2)] == 3 and got[(2, 3)] == 4 and got[(1, 4)] == 2


def test_corated_prediction_r1b(golden):
    valid = quality.without_constant_raters(golden)
    sims = similarity(valid, "corated")
    nb = neighbours.top_neighbours_all(sims, 3, 2, targets=golden.where("user_id = 1"))
    assert {r["neighbour_id"] for r in nb.collect()} == {2, 3}
    p = predict.predict_from_neighbours(nb, valid).where("item_id = 4").first()
    assert p["predicted_rating"] == pytest.approx(4.369318, abs=1e-6)


def test_overlap_prediction_r1(golden):
    sims = similarity(golden, "overlap")
    nb = neighbours.top_neighbours(sims, 2, 0.5, golden.where("user_id = 1"))
    assert [r["neighbour_id"] for r in nb.collect()] == [2]
    p = predict.predict_from_neighbours(nb, golden).where("user_id = 1 AND item_id = 4").first()
    assert p["predicted_rating"] == pytest.approx(5.0)


@pytest.mark.parametrize("k,expected", [(1, 5.0), (2, 4.265380)])
def test_knn_rater_prediction(spark, golden, k, expected):
    sims = similarity(golden, "cosine")
    cells = spark.createDataFrame([(1, 4)], "user_id bigint, item_id bigint")
    p = nbcf.predict_knn(cells, golden, sims, k).first()
    assert p["predicted_rating"] == pytest.approx(expected, abs=1e-6)


def test_knn_fallback_to_mean(spark, golden):
    sims = similarity(golden, "cosine")
    cells = spark.createDataFrame([(1, 5)], "user_id bigint, item_id bigint")
    assert nbcf.predict_knn(cells, golden, sims, 10).first()["predicted_rating"] == pytest.approx(3.0)


def test_empty_for_unknown_user(spark, golden):
    valid = quality.without_constant_raters(golden)
    sims = similarity(valid, "corated")
    nb = neighbours.top_neighbours_all(sims, 3, 2, targets=golden.where("user_id = 4"))
    assert nb.count() == 0
    assert predict.predict_from_neighbours(nb, valid).where(F.col("user_id") == 4).count() == 0
