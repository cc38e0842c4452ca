"""A stored model answers as the fitted one does, from its buckets."""

import re

import pytest

from kinrank.operators import predict, store
from kinrank.operators.evaluate import split
from kinrank.operators.neighbours import top_neighbours
from kinrank.operators.similarity import similarity
from kinrank.sources.ratings import ratings_from_orders


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    train, _ = split(ratings_from_orders(spark, "/root/testdata/sf0.001"))
    train = train.cache()
    nb = top_neighbours(similarity(train, "overlap"), 10, 0.5).cache()
    return train, nb, store.save_model(nb, train, "stored_test", str(tmp_path_factory.mktemp("model")), buckets=16)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_answers_equal_the_fitted_models(spark, fitted):
    train, nb, _ = fitted
    want = predict.top_n(predict.exclude_rated(predict.predict_from_neighbours(nb, train), train), 5)
    model = store.load_model(spark, "stored_test")
    every = train.select("user_id").distinct()
    assert rows(model.recommend(every, 5)) == rows(want)
    users = [r.user_id for r in every.orderBy("user_id").limit(3).collect()]
    assert rows(model.recommend(users, 5)) == rows(want.where(want.user_id.isin(users)))
    assert rows(model.recommend(users[0], 5)) == rows(want.where(want.user_id == users[0]))
    assert model.recommend(-5, 5).count() == 0


def test_ratings_stay_in_their_buckets(spark, fitted):
    model = fitted[2]
    plan = model.predict(7)._jdf.queryExecution().sparkPlan().toString()
    plan = model.predict(7)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "stored_test_ratings" in x)
    above = []
    depth = lines[at].index("FileScan") if "FileScan" in lines[at] else len(lines[at])
    for x in reversed(lines[:at]):
        name = re.search(r"[A-Za-z]", x)
        if name and name.start() < depth:
            depth = name.start()
            above.append(x.strip())
            if "SortMergeJoin" in x:
                break
    assert above and "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)
    assert re.search(r"SelectedBucketsCount: 1 out of 16", plan)


def test_recommendations_shuffle_no_row_for_a_rating_of_a_neighbour(spark, fitted, monkeypatch):
    train, nb, model = fitted
    every = spark.createDataFrame(train.select("user_id").distinct().collect(), "user_id long")   # a cached frame's plan would show
    got = model.recommend(every, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_ratings" in plan and not re.search(r"hashpartitioning\(user_id#\d+L?, item_id#", plan)
    want = rows(got)
    monkeypatch.setattr(predict.gather, "HEAVY", 60)                     # most users go the plain way
    assert rows(model.recommend(every, 5)) == want
    users = [r.user_id for r in every.orderBy("user_id").limit(3).collect()]
    assert rows(model.recommend(users, 5)) == [t for t in want if t[0] in users]
