"""Neighbours found where an entity's lists meet (gather): the rows of the plain way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.functions.columns import round6
from kinrank.operators import gather, predict
from kinrank.operators.evaluate import split
from kinrank.operators.nbcf import predict_knn
from kinrank.operators.neighbours import nearest_neighbours, top_neighbours, top_neighbours_all
from kinrank.operators.similarity import all_pairs, similarity
from kinrank.schema import ITEM, PRED, RATING, USER


def sparse(spark, users=400, items=900, each=12):
    """Ratings of which two users rarely share one, with ids beyond 32 bits, an
    item rated by very many users and a user who rates very many items."""
    n = F.col("id")
    rows = spark.range(users * each).select((F.pmod(n, F.lit(users)) * 10_000_000_000 - 7).alias(USER),
                                            F.pmod(F.xxhash64(n), F.lit(items)).alias(ITEM), (F.pmod(F.xxhash64(n, F.lit(1)), F.lit(5)) + 1).alias(RATING))
    all_ = rows.unionByName(spark.range(users // 2).select((n * 10_000_000_000 - 7).alias(USER), F.lit(5_000).cast("long").alias(ITEM), (F.pmod(n, F.lit(5)) + 1).alias(RATING)))
    all_ = all_.unionByName(spark.range(items).select(F.lit(-7).cast("long").alias(USER), n.alias(ITEM), (F.pmod(n, F.lit(5)) + 1).alias(RATING)))
    return all_.groupBy(USER, ITEM).agg(F.max(RATING).cast("double").alias(RATING)).localCheckpoint()


def rows_of(df):
    return sorted((r[0], r[1], r["n_common"], round(r["similarity"], 12), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("bounds", [{}, {"LIST": 16, "PAIRS": 3000}, {"HEAVY": 20_000}])
def test_nearest_neighbours_are_those_of_all_pairs(spark, monkeypatch, bounds):
    for k, v in bounds.items():
        monkeypatch.setattr(gather, k, v)
    ratings = sparse(spark)
    assert gather.Shape(ratings, USER, ITEM).fits()
    targets = split(ratings)[1].select(USER)
    plain = top_neighbours(similarity(ratings, "overlap"), 10, 0.5, targets)
    assert rows_of(nearest_neighbours(ratings, "overlap", 10, 0.5, targets=targets)) == rows_of(plain)
    # n near the number of users: negatives have a rank too
    for n in (10, 380):
        plain = top_neighbours_all(similarity(ratings, "corated"), 400, n)
        assert rows_of(nearest_neighbours(ratings, "corated", n, n_entities=400)) == rows_of(plain)


def test_no_pair_is_shuffled(spark):
    """The plan makes no row of a pair outside the task that ranks it."""
    plan = nearest_neighbours(sparse(spark), "overlap", 10, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Window" not in plan


def test_dense_ratings_go_the_plain_way(spark, golden):
    assert not gather.Shape(golden, USER, ITEM).fits()
    assert rows_of(nearest_neighbours(golden, "overlap", 2, 0.0)) == rows_of(top_neighbours(similarity(golden, "overlap"), 2, 0.0))


@pytest.mark.parametrize("bounds", [{}, {"LIST": 16, "PAIRS": 3000}, {"HEAVY": 20_000}])
def test_nearest_raters_of_sparse_cells_are_those_of_all_pairs(spark, monkeypatch, bounds):
    """model_comparison's step: also cells of unknown users and items, and of users in no list."""
    for k, v in bounds.items():
        monkeypatch.setattr(gather, k, v)
    ratings, cells = split(sparse(spark))
    more = spark.createDataFrame([(-7, 77_000), (99, 5), (99, 77_000), (None, 5), (99, None)], f"{USER} long, {ITEM} long")
    cells = cells.unionByName(more.withColumn(RATING, F.lit(1.0))).localCheckpoint()
    rows = [predict_knn(cells, ratings, sims, 10).select(USER, ITEM, PRED) for sims in ("cosine", similarity(ratings, "cosine"))]
    plan = rows[0]._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and ("Window" in plan) == ("HEAVY" in bounds)
    got, want = (sorted(map(str, r.collect())) for r in rows)
    assert got == want and len(got) == cells.count()


@pytest.mark.parametrize("bounds", [{}, {"LIST": 16, "PAIRS": 3000}, {"HEAVY": 100}])
def test_recommendations_are_those_of_all_predictions(spark, monkeypatch, bounds):
    """recommend_top_n's, recommend_with_history's: many equal predictions, a rating that is null."""
    for k, v in bounds.items():
        monkeypatch.setattr(gather, k, v)
    train, test = split(sparse(spark))
    train = train.unionByName(spark.createDataFrame([(33 * 10_000_000_000 - 7, 6_000, None)], train.schema)).localCheckpoint()
    nb = nearest_neighbours(train, "overlap", 10, 0.3).localCheckpoint()
    hist = predict.history(test, train, test.select(USER))
    for rated, items in ((train, None), (hist, test), (None, test)):
        preds = predict.predict_from_neighbours(nb, train, items=items)
        want = predict.top_n(predict.exclude_rated(preds, rated) if rated is not None else preds, 5)
        got = predict.recommend(nb, train, 5, rated, items=items)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    plan = predict.recommend(nb, train, 5, train)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and ("Window" in plan) == ("HEAVY" in bounds)


def test_rounding_in_arrays_is_that_of_columns(spark):
    x = np.random.default_rng(1).normal(0, 3, 20_000)
    x = np.concatenate([x, np.round(x * 2 ** 7) / 2 ** 7, np.round(x, 6) + 5e-7, [0.0, -0.0, 1 / 128, -1 / 128]])
    rows = spark.createDataFrame([(float(v),) for v in x], "x double")
    want = np.array([r[0] for r in rows.select(round6("x").alias("x")).collect()])
    assert (gather.rounded(x) == want).all()


@pytest.mark.parametrize("bounds", [{}, {"LIST": 16, "PAIRS": 3000}, {"HEAVY": 20_000}])
def test_all_pairs_are_those_of_the_plain_way(spark, monkeypatch, bounds):
    """similarity_item_cosine's and similarity_symmetric's step, both sides, all measures."""
    for k, v in bounds.items():
        monkeypatch.setattr(gather, k, v)
    ratings = sparse(spark)
    ratings = ratings.unionByName(spark.createDataFrame([(10_000_000_000 - 7, 6_000, 2.5), (20_000_000_000 - 7, 6_000, 0.25)], ratings.schema)).localCheckpoint()
    rows = lambda df: sorted((r[0], r[1], r["n_common"], round(r["similarity"], 9)) for r in df.collect())
    for measure, sides in (("overlap", (USER, ITEM)), ("corated", (USER, ITEM)), ("cosine", (USER, ITEM)), ("cosine", (ITEM, USER))):
        kw = dict(zip(("entity", "through"), sides))
        assert rows(all_pairs(ratings, measure, **kw)) == rows(similarity(ratings, measure, **kw))
    plan = all_pairs(ratings, "overlap")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and ("SortMergeJoin [_t" in plan) <= bool(bounds)


def test_sweep_makes_no_row_of_a_prediction_and_equals_the_plain_way(spark, monkeypatch):
    from kinrank.operators import evaluate, gather
    cells = [(u, i, float((u * 5 + i * 3 + u * i) % 5 + 1)) for u in range(40) for i in range(30) if (u * 11 + i * 7 + u * i) % 4]
    ratings = spark.createDataFrame(cells, "user_id long, item_id long, rating double").cache()
    train, test = evaluate.split(ratings)
    neigh = spark.createDataFrame([(u, (u + 3 * r) % 40, (-1.0 if r == 4 else 1.0) / r, r) for u in range(40) for r in range(1, 7) if (u + r) % 5],
                                  "user_id long, neighbour_id long, similarity double, rank int").cache()
    for top, candidates in ((None, "unrated"), (2, "test_items"), (3, "unrated")):
        sweep = lambda: evaluate.sweep(neigh, train, test, 2, 6, top=top, candidates=candidates)  # noqa: B023, E731
        got = sweep()
        assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
        light = sorted(map(tuple, got.collect()))
        plain = evaluate._swept_plain(neigh, train, test, 2, 6, top, candidates, 4096)
        want = {r["n"]: (r["hits"], r["rmse"]) for r in evaluate.rmse_of(plain, group=("n",)).collect()}
        assert light == [(n, *want.get(n, (0, None))) for n in range(2, 7)] and any(h for _, h, _ in light)
        with monkeypatch.context() as m:
            m.setattr(gather, "HEAVY", 120)                              # some users go the plain way
            assert sorted(map(tuple, sweep().collect())) == light
