"""Similar pairs by products of matrices (dense): the rows of the plain way."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import dense, gather
from kinrank.operators.nbcf import predict_knn, recommend_knn
from kinrank.operators.neighbours import nearest_neighbours, top_neighbours
from kinrank.operators.similarity import similarity
from kinrank.operators.threshold import similar_above
from kinrank.schema import ITEM, PRED, RATING, SIM, USER


def crowded(spark, users=300, items=40):
    """Two in three cells rated; a constant rater; ids beyond 32 bits."""
    n = F.col("id")
    u, i = F.floor(n / F.lit(items)), F.pmod(n, F.lit(items))
    rows = spark.range(users * items).where(F.pmod(F.xxhash64(n), F.lit(3)) > 0)
    return rows.select((u * 10_000_000_000 - 7).alias(USER), (i * 5_000_000_000).alias(ITEM),
                       F.when(u == 3, F.lit(2)).otherwise(F.pmod(F.xxhash64(n, F.lit(1)), F.lit(5)) + 1).cast("double").alias(RATING)).localCheckpoint()


def rows_of(df, *more):
    return sorted((r[0], r[1], r["n_common"], round(r[SIM], 12), *[r[c] for c in more]) for r in df.collect())


@pytest.mark.parametrize("measure", ["overlap", "cosine"])
@pytest.mark.parametrize("bounds", [{}, {"GROUP": 40, "LEAST": 40, "SPAN": 3, "STEP": 16, "AT_ONCE": 50}])
def test_dense_rows_are_those_of_all_pairs(spark, monkeypatch, measure, bounds):
    for k, v in bounds.items():
        monkeypatch.setattr(dense, k, v)
    ratings = crowded(spark)
    assert dense.fits(gather.Shape(ratings, USER, ITEM), measure)
    sims = similarity(ratings, measure)
    assert rows_of(similar_above(ratings, 0.3, measure)) == rows_of(sims.where(F.col(SIM) > 0.3))
    some = ratings.where(F.col(ITEM) == 0).select(USER)
    got = nearest_neighbours(ratings, measure, 7, 0.1, targets=some)
    assert rows_of(got, "rank") == rows_of(top_neighbours(sims, 7, 0.1, some), "rank")


def test_dense_work_is_taken_in_bounded_cells(spark):
    """A user's ratings are one packed row, copied to cells; no rating is, and no row is made of a pair."""
    plan = similar_above(crowded(spark), 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "_b#" in plan


@pytest.mark.parametrize("bounds", [{}, {"GROUP": 40, "LEAST": 40, "SPAN": 3, "STEP": 16}])
def test_nearest_raters_of_a_cell_are_those_of_all_pairs(spark, monkeypatch, bounds):
    """Also with copies of users, whose nearest neighbours all lack what they lack."""
    for k, v in bounds.items():
        monkeypatch.setattr(dense, k, v)
    some = crowded(spark, 60)
    ratings = some.unionByName(some.withColumn(USER, F.col(USER) + 1)).unionByName(some.withColumn(USER, F.col(USER) + 2)).localCheckpoint()
    cells = ratings.select(USER).distinct().crossJoin(ratings.select(ITEM).distinct()).join(ratings, [USER, ITEM], "left_anti")
    more = spark.createDataFrame([(-7, 77), (99, 0), (99, 77)], f"{USER} long, {ITEM} long")
    cells = cells.unionByName(more).withColumn(RATING, F.lit(1.0)).localCheckpoint()
    both = [sorted(tuple(r) for r in predict_knn(cells, ratings, sims, 10).select(USER, ITEM, PRED).collect()) for sims in ("cosine", similarity(ratings, "cosine"))]
    assert both[0] == both[1] and len(both[0]) == cells.count()


@pytest.mark.parametrize("k,bounds", [(3, {}), (10, {"GROUP": 40, "LEAST": 40, "SPAN": 3, "STEP": 16})])
def test_dense_recommendations_are_those_of_all_pairs(spark, monkeypatch, k, bounds):
    """recommend_nbcf's: some users are settled by their nearest neighbours, some are not."""
    for name, v in bounds.items():
        monkeypatch.setattr(dense, name, v)
    ratings = crowded(spark, 150)
    ratings = ratings.where((F.col(USER) != -7) | (F.col(ITEM) == 0)).localCheckpoint()
    some = ratings.where(F.col(ITEM) == 0).select(USER)
    for entities in (None, some):
        both = [recommend_knn(ratings, sims, k, 5, entities=entities) for sims in ("cosine", similarity(ratings, "cosine"))]
        got, want = (sorted(map(tuple, df.select(USER, ITEM, PRED, "rank").collect())) for df in both)
        assert got == want and got
