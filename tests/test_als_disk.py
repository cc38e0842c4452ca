"""What the factor models put on disk: a rating's factors and not a row's sums, and few iterations at a time."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import als, factors
from kinrank.schema import ITEM, USER


def ratings(spark):
    return spark.createDataFrame([(u, i, float((u * 5 + i * 3 + u * i) % 5 + 1)) for u in range(30) for i in range(12) if (u * 11 + i * 7 + u * i) % 4],
                                 "user_id long, item_id long, rating double").localCheckpoint()


def test_no_sums_are_shuffled(spark):
    """als_loss_trace's step: sums are begun and ended in one stage."""
    cells = ratings(spark).withColumnRenamed("rating", "y")
    items = als.start(cells.select(ITEM).distinct(), ITEM, 6)
    lines = als.solve(cells, items, USER, ITEM, 6, 0.001)._jdf.queryExecution().executedPlan().toString().splitlines()
    sums = [i for i, x in enumerate(lines) if "Aggregate(keys=[user_id" in x]
    assert len(sums) == 2 and not any("Exchange" in x for x in lines[sums[0]:sums[1]])


def test_rows_with_very_many_ratings_give_the_same_losses(spark, monkeypatch):
    train = ratings(spark)
    plain = als.trace(train, 3, 0.01, 3)[0]
    monkeypatch.setattr(als, "HOT", 9)                     # some users, all items
    assert als.hot_rows(train, USER).count() < 30
    assert als.trace(train, 3, 0.01, 3)[0] == pytest.approx(plain, rel=1e-9)


def test_the_solver_keeps_few_iterations(spark, monkeypatch):
    """als_loss's, model_comparison's fit: shuffle files of at most two iterations, and the ratings are read once for the loss."""
    asked = {}
    solver = factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **kw: asked.update(kw) or solver(**kw))
    train = ratings(spark)
    fm = factors.fit(train, 2, 0.01, 2)
    assert asked["checkpointInterval"] <= 2
    seen = train.withColumn("rating", F.col("rating") + F.lit(0) * F.monotonically_increasing_id())
    plan = factors.loss(fm, seen)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("monotonically_increasing_id") == 2  # once for the means, once for the cells


def test_each_models_row_is_kept_before_the_other_is_made(spark, monkeypatch):
    """model_comparison: what the two models shuffle isn't on disk together."""
    from kinrank.plans import catalog
    kept, keep = [], catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df: kept.append(df.columns) or keep(df))
    out = catalog.queries()["model_comparison"](spark, "/root/testdata/sf0.001")
    assert kept.count(["model", "n_cells", "hits", "rmse"]) == 2
    assert [r["model"] for r in out.collect()] == ["nbcf", "als"]
