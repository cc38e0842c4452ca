"""Hot-key splitting gives exactly the plain join's rows."""

from pyspark.sql import functions as F

from kinrank.operators import evaluate, neighbours, predict
from kinrank.operators.similarity import similarity
from kinrank.operators.skew import hot_keys, split_join
from kinrank.sources.ratings import ratings_from_orders


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_join_with_one_hot_key(spark):
    # Key 0 holds a third of each side: it becomes 2 x 3 chunk cells.
    def key(c):
        return F.when(c % 3 == 0, F.lit(0)).otherwise(c % 50 + 1).cast("bigint").alias("k")
    left = spark.range(0, 300).select(key(F.col("id")), F.col("id").alias("a"))
    right = spark.range(0, 400).select(key(F.col("id")), (F.col("id") + 1000).alias("b"))
    hot = hot_keys(left, right, "k", 50).collect()
    assert [r["k"] for r in hot] == [0]
    plain = left.join(right, "k").where("a + b > 1100")
    split = split_join(left, right, "k", "a", "b", F.col("a") + F.col("b") > 1100, hot_threshold=50)
    assert _rows(split.select("k", "a", "b")) == _rows(plain.select("k", "a", "b"))


def test_predictions_with_split_neighbour_join(spark):
    r = ratings_from_orders(spark, "/root/testdata/sf0.001").cache()
    train, test = evaluate.split(r)
    nb = neighbours.top_neighbours(similarity(train, "overlap"), 10, 0.0, test.select("user_id"))
    a = predict.predict_from_neighbours(nb, train, hot_threshold=None)
    b = predict.predict_from_neighbours(nb, train, hot_threshold=4)
    assert _rows(a) == _rows(b)


def test_hot_item_spreads_over_tasks(spark):
    """One item rated by every user: the plain self-join makes all of its
    pairs in one task; the split spreads them over chunk-pair cells."""
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from skew_check import hot_ratings, spread
    from kinrank.operators.pairs import pair_rows

    r = hot_ratings(spark, "/root/testdata/sf0.001")
    total_p, largest_p, _ = spread(pair_rows(r, entity="user_id", through="item_id", value="rating",
                                             hot_threshold=None))
    total_s, largest_s, tasks = spread(pair_rows(r, entity="user_id", through="item_id", value="rating",
                                                 hot_threshold=16))
    assert total_p == total_s
    assert largest_s < largest_p
    assert largest_s <= 1.3 * total_s / tasks        # balanced: no task far above the mean


def test_join_profile_counts_joined_rows(spark):
    from kinrank.operators.skew import join_profile, output_partitions, ROWS_PER_TASK
    left = spark.range(0, 500).select((F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 300).select((F.col("id") % 11).alias("k"), F.col("id").alias("b"))
    hot, n_hot, rows = join_profile(left, right, "k", 60)
    assert rows == left.join(right, "k").count()
    assert n_hot == hot.count() == 7           # every shared key has more than 60 left rows
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert output_partitions(spark, 0) == base
    assert output_partitions(spark, 1000 * ROWS_PER_TASK) == max(base, 1000)


def test_operators_give_the_same_rows_with_every_key_hot(spark):
    """A threshold of 2 makes nearly every join key hot, so each operator runs
    its split path; the rows must equal the plain path's."""
    from kinrank.operators import nbcf
    from kinrank.sources.ratings import ratings_from_events

    ev = ratings_from_events(spark, "/root/testdata/sf0.001").cache()
    etrain, etest = evaluate.split(ev)
    sims = similarity(etrain, "cosine")
    cells = etest.select("user_id", "item_id", "rating")
    assert _rows(nbcf.predict_knn(cells, etrain, sims, 5, hot_threshold=None)) == \
        _rows(nbcf.predict_knn(cells, etrain, sims, 5, hot_threshold=2))
    assert _rows(nbcf.recommend_knn(etrain, sims, 5, 4, hot_threshold=None)) == \
        _rows(nbcf.recommend_knn(etrain, sims, 5, 4, hot_threshold=2))

    r = ratings_from_orders(spark, "/root/testdata/sf0.001").cache()
    train, test = evaluate.split(r)
    nb = neighbours.top_neighbours(similarity(train, "overlap"), 16, 0.0, test.select("user_id"))
    assert _rows(evaluate.sweep(nb, train, test, 2, 16, hot_threshold=None)) == \
        _rows(evaluate.sweep(nb, train, test, 2, 16, hot_threshold=2))
    assert _rows(predict.unrated_candidates(nb, train, hot_threshold=None)) == \
        _rows(predict.unrated_candidates(nb, train, hot_threshold=2))
