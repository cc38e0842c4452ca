"""Properties of the operators on the warehouse-derived ratings (sf0.001)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinrank.operators import evaluate, nbcf, neighbours, predict
from kinrank.operators.indexing import dense_index, explode_range
from kinrank.operators.pairs import pair_stats
from kinrank.operators.similarity import mirror, similarity
from kinrank.sources.ratings import ratings_from_events, ratings_from_orders

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return ratings_from_orders(spark, SF).cache()


@pytest.fixture(scope="module")
def events(spark):
    return ratings_from_events(spark, SF).cache()


def _rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("measure", ["corated", "overlap", "cosine"])
def test_similarity_bounds_and_order(orders, measure):
    s = similarity(orders, measure)
    agg = s.agg(F.min("similarity"), F.max("similarity"),
                F.sum(F.when(F.col("user_id") >= F.col("neighbour_id"), 1).otherwise(0))).first()
    assert agg[0] >= -1.0 - 1e-12 and agg[1] <= 1.0 + 1e-12
    assert agg[2] == 0


def test_mirror_is_symmetric(orders):
    sym = mirror(similarity(orders, "overlap"))
    back = sym.select(F.col("neighbour_id").alias("user_id"), F.col("user_id").alias("neighbour_id"),
                      "n_common", "similarity")
    assert _rows(sym) == _rows(back)


@pytest.mark.parametrize("measure", ["corated", "overlap", "cosine"])
def test_salted_hot_keys_match_plain_join(orders, measure):
    # A threshold of 3 makes almost every item hot: every pair must still
    # be produced exactly once with the same sums.
    plain = similarity(orders, measure, hot_threshold=None)
    salted = similarity(orders, measure, hot_threshold=3)
    assert _rows(plain) == _rows(salted)


def test_two_sided_pairs_match_one_sided(orders):
    one = pair_stats(orders, entity="user_id", through="item_id", value="rating", hot_threshold=None)
    two = pair_stats(orders, orders, entity="user_id", through="item_id", value="rating", hot_threshold=2)
    fwd = two.where("user_id < neighbour_id")
    assert _rows(one) == _rows(fwd.select(one.columns))


def test_item_mode_is_role_swap(spark, orders):
    swapped = orders.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), "rating")
    a = similarity(orders, "cosine", entity="item_id", through="user_id").withColumnRenamed("item_id", "user_id")
    b = similarity(swapped, "cosine")
    assert _rows(a) == _rows(b)


def test_top_neighbours_limits_and_threshold(orders):
    nb = neighbours.top_neighbours(similarity(orders, "overlap"), 4, 0.5)
    agg = nb.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert agg <= 4
    assert nb.where("similarity <= 0.5").count() == 0
    assert nb.where("user_id = neighbour_id").count() == 0


def test_threshold_before_rank_equals_after(orders):
    sims = similarity(orders, "overlap")
    first = neighbours.top_neighbours(sims, 5, 0.5)
    sym = mirror(sims)
    w = Window.partitionBy("user_id").orderBy(F.col("similarity").desc(), F.col("neighbour_id"))
    after = (sym.withColumn("rank", F.row_number().over(w))
             .where((F.col("rank") <= 5) & (F.col("similarity") > 0.5)))
    assert _rows(first, ["user_id", "neighbour_id", "rank"]) == _rows(after, ["user_id", "neighbour_id", "rank"])


def test_recommendations_exclude_rated(orders):
    train, test = evaluate.split(orders)
    nb = neighbours.top_neighbours(similarity(train, "overlap"), 10, 0.5)
    recs = predict.top_n(predict.exclude_rated(predict.predict_from_neighbours(nb, train), train), 5)
    assert recs.join(train, ["user_id", "item_id"]).count() == 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5


def test_sweep_point_equals_single_run(orders):
    train, test = evaluate.split(orders)
    sims = similarity(train, "overlap")
    sweep = {r["n"]: (r["hits"], r["rmse"]) for r in evaluate.rmse_by_n(sims, train, test, 2, 6).collect()}
    for n in (2, 4, 6):
        nb = neighbours.top_neighbours(sims, n, 0.5, test.select("user_id"))
        p = predict.top_n(predict.predict_from_neighbours(nb, train, items=test), 5)
        r = evaluate.rmse(p, test).first()
        assert sweep[n] == (r["hits"], r["rmse"])


def test_result_unchanged_under_repartition(orders):
    a = similarity(orders, "overlap")
    b = similarity(orders.repartition(7, "item_id"), "overlap")
    assert _rows(a) == _rows(b)


def test_split_is_a_partition(orders):
    train, test = evaluate.split(orders)
    assert train.count() + test.count() == orders.count()
    assert train.join(test, ["user_id", "item_id"]).count() == 0


def test_dense_index(spark):
    df = spark.createDataFrame([(v,) for v in [50, 7, 7, 3, 1000, 12, 50, -4]], "x bigint").repartition(3)
    got = sorted((r["x"], r["idx"]) for r in dense_index(df, "x").collect())
    assert got == [(-4, 1), (3, 2), (7, 3), (12, 4), (50, 5), (1000, 6)]


def test_explode_range(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, 10000)], "k int, up int")
    got = explode_range(df, "up", "i", chunk=7).groupBy("k").agg(F.count("i"), F.min("i"), F.max("i"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, 1, 5), (3, 10000, 1, 10000)]


@pytest.mark.parametrize("k", [3, 6])
@pytest.mark.parametrize("entity,through", [("user_id", "item_id"), ("item_id", "user_id")])
def test_catalogue_recommendation_matches_brute_force(spark, events, entity, through, k):
    """recommend_knn scores only cells reached by a similarity and fills the
    rest with the mean; brute force scores every unrated cell."""
    train, _ = evaluate.split(events)
    sims = similarity(train, "cosine", entity=entity, through=through)
    fast = nbcf.recommend_knn(train, sims, k, 4, entity=entity, through=through)
    cells = (train.select(entity).distinct().crossJoin(train.select(through).distinct())   # test only
             .join(train.select(entity, through), [entity, through], "left_anti"))
    scored = nbcf.predict_knn(cells, train, sims, k, entity=entity, through=through)
    w = Window.partitionBy(entity).orderBy(F.col("predicted_rating").desc(), F.col(through))
    brute = scored.withColumn("rank", F.row_number().over(w)).where("rank <= 4")
    cols = [entity, through, "predicted_rating", "rank"]
    assert _rows(fast, cols) == _rows(brute, cols)


def test_r1b_against_brute_force(events):
    """Rank among all other users (missing pair = 0), negatives last; with
    n close to the user count, negatives do enter the top n."""
    sims = similarity(events, "corated")
    users = sorted(r["user_id"] for r in events.select("user_id").distinct().collect())
    s = {}
    for r in sims.collect():
        s[(r["user_id"], r["neighbour_id"])] = s[(r["neighbour_id"], r["user_id"])] = r["similarity"]
    n = len(users) - 2
    want = set()
    for u in users:
        cand = sorted(((s.get((u, v), 0.0), v) for v in users if v != u), key=lambda t: (-t[0], t[1]))
        for rank, (sim, v) in enumerate(cand[:n], 1):
            if sim != 0.0:
                want.add((u, v, rank))
    got = neighbours.top_neighbours_all(sims, len(users), n)
    assert {(r["user_id"], r["neighbour_id"], r["rank"]) for r in got.collect()} == want
    assert got.where("similarity < 0").count() > 0


def test_measure_as_a_function(orders):
    """M7: a caller's own measure over the sum columns; here the overlap
    measure written out by hand must give the built-in's values."""
    def mine(c):
        return F.when((c["sum_xx"] > 0) & (c["sum_yy"] > 0),
                      c["sum_xy"] / (F.sqrt(c["sum_xx"]) * F.sqrt(c["sum_yy"]))).otherwise(F.lit(0.0))
    assert _rows(similarity(orders, mine)) == _rows(similarity(orders, "overlap"))


def test_corated_invariant_under_centring(orders):
    """Pearson over co-rated items does not change when each user's ratings
    are shifted by their mean (M1 on raw ratings = M1 on centred ratings)."""
    from kinrank.operators.centering import centered
    c = centered(orders).select("user_id", "item_id", F.col("centered").alias("rating"))
    a = {(r[0], r[1]): r[3] for r in similarity(orders, "corated").collect()}
    b = {(r[0], r[1]): r[3] for r in similarity(c, "corated").collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_catalogue_recommendation_for_a_subset(spark, events):
    """Asking for some users gives exactly their rows of the full result."""
    train, _ = evaluate.split(events)
    sims = similarity(train, "cosine")
    full = nbcf.recommend_knn(train, sims, 4, 5)
    some = train.select("user_id").distinct().orderBy("user_id").limit(4)
    sub = nbcf.recommend_knn(train, sims, 4, 5, entities=some)
    want = full.join(some, "user_id", "left_semi")
    cols = ["user_id", "item_id", "predicted_rating", "rank"]
    assert _rows(sub, cols) == _rows(want, cols)
    assert sub.select("user_id").distinct().count() == 4
