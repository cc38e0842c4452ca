"""Any 64-bit id, any rating scale, whole results."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import centering, evaluate, factors, predict, quality
from kinrank.operators.similarity import similarity
from kinrank.operators.skew import salted_join, hot_keys
from kinrank.sources import ratings as src

WIDE = 9_000_000_000_000_000_000


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(WIDE + u, -WIDE - i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9) if (u + 2 * i) % 4]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")


def test_csv_keeps_wide_ids_and_doubles(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("index,uid,iid,stars\n0,3000000000,9000000000000000000,4.1\n")
    for infer in (False, True):
        row = src.read_ratings_csv(spark, str(p), infer, user="uid", item="iid", rating="stars").first()
        assert tuple(row) == (3000000000, 9000000000000000000, 4.1)
    p.write_text("index,user,item,rating\n0,x7,2,4.1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        src.read_ratings_csv(spark, str(p)).collect()


def test_split_and_fraction_take_wide_ids(wide):
    train, test = evaluate.split(wide)
    assert train.count() + test.count() == wide.count() and test.count() > 0
    rows = test.withColumn("predicted_rating", F.col("rating"))
    assert evaluate.rmse_by_fraction(rows).where("fraction = 100").first()["n_cells"] == test.count()


def test_factor_model_takes_wide_ids(wide):
    fm = factors.fit(wide, rank=2, max_iter=2)
    cells = wide.limit(5).unionByName(wide.limit(1).withColumn("user_id", F.lit(5).cast("bigint")))
    got = factors.evaluate(fm, cells)
    assert got.count() == 6 and got.where("scored").count() == 5
    assert factors.loss(fm, wide).first()["n_users"] == 12
    recs = factors.recommend(fm, wide, 3)
    assert recs.join(wide, ["user_id", "item_id"], "left_semi").count() == 0
    assert recs.select("user_id").distinct().count() == 6        # the odd users rated all nine items
    assert factors.recommend(fm, wide, 3, wide.where("false")).count() == 0


@pytest.mark.parametrize("trace, stop", [
    ([5.0], False), ([5.0, 4.0], False), ([5.0, 5.0], True), ([5, 4, 3, 2.0, 4.5], True), ([1, 4, 3, 2.0, 3.9], False)])
def test_stopping_rule(trace, stop):
    assert factors.stops(trace, 1e-8) is stop


def test_profile_counts_add_up_on_any_scale(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 2.5), (1, 3, 5.0), (1, 4, 7.0), (1, 5, -1.0)], "user_id bigint, item_id bigint, rating double")
    r = centering.profiles(df).first()
    assert sum(r[f"n_rated_{v}"] for v in range(6)) == r["n_ratings"] == 5
    assert (r["n_rated_0"], r["n_rated_2"], r["n_rated_5"]) == (2, 1, 2)


def test_reports_are_whole(spark):
    df = spark.createDataFrame([(u, i, 3.0) for u in range(200) for i in range(2)], "user_id bigint, item_id bigint, rating double")
    assert quality.constant_rater_values(df).count() == 200
    long = spark.createDataFrame([(1, i, 3.0) for i in range(50)], "user_id bigint, item_id bigint, rating double")
    hist = predict.history_with_count(long)
    assert hist.count() == 50 and hist.first()["n_rated"] == 50
    preds = long.withColumn("predicted_rating", -F.col("item_id").cast("double"))
    out = predict.recommend_with_history(preds, long.where("item_id < 30"), 5)
    assert sorted(r.item_id for r in out.collect()) == [30, 31, 32, 33, 34]


def test_min_common_holds_for_every_measure(golden):
    for measure in ("corated", "overlap", "cosine"):
        assert similarity(golden, measure, min_common=3).where("n_common < 3").count() == 0
        assert similarity(golden, measure, min_common=3).count() < similarity(golden, measure).count()


def test_hot_table_beyond_the_broadcast_limit(spark):
    left = spark.range(400).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(60).select((F.col("id") % 2).cast("int").alias("k"), F.col("id").alias("b"))
    hot = hot_keys(left, right, "k", 20)
    want = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(left, right, "k", "a", "b", hot, 2, broadcast_limit=1).select("k", "a", "b")
        plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
        rows_by_key_alone = [x for x in plan.splitlines() if "hashpartitioning(k#" in x and "_part" not in x and "_p#" not in x]
        assert sorted(map(tuple, out.collect())) == want
        # only the counts per key are dealt by the bare key
        assert all("ENSURE_REQUIREMENTS" in x for x in rows_by_key_alone)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
