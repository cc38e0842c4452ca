"""Readers and shape operators."""

import os
import tempfile

from kinrank.sources import ratings as src


def test_csv_with_header_and_schema(spark):
    d = tempfile.mkdtemp(prefix="kinrank-csv-")
    p = os.path.join(d, "ratings.csv")
    with open(p, "w") as f:
        f.write("index,user,item,rating\n0,73,52,4\n1,36,239,3\n2,72,26,1\n")
    df = src.read_ratings_csv(spark, p)
    assert df.columns == ["user_id", "item_id", "rating"]
    assert sorted(tuple(r) for r in df.collect()) == [(36, 239, 3.0), (72, 26, 1.0), (73, 52, 4.0)]
    inferred = src.read_ratings_csv(spark, p, infer_schema=True)
    assert sorted(tuple(r) for r in inferred.collect()) == sorted(tuple(r) for r in df.collect())


def test_tsv_without_header(spark):
    d = tempfile.mkdtemp(prefix="kinrank-tsv-")
    p = os.path.join(d, "ub.base")
    with open(p, "w") as f:
        f.write("1\t1\t5\t874965758\n1\t2\t3\t876893171\n2\t1\t4\t888550871\n")
    df = src.read_ratings_tsv(spark, p)
    assert df.columns == ["user_id", "item_id", "rating"]
    assert df.count() == 3


def test_utility_matrix_merges_duplicates(spark):
    ev = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (1, 2, 1.0)], "user_id bigint, item_id bigint, rating double")
    got = {(r["user_id"], r["item_id"]): (r["rating"], r["n_events"]) for r in src.utility_matrix(ev, "sum").collect()}
    assert got == {(1, 1): (5.0, 2), (1, 2): (1.0, 1)}
    got = {(r["user_id"], r["item_id"]): r["rating"] for r in src.utility_matrix(ev, "max").collect()}
    assert got[(1, 1)] == 3.0


def test_profile(golden):
    p = src.ratings_profile(golden).first()
    assert (p["n_ratings"], p["n_users"], p["n_items"], p["max_user_id"], p["max_item_id"]) == (14, 5, 5, 5, 5)


def test_orders_form_shape(spark):
    r = src.ratings_from_orders(spark, "/root/testdata/sf0.001")
    agg = r.agg({"rating": "min"}).first()[0], r.agg({"rating": "max"}).first()[0]
    assert agg == (1.0, 5.0)
    assert r.groupBy("user_id", "item_id").count().where("count > 1").count() == 0
