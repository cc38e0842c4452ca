"""Ratings as a stream: running per-user statistics."""

import tempfile

import pytest

from kinrank.streaming import ratings_stream, running_user_stats


def test_running_user_stats(spark, golden):
    d = tempfile.mkdtemp(prefix="kinrank-stream-")
    golden.write.mode("overwrite").parquet(d + "/in")
    q = (running_user_stats(ratings_stream(spark, d + "/in")).writeStream
         .outputMode("complete").format("memory").queryName("kinrank_user_stats")
         .option("checkpointLocation", d + "/ckpt").start())
    q.processAllAvailable()
    q.stop()
    got = {r["user_id"]: (r["n"], r["mean_rating"]) for r in spark.sql("SELECT * FROM kinrank_user_stats").collect()}
    assert got[1] == (3, pytest.approx(3.0)) and got[3] == (4, pytest.approx(2.75)) and got[5] == (1, 4.0)


def test_running_constant_raters_over_two_batches(spark, golden):
    from kinrank.streaming import running_rater_quality

    d = tempfile.mkdtemp(prefix="kinrank-stream-")
    golden.where("user_id <> 3").write.mode("overwrite").parquet(d + "/in/batch=1")
    q = (running_rater_quality(ratings_stream(spark, d + "/in", max_files_per_trigger=1)).writeStream
         .outputMode("complete").format("memory").queryName("kinrank_quality")
         .option("checkpointLocation", d + "/ckpt").start())
    q.processAllAvailable()
    first = {r["user_id"]: r["constant"] for r in spark.sql("SELECT * FROM kinrank_quality").collect()}
    # a later batch: user 4 now rates something different, user 3 arrives
    extra = spark.createDataFrame([(4, 9, 5.0), (3, 1, 1.0), (3, 2, 3.0)],
                                  "user_id bigint, item_id bigint, rating double")
    extra.write.mode("overwrite").parquet(d + "/in/batch=2")
    q.processAllAvailable()
    q.stop()
    second = {r["user_id"]: r["constant"] for r in spark.sql("SELECT * FROM kinrank_quality").collect()}
    assert first == {1: False, 2: False, 4: True, 5: True}
    assert second == {1: False, 2: False, 3: False, 4: False, 5: True}
