"""Ratings as a Structured Streaming source, with running per-user state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.schema import RATING, RATINGS_SCHEMA, USER


def ratings_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files_per_trigger: int = 100) -> DataFrame:
    """New ratings files under ``path`` as an unbounded table (fixed schema,
    no inference)."""
    return (spark.readStream.format(fmt).schema(RATINGS_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def running_user_stats(stream: DataFrame) -> DataFrame:
    """Per-user count, sum and mean over all ratings seen so far (a stateful
    aggregate; run with ``outputMode("update")`` or ``"complete"``)."""
    return stream.groupBy(USER).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(RATING).alias("rating_sum"),
                                    F.avg(RATING).alias("mean_rating"))


def running_rater_quality(stream: DataFrame) -> DataFrame:
    """Constant raters (C1) kept current as ratings arrive: a user is constant
    while all of their ratings are equal (max = min, which also covers a
    single rating). State per user is four numbers, so it does not grow with
    the user's history; ``update`` mode emits only users whose state changed."""
    agg = stream.groupBy(USER).agg(F.count(F.lit(1)).alias("rating_count"),
                                   F.min(RATING).alias("min_rating"),
                                   F.max(RATING).alias("max_rating"),
                                   F.avg(RATING).alias("mean_rating"))
    return agg.withColumn("constant", F.col("min_rating") == F.col("max_rating"))
