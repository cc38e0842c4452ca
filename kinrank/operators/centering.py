"""Per-entity statistics, mean-centring and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.schema import ITEM, RATING, USER

PROFILE_TOP = 5


def entity_stats(ratings: DataFrame, entity: str = USER) -> DataFrame:
    """``entity, n, rating_sum, rating_sq_sum, mean_rating`` in one partial+final
    hash aggregate. A user with a third of all rows is still one map-side
    partial sum per task, never one task holding the group."""
    return ratings.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(RATING).alias("rating_sum"),
        F.sum(F.col(RATING) * F.col(RATING)).alias("rating_sq_sum"),
        F.avg(RATING).alias("mean_rating"))


def user_means(ratings: DataFrame, entity: str = USER) -> DataFrame:
    """Mean rating per user (A1): ``user_id, n, rating_sum, mean_rating``."""
    return entity_stats(ratings, entity).select(entity, "n", "rating_sum", "mean_rating")


def centered(ratings: DataFrame, entity: str = USER, stats: DataFrame | None = None,
             with_norm: bool = False) -> DataFrame:
    """Ratings with the entity's mean subtracted.

    Adds ``mean_rating``, ``n`` and ``centered = rating - mean`` plus the
    scaled deviation ``dev = n*rating - rating_sum`` (= n * centered). The
    scaled form is exact for integer-valued ratings, and every similarity
    below is a ratio in which the factor n cancels.

    ``with_norm`` adds ``norm2``, the sum of squared scaled deviations over
    all of the entity's ratings: sum (n r - s)^2 = n (n q - s^2), q = sum r^2.

    Join of the ratings with the per-entity aggregate, not a window: the
    window would put all of one entity's rows into one task.
    """
    st = stats if stats is not None else entity_stats(ratings, entity)
    out = (ratings.join(st.select(entity, "n", "rating_sum", "rating_sq_sum", "mean_rating"), entity)
           .withColumn("centered", F.col(RATING) - F.col("mean_rating"))
           .withColumn("dev", F.col("n") * F.col(RATING) - F.col("rating_sum")))
    if with_norm:
        out = out.withColumn("norm2", F.col("n") * (F.col("n") * F.col("rating_sq_sum")
                                                    - F.col("rating_sum") * F.col("rating_sum")))
    return out.drop("rating_sq_sum")


def profiles(ratings: DataFrame, entity: str = USER) -> DataFrame:
    """Profile of each user (or item): a fixed-width summary vector of its
    ratings (A1b). Fixed width keeps a very active entity from becoming one
    unbounded array in one task; the full profile is the long ratings table
    itself, clustered by ``entity``. ``n_rated_v`` counts ratings from v up to
    below v + 1 (the first also lower ones, the last also higher ones), so
    these counts add up to ``n_ratings`` on any scale."""
    other = ITEM if entity == USER else USER
    whole = F.least(F.lit(PROFILE_TOP), F.greatest(F.lit(0), F.floor(RATING)))
    return ratings.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct(other).alias(f"n_{'items' if entity == USER else 'users'}"),
        F.avg(RATING).alias("mean_rating"),
        F.stddev_samp(RATING).alias("std_rating"),
        F.min(RATING).alias("min_rating"),
        F.max(RATING).alias("max_rating"),
        F.countDistinct(RATING).alias("n_distinct_ratings"),
        *[F.sum(F.when(whole == v, 1).otherwise(0)).cast("bigint").alias(f"n_rated_{v}")
          for v in range(PROFILE_TOP + 1)])
