"""Rater quality: constant and biased raters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.constants import BIASED_MAX_ITEMS
from kinrank.schema import ITEM, RATING, USER


def rater_std(ratings: DataFrame) -> DataFrame:
    """``user_id, rating_count, std_rating`` (sample stddev; NULL for one rating)."""
    return ratings.groupBy(USER).agg(F.count(F.lit(1)).alias("rating_count"),
                                     F.stddev_samp(RATING).alias("std_rating"))


def _is_constant(c="std_rating"):
    return F.col(c).isNull() | (F.col(c) == F.lit(0.0))


def constant_raters(ratings: DataFrame) -> DataFrame:
    """Users whose ratings never vary (C1): stddev 0, or a single rating."""
    return rater_std(ratings).where(_is_constant())


def constant_rater_summary(ratings: DataFrame) -> DataFrame:
    """Total users, constant raters and their percentage (C2): one pass."""
    s = rater_std(ratings)
    return s.agg(F.count(F.lit(1)).alias("total_users"),
                 F.sum(F.when(_is_constant(), 1).otherwise(0)).cast("bigint").alias("constant_users"),
                 (F.avg(F.when(_is_constant(), 1.0).otherwise(0.0)) * F.lit(100.0)).alias("percent"))


def constant_rater_values(ratings: DataFrame) -> DataFrame:
    """Every constant rater with their (distinct) rating value."""
    c = constant_raters(ratings)
    vals = ratings.select(USER, RATING).join(c, USER, "left_semi").distinct()
    return vals.join(c.select(USER, "rating_count"), USER).select(USER, "rating_count", RATING)


def without_constant_raters(ratings: DataFrame) -> DataFrame:
    """Ratings of the remaining users (C4): anti join, never a driver-side list."""
    return ratings.join(constant_raters(ratings).select(USER), USER, "left_anti")


def valid_users(ratings: DataFrame) -> DataFrame:
    return rater_std(ratings).where(~_is_constant()).select(USER)


def rater_behaviour(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy(USER).agg(F.countDistinct(RATING).alias("distinct_ratings"),
                                     F.countDistinct(ITEM).alias("num_rated_items"))


def _is_biased(max_items: int):
    return (F.col("distinct_ratings") == F.lit(1)) | (F.col("num_rated_items") <= F.lit(max_items))


def biased_raters(ratings: DataFrame, max_items: int = BIASED_MAX_ITEMS) -> DataFrame:
    """Users with a single rating value or at most ``max_items`` items."""
    return rater_behaviour(ratings).where(_is_biased(max_items))


def biased_rater_summary(ratings: DataFrame, max_items: int = BIASED_MAX_ITEMS) -> DataFrame:
    b = rater_behaviour(ratings)
    return b.agg(F.count(F.lit(1)).alias("total_users"),
                 F.sum(F.when(_is_biased(max_items), 1).otherwise(0)).cast("bigint").alias("biased_users"),
                 (F.avg(F.when(_is_biased(max_items), 1.0).otherwise(0.0)) * F.lit(100.0)).alias("percent"))
