"""Co-rated pair statistics (J2, A3) with hot-key splitting.

The pair statistics of two entities (two users sharing items, or two items
sharing users) are sums over the keys they share:

    n_common, sum_x, sum_y, sum_xy, sum_xx, sum_yy

They come from an equi-join of the long ratings table with itself on the
shared key, followed by a partial+final hash aggregate on the pair.

Scale. A key with m raters yields m*(m-1)/2 pair rows. When a key is hot
(more than ``hot_threshold`` rows on a side) its rows are split into
``ceil(m / hot_threshold)`` chunks by a hash of the entity; each chunk of the
left side meets each chunk of the right side in its own join cell, so no task
ever holds more than ``hot_threshold`` x ``hot_threshold`` pairs of one key.
The hot-key table is broadcast only after its row count has been checked;
beyond ``broadcast_limit`` it is shuffle-joined. With no hot key the plain
self-join is used, whose two sides share one exchange (``ReusedExchange``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators.skew import (DEFAULT_BROADCAST_LIMIT, DEFAULT_HOT_THRESHOLD, join_profile,
                                   output_partitions, salted_join)
from kinrank.schema import NEIGHBOUR
from kinrank.session import parallelism

ALL_STATS = ("n_common", "sum_x", "sum_y", "sum_xy", "sum_xx", "sum_yy")
SPREAD_STATS = ("spread_x", "spread_y")


def _side(df: DataFrame, entity: str, through: str, value: str, carry: list[str],
          ent_alias: str, val_alias: str, carry_suffix: str) -> DataFrame:
    return df.select(F.col(entity).alias(ent_alias), F.col(through).alias("_t"),
                     F.col(value).cast("double").alias(val_alias),
                     *[F.col(c).alias(c + carry_suffix) for c in carry])


def pair_rows(left: DataFrame, right: DataFrame | None = None, *, entity: str, through: str,
              value: str, carry_left: list[str] | None = None, carry_right: list[str] | None = None,
              hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
              broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Joined pair rows ``_a, _b, _t, _x, _y`` (+ carried columns).

    ``right=None``: pairs within ``left`` with ``_a < _b``.
    ``right`` given: every ``_a`` of ``left`` against every other ``_b`` of ``right``.
    """
    carry_left = carry_left or []
    carry_right = carry_right if carry_right is not None else (carry_left if right is None else [])
    self_mode = right is None
    L = _side(left, entity, through, value, carry_left, "_a", "_x", "_l")
    R = _side(right if right is not None else left, entity, through, value, carry_right, "_b", "_y", "_r")
    cond = (F.col("_a") < F.col("_b")) if self_mode else (F.col("_a") != F.col("_b"))

    spark = left.sparkSession
    n_hot, hot, n = 0, None, parallelism(spark)
    if hot_threshold is not None:
        hot, n_hot, rows = join_profile(L.select("_t"), R.select("_t"), "_t", hot_threshold)
        n = output_partitions(spark, rows // 2 if self_mode else rows)
    if n_hot:
        return salted_join(L, R, "_t", "_a", "_b", hot, n_hot, cond, broadcast_limit, n)
    if self_mode:
        # Plain self-join of one expression: both sides share one exchange on
        # the key, with an explicit count sized by the pair count.
        base = left.select(F.col(entity).alias("_e"), F.col(through).alias("_t"),
                           F.col(value).cast("double").alias("_v"), *carry_left)
        base = base.repartition(n, "_t")
        a, b = base.alias("a"), base.alias("b")
        j = a.join(b, (F.col("a._t") == F.col("b._t")) & (F.col("a._e") < F.col("b._e")))
        return j.select(F.col("a._e").alias("_a"), F.col("b._e").alias("_b"),
                        F.col("a._t").alias("_t"), F.col("a._v").alias("_x"),
                        F.col("b._v").alias("_y"),
                        *[F.col("a." + c).alias(c + "_l") for c in carry_left],
                        *[F.col("b." + c).alias(c + "_r") for c in carry_right])
    return L.repartition(n, "_t").join(R.repartition(n, "_t"), "_t").where(cond)


def pair_stats(left: DataFrame, right: DataFrame | None = None, *, entity: str, through: str,
               value: str, stats=ALL_STATS, carry_left: list[str] | None = None,
               carry_right: list[str] | None = None,
               hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
               broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Sufficient statistics per entity pair: ``entity, neighbour_id`` and
    the requested sums (carried per-entity columns come back as ``<c>_l``,
    ``<c>_r``). ``right=None`` gives each unordered pair once (entity < neighbour)."""
    carry_left = carry_left or []
    carry_right = carry_right if carry_right is not None else (carry_left if right is None else [])
    rows = pair_rows(left, right, entity=entity, through=through, value=value,
                     carry_left=carry_left, carry_right=carry_right,
                     hot_threshold=hot_threshold, broadcast_limit=broadcast_limit)
    x, y = F.col("_x"), F.col("_y")
    exprs = {
        "n_common": F.count(F.lit(1)).alias("n_common"),
        "sum_x": F.sum(x).alias("sum_x"),
        "sum_y": F.sum(y).alias("sum_y"),
        "sum_xy": F.sum(x * y).alias("sum_xy"),
        "sum_xx": F.sum(x * x).alias("sum_xx"),
        "sum_yy": F.sum(y * y).alias("sum_yy"),
        "spread_x": (F.max(x) - F.min(x)).alias("spread_x"),
        "spread_y": (F.max(y) - F.min(y)).alias("spread_y"),
    }
    aggs = [exprs[s] for s in stats]
    aggs += [F.max(c + "_l").alias(c + "_l") for c in carry_left]
    aggs += [F.max(c + "_r").alias(c + "_r") for c in carry_right]
    return (rows.groupBy("_a", "_b").agg(*aggs)
            .withColumnRenamed("_a", entity).withColumnRenamed("_b", NEIGHBOUR))


def co_rated_counts(ratings: DataFrame, entity: str, through: str, **kw) -> DataFrame:
    """Number of shared keys per unordered entity pair."""
    return pair_stats(ratings, entity=entity, through=through, value=through,
                      stats=("n_common",), **kw)
