"""Similarity measures (M1-M7) over co-rated pair statistics.

All three measures are ratios of sums over shared keys, computed from
``pair_stats``. For integer-valued ratings every sum is an exact integer, so
the result is the same on any engine and any partitioning:

* ``corated`` (M1): Pearson over the common items, re-centred on them.
* ``overlap`` (M2): centred by the user's mean over all their ratings,
  products and norms restricted to the common items.
* ``cosine``  (M3): centred cosine, norms over all of each user's ratings.

Centring uses the scaled deviation ``dev = n*r - sum`` (``n`` times the
centred rating); the factor ``n`` cancels in every ratio.

``entity="item_id", through="user_id"`` gives item-item similarity (M4), with
means per item.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.functions.columns import cosine_from_sums, overlap_from_sums, pearson_from_sums
from kinrank.operators import gather
from kinrank.operators.centering import centered, entity_stats
from kinrank.operators.pairs import ALL_STATS, DEFAULT_HOT_THRESHOLD, SPREAD_STATS, pair_stats
from kinrank.schema import ITEM, NEIGHBOUR, RATING, SIM, USER
from kinrank.session import materialize

MEASURES = ("corated", "overlap", "cosine")


def _prepared(ratings: DataFrame, entity: str) -> DataFrame:
    return centered(ratings, entity, entity_stats(ratings, entity), with_norm=True)


def similarity(ratings: DataFrame, measure: str | Callable[[dict], Column] = "overlap", *,
               entity: str = USER, through: str = ITEM, other: DataFrame | None = None,
               min_common: int = 1, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Pairwise similarity ``entity, neighbour_id, n_common, similarity``.

    ``other=None``: every unordered co-rating pair once, ``entity < neighbour``.
    ``other`` given (R9): each entity of ``ratings`` against every entity of
    ``other``. ``measure`` is a name from ``MEASURES`` or a function of the
    dict of sum columns (``n_common, sum_x, ...``, ``norm_l, norm_r``) (M7).
    Pairs with fewer than ``min_common`` shared keys are left out; Pearson is
    0 for those kept with fewer than two.
    """
    kw = dict(entity=entity, through=through, hot_threshold=hot_threshold)
    if measure == "corated":
        # Pearson is shift-invariant: raw ratings give the same value as centred ones.
        ps = pair_stats(ratings, other, value=RATING, stats=ALL_STATS + SPREAD_STATS, **kw)
        sim = pearson_from_sums("n_common", "sum_x", "sum_y", "sum_xy", "sum_xx", "sum_yy",
                                spread_x="spread_x", spread_y="spread_y")
    else:
        left = _prepared(ratings, entity)
        right = _prepared(other, entity) if other is not None else None
        if measure == "overlap":
            ps = pair_stats(left, right, value="dev", stats=("n_common", "sum_xy", "sum_xx", "sum_yy"), **kw)
            sim = overlap_from_sums("sum_xy", "sum_xx", "sum_yy")
        elif measure == "cosine":
            ps = pair_stats(left, right, value="dev", stats=("n_common", "sum_xy"),
                            carry_left=["norm2"], carry_right=["norm2"], **kw)
            sim = cosine_from_sums("sum_xy", "norm2_l", "norm2_r")
        elif callable(measure):
            ps = pair_stats(left, right, value="dev", carry_left=["norm2"], carry_right=["norm2"], **kw)
            cols = {c: F.col(c) for c in ps.columns}
            cols["norm_l"], cols["norm_r"] = F.col("norm2_l"), F.col("norm2_r")
            sim = measure(cols)
        else:
            raise ValueError(f"unknown measure {measure!r}; use one of {MEASURES} or a function")
    out = ps.select(entity, NEIGHBOUR, "n_common", sim.cast("double").alias(SIM))
    if min_common > 1:
        out = out.where(F.col("n_common") >= F.lit(min_common))
    return out


def all_pairs(ratings: DataFrame, measure: str, *, entity: str = USER, through: str = ITEM) -> DataFrame:
    """The rows of ``similarity(ratings, measure)``. On sparse ratings sums are added
    up where an entity's lists meet (``gather``), and no pair is shuffled; entities
    that may have very many pairs, and dense ratings, go the plain way."""
    shape = gather.Shape(ratings, entity, through)
    if not shape.fits():
        return similarity(ratings, measure, entity=entity, through=through)
    bound = shape.heavy()
    light, many = ratings, None
    if bound is not None:
        many = materialize(ratings.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound).select(entity))
        light = ratings.join(many, entity, "left_anti")
    if measure == "corated":
        out = gather.unordered(light, shape, measure, entity, through, (RATING,))
    else:
        out = gather.unordered(_prepared(light, entity), shape, measure, entity, through, ("dev", "norm2") if measure == "cosine" else ("dev",))
    if many is None:
        return out
    sims = similarity(ratings.join(many, entity, "left_semi"), measure, entity=entity, through=through, other=ratings)
    both = many.select(F.col(entity).alias(NEIGHBOUR), F.lit(True).alias("_many"))
    once = sims.join(both, NEIGHBOUR, "left").where(F.col("_many").isNull() | (F.col(entity) < F.col(NEIGHBOUR)))
    return out.unionByName(once.select(F.least(entity, NEIGHBOUR).alias(entity), F.greatest(entity, NEIGHBOUR).alias(NEIGHBOUR), "n_common", SIM))


def mirror(sims: DataFrame, entity: str = USER, include_self: bool = False,
           entities: DataFrame | None = None) -> DataFrame:
    """Both directions of each unordered pair, optionally with self = 1.0 (M5)."""
    cols = [c for c in sims.columns if c not in (entity, NEIGHBOUR)]
    fwd = sims.select(entity, NEIGHBOUR, *cols)
    back = sims.select(F.col(NEIGHBOUR).alias(entity), F.col(entity).alias(NEIGHBOUR), *cols)
    out = fwd.unionByName(back)
    if include_self:
        src = entities if entities is not None else sims.select(entity).union(
            sims.select(F.col(NEIGHBOUR).alias(entity)))
        selfs = src.select(entity).distinct().select(
            entity, F.col(entity).alias(NEIGHBOUR),
            *[(F.lit(None).cast("bigint") if c == "n_common" else F.lit(1.0)).alias(c) for c in cols])
        out = out.unionByName(selfs)
    return out
