"""Scalar column expressions.

All of them are plain ``pyspark.sql.functions`` expressions, so they stay
inside whole-stage code generation. Divisions are always guarded: under
Spark's ANSI default a bare division by zero raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinrank.constants import (CLIP_HIGH, CLIP_LOW, PEARSON_MIN_COMMON, PEARSON_MIN_STD,
                               SPLIT_BUCKETS, SPLIT_ITEM_MULT, SPLIT_TRAIN_BUCKETS,
                               SPLIT_USER_MULT)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num, den, otherwise: float | None = 0.0) -> Column:
    """``num / den`` where ``den > 0``, else ``otherwise``."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num / den).otherwise(F.lit(otherwise).cast("double"))


def clip(c, lo: float = CLIP_LOW, hi: float = CLIP_HIGH) -> Column:
    """Clamp into ``[lo, hi]`` (P10)."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(c)))


def round6(c) -> Column:
    """Round to 6 decimals; applied to values summed in engine-dependent order
    (predictions, errors) so results and rankings do not depend on it."""
    return F.round(_c(c), 6)


def hash_bucket(user_col="user_id", item_col="item_id", buckets: int = SPLIT_BUCKETS,
                user_mult: int = SPLIT_USER_MULT, item_mult: int = SPLIT_ITEM_MULT) -> Column:
    """Deterministic bucket of a (user, item) cell. Independent of partitioning,
    so a split is the same on any cluster size (``randomSplit`` is not). Ids
    are reduced before they are multiplied, so any 64-bit id fits."""
    reduced = lambda c, mult: F.pmod(_c(c), F.lit(buckets)) * F.lit(mult % buckets)
    return F.pmod(reduced(user_col, user_mult) + reduced(item_col, item_mult), F.lit(buckets))


def in_train(user_col="user_id", item_col="item_id", train_buckets: int = SPLIT_TRAIN_BUCKETS,
             buckets: int = SPLIT_BUCKETS) -> Column:
    return hash_bucket(user_col, item_col, buckets) < F.lit(train_buckets)


def pearson_from_sums(n, sx, sy, sxy, sxx, syy, min_common: int = PEARSON_MIN_COMMON,
                      min_std: float = PEARSON_MIN_STD, spread_x=None, spread_y=None) -> Column:
    """Pearson correlation over co-rated items from the six sufficient sums (M1).

    0 unless at least ``min_common`` common items and both population
    standard deviations exceed ``min_std``; clipped to [-1, 1]. ``spread_x``
    / ``spread_y`` (max - min of each side over the common items) detect a
    constant side exactly; the one-pass variance ``n*sxx - sx^2`` is exact for
    integer-valued ratings but, for other values, cancellation can leave a
    tiny positive remainder where the true variance is 0.
    """
    n, sx, sy, sxy, sxx, syy = map(_c, (n, sx, sy, sxy, sxx, syy))
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    cov = n * sxy - sx * sy
    ok = (n >= min_common) & (vx > 0) & (vy > 0) & \
         (F.sqrt(vx) / n > min_std) & (F.sqrt(vy) / n > min_std)
    if spread_x is not None:
        ok = ok & (_c(spread_x) > 0)
    if spread_y is not None:
        ok = ok & (_c(spread_y) > 0)
    r = cov / (F.sqrt(vx) * F.sqrt(vy))
    return F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).otherwise(F.lit(0.0))


def overlap_from_sums(sxy, sxx, syy) -> Column:
    """Mean-centred similarity restricted to the common items (M2):
    ``sum(x*y) / (sqrt(sum x^2) * sqrt(sum y^2))``, 0 for a zero norm."""
    sxy, sxx, syy = map(_c, (sxy, sxx, syy))
    return F.when((sxx > 0) & (syy > 0), sxy / (F.sqrt(sxx) * F.sqrt(syy))).otherwise(F.lit(0.0))


def cosine_from_sums(sxy, norm_x, norm_y) -> Column:
    """Centred cosine with norms over all of each side's ratings (M3)."""
    sxy, norm_x, norm_y = map(_c, (sxy, norm_x, norm_y))
    return F.when((norm_x > 0) & (norm_y > 0),
                  sxy / (F.sqrt(norm_x) * F.sqrt(norm_y))).otherwise(F.lit(0.0))
