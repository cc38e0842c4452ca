"""Nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.operators import dense, gather
from kinrank.operators.centering import centered, entity_stats
from kinrank.operators.similarity import mirror, similarity
from kinrank.schema import ITEM, NEIGHBOUR, RATING, SIM, USER


def top_neighbours(sims: DataFrame, n: int, threshold: float | None = None,
                   targets: DataFrame | None = None, entity: str = USER,
                   symmetric_input: bool = False, include_self: bool = False) -> DataFrame:
    """The ``n`` most similar neighbours of each target, similarity above
    ``threshold`` (R1 = J5 + M6 + W1).

    ``sims`` holds unordered pairs (``entity < neighbour``) unless
    ``symmetric_input``. The threshold is applied before ranking: ranking is
    by descending similarity, so both orders give the same rows and filtering
    first shuffles less (Catalyst does not push a filter below a window whose
    partition key it does not constrain). Ties are broken by neighbour id.
    The ``row_number <= n`` filter becomes a partial+final ``WindowGroupLimit``,
    so each map task already keeps at most ``n`` rows per target.
    """
    s = sims
    if threshold is not None:
        s = s.where(F.col(SIM) > F.lit(float(threshold)))
    sym = s if symmetric_input else mirror(s, entity, include_self=include_self)
    if targets is not None:
        sym = sym.join(targets.select(entity).distinct(), entity, "left_semi")
    w = Window.partitionBy(entity).orderBy(F.col(SIM).desc(), F.col(NEIGHBOUR).asc())
    return sym.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(n))


def top_neighbours_all(sims: DataFrame, n_entities: int, n: int,
                       targets: DataFrame | None = None, entity: str = USER,
                       symmetric_input: bool = False) -> DataFrame:
    """Top ``n`` neighbours without a threshold.

    Every other one of ``n_entities`` entities is a candidate; those without
    a pair row have similarity 0, so negatives rank after all of them. Only
    non-zero neighbours are returned (a zero weighs nothing in a prediction),
    each with its rank among all ``n_entities - 1`` candidates. Ties by id.

    Positives: ``row_number <= n`` by descending similarity (partial+final
    ``WindowGroupLimit``). Negatives: with q negatives, the j-th least
    negative has rank ``n_entities - q - 1 + j``; only users with
    ``q >= n_entities - n`` can place one within n, and only their first
    ``n`` are ranked, so no user's negatives are sorted in full.
    """
    nz = sims.where(F.col(SIM) != F.lit(0.0))
    sym = nz if symmetric_input else mirror(nz, entity)
    if targets is not None:
        sym = sym.join(targets.select(entity).distinct(), entity, "left_semi")
    w = Window.partitionBy(entity).orderBy(F.col(SIM).desc(), F.col(NEIGHBOUR).asc())
    pos = (sym.where(F.col(SIM) > 0).withColumn("rank", F.row_number().over(w))
           .where(F.col("rank") <= F.lit(n)))
    neg = sym.where(F.col(SIM) < 0)
    q = (neg.groupBy(entity).agg(F.count(F.lit(1)).alias("_q"))
         .where(F.col("_q") >= F.lit(n_entities - n)))
    rn = F.row_number().over(w)
    negr = (neg.join(q, entity).withColumn("_j", rn)
            .where((F.col("_j") <= F.lit(n)) &
                   (F.lit(n_entities) - F.col("_q") - F.lit(1) + F.col("_j") <= F.lit(n)))
            .withColumn("rank", (F.lit(n_entities) - F.col("_q") - F.lit(1) + F.col("_j")).cast("int"))
            .drop("_j", "_q"))
    return pos.unionByName(negr)


def nearest_neighbours(ratings: DataFrame, measure: str, n: int, threshold: float | None = None, *,
                       targets: DataFrame | None = None, n_entities: int | None = None,
                       entity: str = USER, through: str = ITEM, shape: gather.Shape | None = None) -> DataFrame:
    """The rows of ``top_neighbours(similarity(ratings, measure), n, threshold,
    targets)``, or with ``n_entities`` of ``top_neighbours_all``, for ``overlap``
    and ``corated``. On sparse ratings no row is made of a pair (``gather``):
    only the neighbours kept leave a task; nor on dense ratings of a small
    catalogue (``dense``, also for ``cosine``). Entities that may have very many
    pairs, and dense ratings, go the plain way."""
    def ranked(sims, symmetric):
        if n_entities is None:
            return top_neighbours(sims, n, threshold, targets, entity, symmetric_input=symmetric)
        return top_neighbours_all(sims, n_entities, n, targets, entity, symmetric_input=symmetric)

    shape = shape or gather.Shape(ratings, entity, through)
    if n_entities is None and threshold is not None and threshold >= 0 and dense.fits(shape, measure):
        return ranked(dense.similar(ratings, shape, measure, threshold, n, entity, through, targets), True)
    if not shape.fits():
        return ranked(similarity(ratings, measure, entity=entity, through=through), False)
    rows, value = (ratings, RATING) if measure == "corated" else (centered(ratings, entity, entity_stats(ratings, entity)), "dev")
    asked = targets.select(entity).distinct() if targets is not None else None
    own = rows.join(asked, entity, "left_semi") if asked is not None else rows
    bound = shape.heavy()
    if bound is None:
        return gather.nearest(own, rows, shape, measure, n, threshold, n_entities, entity, through, value)
    many = ratings.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound).select(entity)
    light = gather.nearest(own.join(many, entity, "left_anti"), rows, shape, measure, n, threshold, n_entities, entity, through, value)
    heavy = ranked(similarity(ratings.join(many, entity, "left_semi"), measure, entity=entity, through=through, other=ratings), True)
    return light.unionByName(heavy.select(*light.columns))
