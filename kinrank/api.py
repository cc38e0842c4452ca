"""Model-style entry points over the DataFrame operators.

The reference's programs are used as classes: a neighbourhood model built
from ratings, N and a threshold that predicts for a test set; a k-nearest
neighbour model (user or item mode) with fit / recommend / evaluate; an ALS
model with fit / recommend / evaluate. These classes give the same entry
points. Each method returns a lazy DataFrame built by the operators; a
"fitted" model holds only DataFrames (the neighbour table, the similarity
graph, the factors), never driver-side data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.constants import (ALS_ITER, ALS_RANK, ALS_REG, K_RATERS, N_RECOMMEND, SEED,
                               THRESHOLD)
from kinrank.operators import evaluate, factors, nbcf, neighbours, predict, quality
from kinrank.operators.similarity import similarity
from kinrank.schema import ITEM, PRED, RATING, USER
from kinrank.session import materialize


def _as_users(spark, users) -> DataFrame:
    """A user id, a list of ids, or a DataFrame with ``user_id``."""
    if isinstance(users, DataFrame):
        return users.select(USER).distinct()
    ids = [users] if isinstance(users, int) else list(users)
    return spark.createDataFrame([(int(u),) for u in ids], f"{USER} bigint")


class NeighbourhoodRecommender:
    """User-based neighbourhood model (R1/R1b + R2).

    ``measure``: ``"overlap"`` (default), ``"corated"`` or ``"cosine"``.
    ``threshold=None`` ranks every other user (R1b: missing pairs count as 0,
    negatives last); otherwise neighbours must exceed the threshold (R1).
    ``drop_constant`` removes constant raters first (C4).
    """

    def __init__(self, ratings: DataFrame, n: int, threshold: float | None = THRESHOLD,
                 measure: str = "overlap", drop_constant: bool = False):
        self.ratings = quality.without_constant_raters(ratings) if drop_constant else ratings
        self.n, self.threshold, self.measure = n, threshold, measure
        self.similarity = similarity(self.ratings, measure)

    def neighbours(self, users: DataFrame | None = None) -> DataFrame:
        if self.threshold is None:
            n_users = self.ratings.select(USER).distinct().count()     # one scalar
            nb = neighbours.top_neighbours_all(self.similarity, n_users, self.n, users)
        else:
            nb = neighbours.top_neighbours(self.similarity, self.n, self.threshold, users)
        return materialize(nb)

    def predict(self, test: DataFrame, num_recommendations: int,
                test_items_only: bool = True) -> DataFrame:
        """Best ``num_recommendations`` predictions per user of ``test``,
        over the items occurring in ``test`` (R2b) or all neighbour items."""
        nb = self.neighbours(test.select(USER).distinct())
        preds = predict.predict_from_neighbours(nb, self.ratings,
                                                items=test if test_items_only else None)
        return predict.top_n(preds, num_recommendations)

    def recommend(self, users, num_recommendations: int) -> DataFrame:
        """Best unrated items for the given users."""
        spark = self.ratings.sparkSession
        nb = self.neighbours(_as_users(spark, users))
        preds = predict.exclude_rated(predict.predict_from_neighbours(nb, self.ratings), self.ratings)
        return predict.top_n(preds, num_recommendations)

    def rmse(self, test: DataFrame, num_recommendations: int) -> DataFrame:
        """RMSE over the recommended test cells that hit."""
        return evaluate.rmse(self.predict(test, num_recommendations), test)


class RaterKNN:
    """k most similar raters of each item (R4-R6); ``mode="item"`` swaps roles."""

    def __init__(self, k: int = K_RATERS, measure: str = "cosine", mode: str = "user"):
        self.k, self.measure = k, measure
        self.entity, self.through = (USER, ITEM) if mode == "user" else (ITEM, USER)
        self.ratings = self.sims = None

    def fit(self, ratings: DataFrame) -> "RaterKNN":
        self.ratings = ratings
        self.sims = materialize(similarity(ratings, self.measure, entity=self.entity,
                                           through=self.through))
        return self

    def recommend(self, n: int = N_RECOMMEND, entities=None) -> DataFrame:
        """Top ``n`` unrated catalogue entries per user (per item in item mode)."""
        ent = None
        if entities is not None:
            ent = _as_users(self.ratings.sparkSession, entities)
            if self.entity != USER:
                ent = ent.withColumnRenamed(USER, self.entity)
        return nbcf.recommend_knn(self.ratings, self.sims, self.k, n, entities=ent,
                                  entity=self.entity, through=self.through)

    def evaluate(self, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows ``user_id, item_id, rating, predicted_rating`` and RMSE over all
        test cells (E6)."""
        rows = nbcf.predict_knn(test.select(USER, ITEM, RATING), self.ratings, self.sims, self.k,
                                entity=self.entity, through=self.through).select(USER, ITEM, RATING, PRED)
        return rows, evaluate.rmse_of(rows).withColumnRenamed("hits", "n_cells")


class ALSRecommender:
    """Matrix factorisation by ALS."""

    def __init__(self, n_factors: int = ALS_RANK, lambda_reg: float = ALS_REG,
                 max_iter: int = ALS_ITER, seed: int = SEED):
        self.rank, self.reg, self.max_iter, self.seed = n_factors, lambda_reg, max_iter, seed
        self.model = self.ratings = None

    def fit(self, ratings: DataFrame) -> "ALSRecommender":
        self.ratings = ratings
        self.model = factors.fit(ratings, self.rank, self.reg, self.max_iter, self.seed)
        return self

    def loss(self) -> DataFrame:
        return factors.loss(self.model, self.ratings)

    def recommend(self, n: int = N_RECOMMEND, users=None) -> DataFrame:
        """Top ``n`` unrated items for ``users`` (all users when None). An id
        the model has no factors for raises ``ValueError`` (F5)."""
        u = None
        if users is not None:
            u = _as_users(self.ratings.sparkSession, users)
            missing = u.join(self.model.users, USER, "left_anti")
            n_missing = missing.count()
            if n_missing:
                some = [r[USER] for r in missing.orderBy(USER).limit(10).collect()]
                raise ValueError(f"{n_missing} unknown user id(s), the first of them: {some}")
        return factors.recommend(self.model, self.ratings, n, u)

    def evaluate(self, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = factors.evaluate(self.model, test)
        return rows, factors.evaluate_summary(rows, "als")


def compare(test: DataFrame, *models) -> DataFrame:
    """RMSE of several fitted models on the same test cells."""
    out = None
    for m in models:
        rows, _ = m.evaluate(test)
        if "scored" not in rows.columns:
            rows = rows.withColumn("scored", F.lit(True))
        name = "als" if isinstance(m, ALSRecommender) else "nbcf"
        s = factors.evaluate_summary(rows, name)
        out = s if out is None else out.unionByName(s)
    return out
