"""A fitted neighbourhood model kept as bucketed tables (R3, R9 without refitting).

Three tables, bucketed and sorted by user: neighbours, centred ratings and user
means. A request reads the buckets of the users it names; to score, the few rows
(user, neighbour) move to the neighbours' buckets, and the ratings are joined
where they lie, without a shuffle of their own. Recommendations are ranked where the
packed lists of a user's neighbours meet (``predict.recommend``), so that no row is
shuffled for a rating of a neighbour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.functions.columns import round6
from kinrank.operators import predict
from kinrank.operators.centering import centered, entity_stats
from kinrank.schema import ITEM, NEIGHBOUR, PRED, RATING, SIM, USER

BUCKETS = 64
PARTS = ("neighbours", "ratings", "users")


def save_model(neighbours: DataFrame, ratings: DataFrame, name: str, folder: str, buckets: int = BUCKETS) -> "StoredModel":
    """Write the fitted ``neighbours`` (``user_id, neighbour_id, similarity``)
    of ``ratings`` as the tables ``<name>_neighbours``, ``_ratings``, ``_users``
    under ``folder``, which all machines must see. Choose ``buckets`` so that one
    holds what a task can sort; it is fixed once written."""
    st = entity_stats(ratings, USER)
    rows = {"neighbours": neighbours.select(USER, NEIGHBOUR, SIM), "users": st.select(USER, "n", "mean_rating"),
            "ratings": centered(ratings, USER, st).select(USER, ITEM, RATING, "centered")}
    for part in PARTS:
        (rows[part].repartition(buckets, USER).write.bucketBy(buckets, USER).sortBy(USER)
         .option("path", f"{folder.rstrip('/')}/{name}_{part}").saveAsTable(f"{name}_{part}"))
    return StoredModel(ratings.sparkSession, name)


def load_model(spark: SparkSession, name: str) -> "StoredModel":
    return StoredModel(spark, name)


class StoredModel:
    """The tables of a saved model."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")

    def _asked(self, part: str, users) -> DataFrame:
        rows = self.table(part)
        if isinstance(users, DataFrame):
            return rows.join(users.select(USER).distinct(), USER, "left_semi")
        return rows.where(F.col(USER).isin([int(u) for u in ([users] if isinstance(users, int) else users)]))     # prunes buckets

    def predict(self, users) -> DataFrame:
        """``user_id, item_id, predicted_rating`` of every item that a neighbour
        rated, for a user id, a list of ids, or a DataFrame with ``user_id``."""
        asked = self._asked("neighbours", users).join(self._asked("users", users).select(USER, "mean_rating"), USER)
        rated = self.table("ratings").select(F.col(USER).alias(NEIGHBOUR), ITEM, "centered")
        w = F.col(SIM)
        sums = (asked.join(rated.hint("merge"), NEIGHBOUR).groupBy(USER, ITEM)
                .agg(F.sum(w * F.col("centered")).alias("_num"), F.sum(F.abs(w)).alias("_den"), F.max("mean_rating").alias("_mean"))
                .where(F.col("_den") > 0))
        return sums.select(USER, ITEM, round6(F.col("_mean") + F.col("_num") / F.col("_den")).alias(PRED))

    def recommend(self, users, n: int) -> DataFrame:
        """The best ``n`` unrated items of each user asked for."""
        nb = self._asked("neighbours", users)
        heard = nb.select(F.col(NEIGHBOUR).alias(USER)).distinct()
        ratings = self.table("ratings").join(heard, USER, "left_semi")
        return predict.recommend(nb, ratings, n, self._asked("ratings", users), stats=self.table("users"))
