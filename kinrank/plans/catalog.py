"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the warehouse tables: ratings are derived from them (orders form:
customer x part, rated by order-line quantity; events form: user x
``props.k``, rated by event value). Parameters are the reference's own
set-ups: N = 10 neighbours over similarity 0.5, top 5, sweep N = 2..16,
k = 10 raters, ALS rank 6, lambda 0.001, 20 iterations, seed 42.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.functions.columns import round6
from kinrank.operators import centering, evaluate, factors, incremental, nbcf, neighbours, predict, profiles, quality, store
from kinrank.operators.pairs import co_rated_counts
from kinrank.operators.similarity import all_pairs, mirror, similarity
from kinrank.operators.threshold import similar_above
from kinrank.schema import ITEM, NEIGHBOUR, PRED, RATING, SIM, USER
from kinrank.session import ensure_checkpoint_dir, materialize
from kinrank.sources import ratings as src

from kinrank.constants import (ALS_ITER, ALS_RANK, ALS_REG, CLIP_HIGH, CLIP_LOW, DEMO_THRESHOLD, K_RATERS,
                               N_NEIGHBOURS, N_RECOMMEND, SEED, SWEEP, THRESHOLD, TOP)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------- inputs
# The ratings table is derived from the warehouse tables by a join and an
# aggregate, and most plans read it several times (means, both sides of the
# pair join, neighbours' ratings). Those keep it (session.materialize) so every
# branch reads the small aggregated table instead of rescanning and re-joining
# the order lines; a plan with one read stays lazy from the scan on.
def orders_once(spark, d):
    return src.ratings_from_orders(spark, d)


def orders_ratings(spark, d):
    return materialize(src.ratings_from_orders(spark, d))


def events_ratings(spark, d):
    return materialize(src.ratings_from_events(spark, d))


def orders_split(spark, d):
    return evaluate.split(orders_ratings(spark, d))


def events_split(spark, d):
    return evaluate.split(events_ratings(spark, d))


# ---------------------------------------------------------- sources and shape
@register("ratings_load")
def q_ratings_load(spark, d):
    return orders_once(spark, d)


def _shared(spark, name):
    """A new folder beside the checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("ratings_csv")
def q_ratings_csv(spark, d):
    """The orders form written as CSV and read with the fixed schema."""
    return src.read_ratings_csv(spark, src.write_ratings_csv(orders_once(spark, d), _shared(spark, "ratings-csv")))


@register("ratings_csv_inferred")
def q_ratings_csv_inferred(spark, d):
    return src.read_ratings_csv(spark, src.write_ratings_csv(orders_once(spark, d), _shared(spark, "ratings-csv")), infer_schema=True)


@register("ratings_tsv")
def q_ratings_tsv(spark, d):
    return src.read_ratings_tsv(spark, src.write_ratings_tsv(orders_once(spark, d), _shared(spark, "ratings-tsv")))


@register("split_files")
def q_split_files(spark, d):
    """Train and test as files of their own, read back and told apart."""
    sides = [src.read_ratings_tsv(spark, src.write_ratings_tsv(x, _shared(spark, name))).withColumn("side", F.lit(name))
             for x, name in zip(orders_split(spark, d), ("train", "test"))]
    return sides[0].unionByName(sides[1])


@register("split_exact_train")
def q_split_exact_train(spark, d):
    return evaluate.split_exact(orders_once(spark, d))[0]


@register("split_exact_test")
def q_split_exact_test(spark, d):
    return evaluate.split_exact(orders_once(spark, d))[1]


def _profile_chunks(spark, d, entity, through):
    """Chunks of 64 positions, written as text so that any engine can compare them."""
    out = profiles.profile_chunks(orders_split(spark, d)[0], entity, through, chunk=64)
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("bigint").cast("string")), ",")
    return out.select(entity, "chunk", "n_ratings", text("ids").alias("ids"), text("ratings").alias("ratings"))


@register("user_profile_chunks")
def q_user_profile_chunks(spark, d):
    return _profile_chunks(spark, d, USER, ITEM)


@register("item_profile_chunks")
def q_item_profile_chunks(spark, d):
    return _profile_chunks(spark, d, ITEM, USER)


@register("similarity_by_function")
def q_similarity_by_function(spark, d):
    """A measure given as a function (M7): overlap similarity, drawn to 0 where norms are small."""
    measure = lambda c: c["sum_xy"] / (F.lit(1.0) + F.sqrt(c["sum_xx"]) * F.sqrt(c["sum_yy"]))
    return similarity(orders_split(spark, d)[0], measure).withColumn("similarity", round6("similarity"))


@register("utility_matrix")
def q_utility_matrix(spark, d):
    return src.utility_matrix(src.purchase_events(spark, d), policy="sum")


@register("ratings_profile")
def q_ratings_profile(spark, d):
    return src.ratings_profile(orders_once(spark, d))


@register("split_train")
def q_split_train(spark, d):
    return evaluate.split(orders_once(spark, d))[0]


@register("split_test")
def q_split_test(spark, d):
    return evaluate.split(orders_once(spark, d))[1]


@register("user_means")
def q_user_means(spark, d):
    return centering.user_means(evaluate.split(orders_once(spark, d))[0])


@register("ratings_centered")
def q_ratings_centered(spark, d):
    return centering.centered(orders_split(spark, d)[0]).select(USER, ITEM, RATING, "mean_rating", "centered")


def _profiles(ratings, entity):
    p = centering.profiles(ratings, entity)
    return p.withColumn("std_rating", round6("std_rating"))


@register("user_profiles")
def q_user_profiles(spark, d):
    return _profiles(evaluate.split(orders_once(spark, d))[0], USER)


@register("item_profiles")
def q_item_profiles(spark, d):
    return _profiles(evaluate.split(orders_once(spark, d))[0], ITEM)


# ------------------------------------------------------------- rater quality
@register("constant_raters")
def q_constant_raters(spark, d):
    return quality.constant_raters(orders_once(spark, d))


@register("constant_rater_summary")
def q_constant_rater_summary(spark, d):
    return quality.constant_rater_summary(orders_once(spark, d)).withColumn("percent", round6("percent"))


@register("constant_rater_values")
def q_constant_rater_values(spark, d):
    return quality.constant_rater_values(orders_ratings(spark, d))


@register("ratings_without_constant")
def q_ratings_without_constant(spark, d):
    return quality.without_constant_raters(orders_ratings(spark, d))


@register("biased_raters")
def q_biased_raters(spark, d):
    return quality.biased_raters(orders_once(spark, d))


@register("biased_rater_summary")
def q_biased_rater_summary(spark, d):
    return quality.biased_rater_summary(orders_once(spark, d)).withColumn("percent", round6("percent"))


# The same on the baskets form, whose many short orders hold constant and
# biased raters.
@register("constant_raters_baskets")
def q_constant_raters_baskets(spark, d):
    return quality.constant_raters(src.ratings_from_baskets(spark, d))


@register("constant_rater_summary_baskets")
def q_constant_rater_summary_baskets(spark, d):
    return quality.constant_rater_summary(src.ratings_from_baskets(spark, d)).withColumn("percent", round6("percent"))


@register("constant_rater_values_baskets")
def q_constant_rater_values_baskets(spark, d):
    return quality.constant_rater_values(materialize(src.ratings_from_baskets(spark, d)))


@register("ratings_without_constant_baskets")
def q_ratings_without_constant_baskets(spark, d):
    return quality.without_constant_raters(materialize(src.ratings_from_baskets(spark, d)))


@register("biased_raters_baskets")
def q_biased_raters_baskets(spark, d):
    return quality.biased_raters(src.ratings_from_baskets(spark, d))


@register("biased_rater_summary_baskets")
def q_biased_rater_summary_baskets(spark, d):
    return quality.biased_rater_summary(src.ratings_from_baskets(spark, d)).withColumn("percent", round6("percent"))


# -------------------------------------------------------------- similarities
@register("co_rated_pairs")
def q_co_rated_pairs(spark, d):
    return co_rated_counts(orders_split(spark, d)[0], USER, ITEM)


def _valid_train(spark, d):
    return quality.without_constant_raters(orders_split(spark, d)[0])


@register("similarity_corated")
def q_similarity_corated(spark, d):
    return all_pairs(_valid_train(spark, d), "corated")


@register("similarity_corated_baskets")
def q_similarity_corated_baskets(spark, d):
    """Pearson of parts that share orders, constant orders' ratings left out."""
    valid = quality.without_constant_raters(materialize(src.ratings_from_baskets(spark, d)))
    return similarity(valid, "corated", entity=ITEM, through=USER)


@register("similarity_overlap")
def q_similarity_overlap(spark, d):
    return all_pairs(orders_split(spark, d)[0], "overlap")


@register("similarity_cosine")
def q_similarity_cosine(spark, d):
    return all_pairs(orders_split(spark, d)[0], "cosine")


@register("similarity_item_cosine")
def q_similarity_item_cosine(spark, d):
    return all_pairs(orders_split(spark, d)[0], "cosine", entity=ITEM, through=USER)


@register("similarity_symmetric")
def q_similarity_symmetric(spark, d):
    train = orders_split(spark, d)[0]
    return mirror(all_pairs(train, "overlap"), USER, include_self=True,
                  entities=train.select(USER).distinct())


# ---------------------------------------------------------------- neighbours
def _overlap_neighbours(spark, d, threshold=THRESHOLD, n=N_NEIGHBOURS, everyone=False):
    """Fitted neighbourhood model: at most users x N rows, written once
    (every prediction step and its hot-key check read it, not the pair join).
    Of the test users, or of ``everyone`` in train."""
    train, test = orders_split(spark, d)
    targets = None if everyone else test.select(USER)
    return train, test, materialize(neighbours.nearest_neighbours(train, "overlap", n, threshold, targets=targets))


@register("top_neighbours")
def q_top_neighbours(spark, d):
    return _overlap_neighbours(spark, d)[2].select(USER, NEIGHBOUR, SIM, "rank")


@register("similarity_incremental")
def q_similarity_incremental(spark, d):
    """Overlap similarities of the training rows, of which a tenth came as a
    batch and was folded into the sums of the others."""
    train = orders_split(spark, d)[0]
    late = (F.col(USER) + F.col(ITEM)) % 10 == 0
    old = train.where(~late)
    sums, users = incremental.fold_in(incremental.pair_sums(old), incremental.user_sums(old), old, train.where(late))
    return incremental.similarity_from(sums, users)


@register("similarity_above")
def q_similarity_above(spark, d):
    """Events-form overlap similarities over the threshold, without a row for
    every co-rated pair."""
    return similar_above(events_split(spark, d)[0], THRESHOLD, "overlap")


@register("similarity_above_cosine")
def q_similarity_above_cosine(spark, d):
    return similar_above(events_split(spark, d)[0], DEMO_THRESHOLD, "cosine")


@register("top_neighbours_events")
def q_top_neighbours_events(spark, d):
    train = events_split(spark, d)[0]
    return neighbours.nearest_neighbours(train, "overlap", N_NEIGHBOURS, THRESHOLD).select(USER, NEIGHBOUR, SIM, "rank")


def _corated_all(spark, d, targets=None, n=N_NEIGHBOURS, ratings=None):
    valid = ratings if ratings is not None else _valid_train(spark, d)
    n_valid = valid.select(USER).distinct().count()      # one scalar
    return valid, materialize(neighbours.nearest_neighbours(valid, "corated", n, targets=targets, n_entities=n_valid))


@register("top_neighbours_all")
def q_top_neighbours_all(spark, d):
    test = orders_split(spark, d)[1]
    return _corated_all(spark, d, test.select(USER))[1].select(USER, NEIGHBOUR, SIM, "rank")


# ---------------------------------------------------------------- prediction
@register("predict_user_knn")
def q_predict_user_knn(spark, d):
    train, _, nb = _overlap_neighbours(spark, d)
    return predict.predict_from_neighbours(nb, train)


@register("predict_test_items")
def q_predict_test_items(spark, d):
    train, test, nb = _overlap_neighbours(spark, d)
    return predict.predict_from_neighbours(nb, train, items=test)


@register("recommend_top_n")
def q_recommend_top_n(spark, d):
    train, _, nb = _overlap_neighbours(spark, d)
    return predict.recommend(nb, train, TOP, train)


@register("unrated_items")
def q_unrated_items(spark, d):
    train, _, nb = _overlap_neighbours(spark, d)
    return predict.unrated_candidates(nb, train)


@register("unrated_gaps")
def q_unrated_gaps(spark, d):
    """Every unrated item of the catalogue for every user, a row a run of them."""
    return profiles.unrated_gaps(orders_split(spark, d)[0])


@register("user_history")
def q_user_history(spark, d):
    train, test = orders_split(spark, d)
    return predict.history_with_count(predict.history(test, train))


@register("predict_uncentered")
def q_predict_uncentered(spark, d):
    train, _, nb = _overlap_neighbours(spark, d)
    return predict.predict_from_neighbours(nb, train, centered=False)


@register("recommend_with_history")
def q_recommend_with_history(spark, d):
    """For every user, also those without test ratings, whose history is their train rows."""
    train, test, nb = _overlap_neighbours(spark, d, DEMO_THRESHOLD, everyone=True)
    return predict.recommend(nb, train, TOP, predict.history(test, train), items=test)


@register("recommend_single_user")
def q_recommend_single_user(spark, d):
    valid = _valid_train(spark, d)
    one = valid.agg(F.min(USER).alias(USER))                # the user asked for, as a one-row frame
    mine = valid.join(one, USER, "left_semi")
    sims = similarity(mine, "corated", other=valid)         # that user against all others only
    n_valid = valid.select(USER).distinct().count()         # one scalar
    nb = materialize(neighbours.top_neighbours_all(sims, n_valid, N_NEIGHBOURS, symmetric_input=True))
    preds = predict.exclude_rated(predict.predict_from_neighbours(nb, valid), valid)
    return predict.top_n(preds, TOP)


@register("recommend_stored")
def q_recommend_stored(spark, d):
    """The flagship recommendation from a model saved as bucketed tables."""
    train, _, nb = _overlap_neighbours(spark, d)
    name = f"model_{uuid.uuid4().hex}"
    model = store.save_model(nb, train, name, _shared(spark, "model"))
    return model.recommend(nb.select(USER), TOP)


@register("recommend_for_vector")
def q_recommend_for_vector(spark, d):
    train, test = orders_split(spark, d)
    # A new user given only by a vector of ratings: the held-out ratings of
    # the first test user, under a fresh id (-1 - that user's id). The id is
    # derived from the data, not a literal: a constant join key would make
    # the optimiser turn every join on it into a cross product.
    first = test.agg(F.min(USER).alias("_u"))
    vec = (test.join(first, test[USER] == first["_u"], "left_semi")
           .select((F.lit(-1) - F.col(USER)).alias(USER), ITEM, RATING))
    sims = similarity(vec, "overlap", other=train)
    nb = materialize(neighbours.top_neighbours(sims, N_NEIGHBOURS, THRESHOLD, symmetric_input=True))
    preds = predict.predict_from_neighbours(nb, train, target_stats=centering.user_means(vec))
    return predict.top_n(predict.exclude_rated(preds, vec), TOP)


# ---------------------------------------------------------------- evaluation
@register("rmse")
def q_rmse(spark, d):
    train, test, nb = _overlap_neighbours(spark, d)
    return evaluate.rmse(predict.recommend(nb, train, TOP, items=test), test)


def _sweep(spark, d, ratings=None):
    train, test = evaluate.split(ratings if ratings is not None else orders_ratings(spark, d))
    return evaluate.rmse_by_n("overlap", train, test, SWEEP[0], SWEEP[1], THRESHOLD, TOP)


@register("rmse_by_n")
def q_rmse_by_n(spark, d):
    return _sweep(spark, d)


@register("rmse_by_n_corated")
def q_rmse_by_n_corated(spark, d):
    """Sweep of the per-user form: co-rated Pearson among non-constant raters,
    neighbours without a threshold, every unrated item scored, and each test
    user given as many recommendations as they have test ratings."""
    train, test = orders_split(spark, d)
    valid = quality.without_constant_raters(train)
    n_valid = valid.select(USER).distinct().count()      # one scalar
    targets = test.select(USER).distinct().join(valid.select(USER).distinct(), USER, "left_semi")
    nb = materialize(neighbours.nearest_neighbours(valid, "corated", SWEEP[1], targets=targets, n_entities=n_valid))
    return evaluate.sweep(nb, valid, test.join(targets, USER, "left_semi"), SWEEP[0], SWEEP[1],
                          top=None, candidates="unrated")


@register("best_n")
def q_best_n(spark, d):
    return evaluate.best_n(_sweep(spark, d))


@register("recommend_final")
def q_recommend_final(spark, d):
    ratings = orders_ratings(spark, d)
    n_best = evaluate.best_n(_sweep(spark, d, ratings)).first()
    n = int(n_best["n"]) if n_best is not None else 0     # one scalar; nothing scored: no neighbours, no rows
    nb = materialize(neighbours.nearest_neighbours(ratings, "overlap", n, THRESHOLD))
    return predict.recommend(nb, ratings, TOP, ratings)


# --------------------------------------------------------- k nearest raters
def _nbcf_rows(train, test):
    return nbcf.predict_knn(test.select(USER, ITEM, RATING), train, "cosine", K_RATERS)


@register("predict_nbcf")
def q_predict_nbcf(spark, d):
    train, test = events_split(spark, d)
    return _nbcf_rows(train, test).select(USER, ITEM, RATING, PRED)


@register("predict_nbcf_items")
def q_predict_nbcf_items(spark, d):
    """Item-item mode of R4 on the test cells: the k items most similar to
    the target item among those the user rated, item means."""
    train, test = events_split(spark, d)
    sims = similarity(train, "cosine", entity=ITEM, through=USER)
    return (nbcf.predict_knn(test.select(USER, ITEM, RATING), train, sims, K_RATERS,
                             entity=ITEM, through=USER)
            .select(USER, ITEM, RATING, PRED))


@register("nbcf_evaluate")
def q_nbcf_evaluate(spark, d):
    train, test = events_split(spark, d)
    return evaluate.rmse_of(_nbcf_rows(train, test)).withColumnRenamed("hits", "n_cells")


@register("rmse_by_fraction")
def q_rmse_by_fraction(spark, d):
    train, test = events_split(spark, d)
    return evaluate.rmse_by_fraction(_nbcf_rows(train, test))


@register("rmse_by_fraction_models")
def q_rmse_by_fraction_models(spark, d):
    """Both models on the same growing samples (E8); the factor model's errors
    have no SQL equivalent."""
    train, test = events_split(spark, d)
    fm = factors.fit(train, ALS_RANK, ALS_REG, ALS_ITER, SEED)
    rows = {"nbcf": _nbcf_rows(train, test), "als": factors.evaluate(fm, test)}
    both = [evaluate.rmse_by_fraction(r).select(F.lit(m).alias("model"), "*") for m, r in rows.items()]
    return both[0].unionByName(both[1])


@register("recommend_nbcf")
def q_recommend_nbcf(spark, d):
    train = events_split(spark, d)[0]
    return nbcf.recommend_knn(train, "cosine", K_RATERS, N_RECOMMEND)


@register("recommend_users_for_item")
def q_recommend_users_for_item(spark, d):
    train = events_split(spark, d)[0]
    sims = similarity(train, "cosine", entity=ITEM, through=USER)
    return nbcf.recommend_knn(train, sims, K_RATERS, N_RECOMMEND, entity=ITEM, through=USER)


# ------------------------------------------------------------- factorisation
def _als(spark, d):
    train, test = orders_split(spark, d)
    return train, test, factors.fit(train, ALS_RANK, ALS_REG, ALS_ITER, SEED)


@register("als_predict")
def q_als_predict(spark, d):
    train, test, fm = _als(spark, d)
    return factors.evaluate(fm, test)


@register("als_loss")
def q_als_loss(spark, d):
    train, _, fm = _als(spark, d)
    return factors.loss(fm, train)


@register("als_loss_trace")
def q_als_loss_trace(spark, d):
    train = orders_split(spark, d)[0]
    return factors.loss_trace(train, ALS_RANK, ALS_REG, ALS_ITER)


@register("als_loss_trace_rank2")
def q_als_loss_trace_rank2(spark, d):
    """The first two iterations at rank 2, whose solves SQL can spell out."""
    train = orders_split(spark, d)[0]
    return factors.loss_trace(train, 2, ALS_REG, 2).select("iteration", round6("loss").alias("loss"))


@register("als_recommend")
def q_als_recommend(spark, d):
    train, _, fm = _als(spark, d)
    return factors.recommend(fm, train, N_RECOMMEND)


@register("als_evaluate")
def q_als_evaluate(spark, d):
    train, test, fm = _als(spark, d)
    return factors.evaluate_summary(factors.evaluate(fm, test), "als")


@register("als_cells")
def q_als_cells(spark, d):
    """What a factor model's evaluation must hold whatever its factors: cells,
    cells it can score, predictions outside the rating range."""
    train, test, fm = _als(spark, d)
    rows = factors.evaluate(fm, test)
    return rows.agg(F.count(F.lit(1)).alias("n_cells"),
                    F.sum(F.col("scored").cast("int")).cast("bigint").alias("hits"),
                    F.sum((~F.col(PRED).between(CLIP_LOW, CLIP_HIGH)).cast("int")).cast("bigint").alias("out_of_range"))


@register("als_recommend_counts")
def q_als_recommend_counts(spark, d):
    """Per user how many items are recommended, and how many of them they had rated."""
    train, _, fm = _als(spark, d)
    recs = factors.recommend(fm, train, N_RECOMMEND)
    rated = train.select(USER, ITEM, F.lit(1).alias("_rated"))
    return (recs.join(rated, [USER, ITEM], "left").groupBy(USER)
            .agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.coalesce("_rated", F.lit(0))).cast("bigint").alias("n_rated_items")))


@register("model_comparison")
def q_model_comparison(spark, d):
    train, test, fm = _als(spark, d)
    # Each model's row is kept before the other is made: what they shuffle isn't on disk together.
    als_row = materialize(factors.evaluate_summary(factors.evaluate(fm, test), "als"))
    knn_rows = _nbcf_rows(train, test).withColumn("scored", F.lit(True))
    return materialize(factors.evaluate_summary(knn_rows, "nbcf")).unionByName(als_row)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
