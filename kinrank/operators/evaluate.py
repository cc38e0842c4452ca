"""Split, error measures and parameter sweeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.columns import hash_bucket, in_train, round6
from kinrank.operators import gather, predict
from kinrank.operators.centering import centered as center
from kinrank.operators.centering import entity_stats
from kinrank.operators.neighbours import nearest_neighbours, top_neighbours
from kinrank.operators.skew import DEFAULT_HOT_THRESHOLD, split_join
from kinrank.session import materialize
from kinrank.schema import ITEM, NEIGHBOUR, PRED, RATING, SIM, USER

from kinrank.constants import FRACTIONS, SAMPLE_ITEM_MULT, SAMPLE_USER_MULT, SPLIT_DIGITS, TEST_PERCENT


def split(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """80/20 split by a hash of the (user, item) cell (E1). The same cell lands
    on the same side on any cluster and partitioning."""
    flag = in_train(USER, ITEM)
    return ratings.where(flag), ratings.where(~flag)


def split_exact(ratings: DataFrame, percent: int = TEST_PERCENT, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test rows with an exact share: of every user's n cells the
    floor(n * percent / 100) of smallest hash are test (E1).

    The hash is the md5 of seed, user and item, so another seed is another
    split. No window runs over a whole user: cells are counted by (user, the
    first SPLIT_DIGITS hexadecimal digits), running sums over those counts say
    which prefixes are test as a whole, and only the one prefix where the quota
    ends is ranked. One row per cell is expected."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col(USER).cast("string"), F.col(ITEM).cast("string")).cast("binary"))
    rows = ratings.withColumn("_h", key).withColumn("_p", F.substring("_h", 1, SPLIT_DIGITS))
    counts = rows.groupBy(USER, "_p").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(USER).orderBy("_p")
    counts = (counts.withColumn("_end", F.sum("_c").over(upto))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(USER))))
    quota = F.floor(F.col("_n") * F.lit(percent) / F.lit(100)).cast("long")
    counts = counts.select(USER, "_p", (quota - (F.col("_end") - F.col("_c"))).alias("_left"), (F.col("_end") <= quota).alias("_whole"))
    placed = rows.join(counts, [USER, "_p"])
    edge = placed.where((F.col("_left") > 0) & ~F.col("_whole"))
    edge = edge.withColumn("_r", F.row_number().over(Window.partitionBy(USER, "_p").orderBy("_h", ITEM)))
    edge = edge.withColumn("_t", F.col("_r") <= F.col("_left")).drop("_r")
    rest = placed.where((F.col("_left") <= 0) | F.col("_whole")).withColumn("_t", F.col("_whole"))
    both = materialize(rest.unionByName(edge).select(*ratings.columns, "_t"))
    return both.where(~F.col("_t")).drop("_t"), both.where("_t").drop("_t")


def rmse(preds: DataFrame, truth: DataFrame, pred_col: str = PRED) -> DataFrame:
    """RMSE over the predicted cells that occur in ``truth`` (E3):
    ``hits, rmse`` (NULL rmse when nothing hits)."""
    j = preds.select(USER, ITEM, pred_col).join(truth.select(USER, ITEM, RATING), [USER, ITEM])
    return rmse_of(j, pred_col)


def rmse_of(rows: DataFrame, pred_col: str = PRED, truth_col: str = RATING, group=()) -> DataFrame:
    err = F.col(pred_col) - F.col(truth_col)
    g = rows.groupBy(*group) if group else rows
    return g.agg(F.count(F.lit(1)).alias("hits"), round6(F.sqrt(F.avg(err * err))).alias("rmse"))


def rmse_by_n(sims: DataFrame | str, train: DataFrame, test: DataFrame, n_min: int = 2, n_max: int = 16,
              threshold: float | None = 0.5, top: int = 5) -> DataFrame:
    """RMSE of the top-``top`` test-item predictions for every neighbourhood
    size n in [n_min, n_max] (E5, thresholded neighbours), in one plan.
    Similarity and the neighbour ranking do not depend on n: neighbours are
    ranked once up to ``n_max``. ``sims``: pairs, or the name of a measure over
    ``train``, whose neighbours are then found without a row for every pair."""
    targets = test.select(USER).distinct()
    neigh = (nearest_neighbours(train, sims, n_max, threshold, targets=targets) if isinstance(sims, str)
             else top_neighbours(sims, n_max, threshold, targets))
    neigh = materialize(neigh)                                             # users x n_max rows
    return sweep(neigh, train, test, n_min, n_max, top=top, candidates="test_items")


def sweep(neigh: DataFrame, train: DataFrame, test: DataFrame, n_min: int, n_max: int, *,
          top: int | None = 5, candidates: str = "test_items",
          hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """RMSE per neighbourhood size from neighbours ranked up to ``n_max``.

    ``candidates``: ``"test_items"`` scores items occurring in the test table
    (R2b); ``"unrated"`` scores every item of the neighbours the user has not
    rated (R3). ``top``: best predictions kept per user, or ``None`` for as
    many as the user has test ratings.

    For a (user, item) cell the prediction is a step function of n that
    changes only at the ranks of the neighbours who rated the item, so
    running sums over those ranks (a window of at most ``n_max`` rows per
    cell) give each constant segment ``[a, b]`` once.

    The sums are run, ranked and compared with the test ratings where a user's
    neighbours' lists meet (``gather``), so a group gives a row for each n. Users
    whose neighbours have very many ratings go the plain way (``_swept_plain``).
    """
    spark = train.sparkSession
    st = entity_stats(train, USER)
    r = train.select(USER, ITEM, RATING)
    if candidates == "test_items":
        r = r.join(test.select(ITEM).distinct(), ITEM, "left_semi")
    rated = train if candidates == "unrated" else None
    neigh = neigh.where(F.col("rank") <= n_max)
    elements, most, many = predict.sized(neigh, st.select(F.col(USER).alias(NEIGHBOUR), "n"))
    nb = (neigh.select(USER, NEIGHBOUR, F.col(SIM).alias("_w"), F.col("rank").alias("_r"))
          .join(st.select(USER, F.col("mean_rating").alias("_m")), USER)
          .join(st.select(F.col(USER).alias(NEIGHBOUR), F.col("mean_rating").alias("_mv")), NEIGHBOUR))
    truth = test.select(USER, ITEM, RATING)
    if many is None:
        found = gather.swept(nb, r, rated, truth, n_min, n_max, top, most, elements, USER, ITEM)
    else:
        many = materialize(many)
        found = gather.swept(nb.join(many, USER, "left_anti"), r, rated, truth, n_min, n_max, top, most, elements, USER, ITEM)
        err = F.col(PRED) - F.col(RATING)
        plain = _swept_plain(neigh.join(many, USER, "left_semi"), train, test, n_min, n_max, top, candidates, hot_threshold)
        found = found.unionByName(plain.groupBy("n").agg(F.count(F.lit(1)).alias("hits"), F.count(err).alias("_known"),
                                                         F.coalesce(F.sum(err * err), F.lit(0.0)).alias("_square")))
    per_n = found.groupBy("n").agg(F.sum("hits").alias("hits"), F.sum("_known").alias("_known"), F.sum("_square").alias("_square"))
    # The n table has n_max - n_min + 1 rows: a fixed, proven size.
    ns = spark.range(n_min, n_max + 1).select(F.col("id").cast("int").alias("n"))
    return (ns.join(F.broadcast(per_n), "n", "left")
            .select("n", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"),
                    F.when(F.col("_known") > 0, round6(F.sqrt(F.col("_square") / F.col("_known")))).alias("rmse")))


def _swept_plain(neigh: DataFrame, train: DataFrame, test: DataFrame, n_min: int, n_max: int, top: int | None, candidates: str,
                 hot_threshold: int | None) -> DataFrame:
    """The hits of ``sweep`` with a row for every rating of a neighbour, split at hot
    neighbours.

    Pruning (exact): a segment covering every n is "full". Any segment ranked
    below a user's k-th best full segment loses to k segments at every n and
    is dropped before segments are expanded to their n values.
    """
    st = entity_stats(train, USER)
    r = center(train, USER, st).select(F.col(USER).alias(NEIGHBOUR), ITEM, "centered")
    if candidates == "test_items":
        r = r.join(test.select(ITEM).distinct(), ITEM, "left_semi")
    j = split_join(neigh.select(USER, NEIGHBOUR, SIM, "rank"), r, NEIGHBOUR, USER, ITEM,
                   hot_threshold=hot_threshold)
    if candidates == "unrated":
        j = j.join(train.select(USER, ITEM), [USER, ITEM], "left_anti")
    wc = Window.partitionBy(USER, ITEM).orderBy("rank")
    run = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = (j.select(USER, ITEM, "rank",                       # one pass for all three
                    F.sum(F.col(SIM) * F.col("centered")).over(run).alias("_num"),
                    F.sum(F.abs(F.col(SIM))).over(run).alias("_den"),
                    F.lead("rank", 1, n_max + 1).over(wc).alias("_next"))
           .withColumn("a", F.greatest(F.col("rank"), F.lit(n_min)))
           .withColumn("b", F.least(F.col("_next") - 1, F.lit(n_max)))
           .where((F.col("a") <= F.col("b")) & (F.col("_den") > 0))
           .join(st.select(USER, "mean_rating"), USER)
           .select(USER, ITEM, "a", "b",
                   round6(F.col("mean_rating") + F.col("_num") / F.col("_den")).alias(PRED)))
    if top is None:
        k = test.groupBy(USER).agg(F.count(F.lit(1)).cast("int").alias("_k"))
        seg = seg.join(k, USER)
    else:
        seg = seg.withColumn("_k", F.lit(top))
    full = seg.where((F.col("a") == n_min) & (F.col("b") == n_max))
    wf = Window.partitionBy(USER).orderBy(F.col(PRED).desc(), F.col(ITEM).asc())
    ranked = full.withColumn("_r", F.row_number().over(wf))
    if top is not None:
        ranked = ranked.where(F.col("_r") <= F.lit(top))     # constant bound: partial top-k map-side
    bar = (ranked.where(F.col("_r") == F.col("_k"))
           .select(USER, F.col(PRED).alias("_p5"), F.col(ITEM).alias("_i5")))
    keep = (seg.join(bar, USER, "left")
            .where(F.col("_p5").isNull() | (F.col(PRED) > F.col("_p5")) |
                   ((F.col(PRED) == F.col("_p5")) & (F.col(ITEM) <= F.col("_i5"))))
            .select(USER, ITEM, PRED, "_k", F.explode(F.sequence("a", "b")).alias("n")))
    w = Window.partitionBy("n", USER).orderBy(F.col(PRED).desc(), F.col(ITEM).asc())
    best = keep.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_k"))
    return best.join(test.select(USER, ITEM, RATING), [USER, ITEM])


def best_n(sweep: DataFrame) -> DataFrame:
    """Neighbourhood size with the lowest RMSE, ties by smaller n."""
    return sweep.where(F.col("rmse").isNotNull()).orderBy(F.col("rmse").asc(), F.col("n").asc()).limit(1)


def sample_bucket(buckets: int = 100):
    return hash_bucket(USER, ITEM, buckets, SAMPLE_USER_MULT, SAMPLE_ITEM_MULT)


def rmse_by_fraction(rows: DataFrame, fractions=FRACTIONS, pred_col: str = PRED,
                     truth_col: str = RATING) -> DataFrame:
    """RMSE on growing hash-bucket samples of the evaluated cells.
    Each cell is counted for every fraction whose bucket bound it is under
    (an explode over the fixed fraction list, not a join)."""
    fr = F.array(*[F.lit(int(f)) for f in fractions])
    r = rows.withColumn("_b", sample_bucket())
    r = r.withColumn("fraction", F.explode(F.filter(fr, lambda f: F.col("_b") < f)))
    err = F.col(pred_col) - F.col(truth_col)
    return r.groupBy("fraction").agg(F.count(F.lit(1)).alias("n_cells"),
                                     round6(F.sqrt(F.avg(err * err))).alias("rmse"))
