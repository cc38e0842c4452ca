"""Exact top-n by inner product (F5): norm-ordered items, Cauchy-Schwarz bounds.

``x . w <= |x| |w|``: with the items in order of falling norm, a user whose n-th
best score is over ``|x|`` times the next item's norm has met all items that
matter. The items are taken in chunks, one at a time: the first is short, each is
``GROWTH`` times as long as the one before, and none holds more than
``CHUNK_BYTES`` of factors. A chunk is sent to all tasks (its size is bounded
whatever the catalogue) and scored there in blocks. Users who are done leave before
the next and their rows aren't touched again. The users asked for are dealt by
number (``USERS`` a task at most), as their few bytes say nothing of the work.

Items a user has rated don't count. A user with r of them in a chunk asks for
``n + r`` items of it, one row each, and the rated ones are removed by a join,
so no row holds a user's ratings and at most ``users * n + ratings`` rows a
chunk are made.

A user whose factors are all zero scores every item 0, so no bound ever holds; such
users take the first unrated items by id and score none.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.operators.indexing import dense_index, explode_range
from kinrank.session import materialize, parallelism

CHUNK_BYTES = 32 << 20
FIRST_CHUNK, GROWTH = 8192, 8         # items of the first chunk, and how many times longer the next is
FIRST_BLOCK, MOST_BLOCK = 128, 4096   # items scored at a time; each block is twice as long as the one before
SLICE = 2048                          # users scored at a time
USERS = 50_000                        # users of a task, at most
SLACK = 1e-9                          # share of a bound, for rounding


def _norm(features: str):
    return F.sqrt(F.aggregate(F.transform(features, lambda v: v.cast("double") * v.cast("double")), F.lit(0.0), lambda a, v: a + v))


def _scorer(sent, n: int):
    """Of each user of a batch the ``n + r`` items of the chunk that score
    highest, if they can come to ``last`` or more. Self-contained, so that
    workers need not import this module."""
    first, most, slack, rows = FIRST_BLOCK, MOST_BLOCK, SLACK, SLICE

    def run(batches):
        ids, matrix, norms = sent.value
        for b in (whole.slice(i, rows) for whole in batches for i in range(0, whole.num_rows, rows)):
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1)
            size = np.sqrt((x * x).sum(1))
            want = n + b.column("r").to_numpy()
            bar = b.column("last").to_numpy(zero_copy_only=False).copy()
            who, what, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            at, step = 0, first
            while at < len(ids):
                open_ = np.flatnonzero(size * norms[at] * (1 + slack) >= bar)
                if not len(open_):
                    break
                part = x[open_] @ matrix[at:at + step].T
                if not at:                                    # at least want items score this much
                    full = np.flatnonzero(want[open_] <= part.shape[1])
                    least = np.sort(part, axis=1)[full, part.shape[1] - want[open_[full]]]
                    bar[open_[full]] = np.maximum(bar[open_[full]], least)
                row, col = np.nonzero(part >= bar[open_][:, None])
                who, what = np.concatenate([who, open_[row]]), np.concatenate([what, ids[at + col]])
                score = np.concatenate([score, part[row, col]])
                order = np.lexsort((what, -score, who))
                who, what, score = who[order], what[order], score[order]
                begin = np.searchsorted(who, np.arange(b.num_rows))
                place = np.arange(len(who)) - begin[who]
                keep = place < want[who]
                full = place == want[who] - 1
                bar[who[full]] = np.maximum(bar[who[full]], score[full])
                who, what, score = who[keep], what[keep], score[keep]
                at, step = at + step, min(2 * step, most)
            yield pa.RecordBatch.from_arrays([b.column("_u").take(pa.array(who)), pa.array(what), pa.array(score)], names=["_u", "_i", "_raw"])

    return run


def _chunks(total: int, most: int):
    """``begin, end`` of the chunks of ``total`` items, ``most`` in one."""
    begin, size = 0, FIRST_CHUNK
    while begin < total:
        end = min(total, begin + min(size, most))
        yield begin, end
        begin, size = end, size * GROWTH


def _first_unrated(users: DataFrame, items: DataFrame, rated: DataFrame, n: int, order) -> DataFrame:
    """``_u, _i, _raw, rank`` of users who score every item 0: with r items rated,
    ``n`` unrated ones are among the first ``n + r`` by id."""
    r = rated.join(users.select("_u"), "_u", "left_semi").groupBy("_u").agg(F.count(F.lit(1)).alias("r"))
    upto = users.select("_u").join(r, "_u", "left").select("_u", (F.coalesce("r", F.lit(0)) + F.lit(n)).alias("_n"))
    cells = explode_range(upto, "_n", "_at").join(dense_index(items, "_i", "_at"), "_at").join(rated, ["_u", "_i"], "left_anti")
    out = cells.select("_u", "_i", F.lit(0.0).alias("_raw")).withColumn("rank", F.row_number().over(order))
    return out.where(F.col("rank") <= n)


def top_unrated(users: DataFrame, items: DataFrame, rated: DataFrame, n: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``_u, _i, _raw, rank``: each user's ``n`` unrated items of the largest
    inner product, equal ones by ``_i``.

    ``users``: ``_u long, features array``; ``items``: ``_i long, features
    array``; ``rated``: ``_u, _i`` pairs, each once. A user with fewer than
    ``n`` unrated items gets all of them.
    """
    spark = users.sparkSession
    order = Window.partitionBy("_u").orderBy(F.col("_raw").desc(), F.col("_i").asc())
    empty = users.select("_u").where("false").select("_u", F.lit(0).cast("long").alias("_i"), F.lit(0.0).alias("_raw"), F.lit(0).alias("rank"))
    width = items.select(F.size("features").alias("k")).first()
    if width is None:
        return empty
    key = F.struct((-_norm("features")).alias("m"), "_i")
    placed = materialize(dense_index(items.select(key.alias("_o")), "_o", "_at")
                         .select(F.col("_o._i").alias("_i"), (-F.col("_o.m")).alias("norm"), (F.col("_at") - 1).alias("_at")))
    total = placed.count()
    everyone = materialize(users.select("_u", "features", F.lit(float("-inf")).alias("last"), (_norm("features") > 0).alias("_some")))
    tally = everyone.agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("_some"), 1)).alias("some")).first()
    done = [_first_unrated(everyone.where(~F.col("_some")), items, rated, n, order)] if tally["some"] < tally["all"] else []
    active, left, best, kept = everyone.where("_some").drop("_some"), tally["some"], None, None
    for begin, end in _chunks(total, max(1, chunk_bytes // (8 * (width["k"] + 2)))) if left else ():
        inside = placed.where((F.col("_at") >= begin) & (F.col("_at") < end))
        rows = inside.join(items, "_i").select("_i", "norm", "_at", "features").toArrow().sort_by("_at")
        matrix = rows["features"].combine_chunks().flatten().to_numpy().astype(float).reshape(len(rows), -1)
        norms = rows["norm"].to_numpy()
        if best is not None:
            reach = _norm("features") * F.lit(float(norms[0]) * (1 + SLACK))
            last = best.where(F.col("rank") == n).select("_u", F.col("_raw").alias("_last"))
            active = materialize(active.drop("last").join(last, "_u", "left")
                                 .select("_u", "features", F.coalesce("_last", F.lit(float("-inf"))).alias("last")).where(F.col("last") <= reach))
            left = active.count()
            if not left:
                break
            done.append(best.join(active.select("_u"), "_u", "left_anti"))
            kept = best.join(active.select("_u"), "_u", "left_semi").select("_u", "_i", "_raw")
        sent = spark.sparkContext.broadcast((rows["_i"].to_numpy(), matrix, norms))
        met = materialize(rated.join(inside.select("_i"), "_i").select("_u", "_i"))
        r = met.groupBy("_u").agg(F.count(F.lit(1)).alias("r"))
        asked = (active.join(r, "_u", "left").select("_u", "features", "last", F.coalesce("r", F.lit(0)).alias("r"))
                 .repartition(max(parallelism(spark), -(-left // USERS))))
        found = asked.mapInArrow(_scorer(sent, n), "_u long, _i long, _raw double").join(met, ["_u", "_i"], "left_anti")
        if kept is not None:
            found = found.unionByName(kept)
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        if end < total:
            best = materialize(best)
    if tally["some"]:
        done.append(best)
    return functools.reduce(DataFrame.unionByName, done) if done else empty
